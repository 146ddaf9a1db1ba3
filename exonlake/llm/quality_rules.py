"""Document statistics and quality rules: gradient-boosted trees in flat node arrays.

``document_stats`` counts over every whole text.  ``fit_rules`` boosts regression
trees on the statistics of all labelled documents with monotonic constraints on
chosen features, and ``RuleTrees`` keeps all trees as numpy node arrays so that a
batch walks every tree at once.  Trees grow level by level from sums of gradients
by node, feature and bin: up to ``local_rows`` labelled documents are summed on
the driver, more by a Spark job a level, whose tasks give back sums alone.  Sums
are of integers, so that the trees don't depend on how rows are dealt.

Defined cases: a null text is an empty text (no words, so ``base_failed``);
repeated documents are scored each on their own, and a doc_id with several
texts is fitted on the least of them; label rows with nulls are not
used, of a document labelled twice with different values the lower one counts;
without labels of both kinds every document that passes the base is kept; an
empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import textops as tx
from .store import written

#: Labelled documents up to which their statistics, all of them, are summed on the driver.
LOCAL_ROWS = 6000
#: Bins of a feature, and units of the gradients that are summed.
BINS, UNIT = 48, 1 << 32
#: Labelled documents whose bins are one row of a table.
CHUNK_ROWS = 1 << 13
#: Labels that may be broadcast; beyond, statistics of all documents are joined with them.
MAX_BROADCAST_LABELS = 1_000_000
#: Bits of a 32-bit float that tell the cells apart in which quantiles are counted: sign, exponent and 10 of the fraction.
_CELL = 13
FEATURES = ("log_words", "word_len", "symbol_share", "dup_line_share", "repeat_share", "upper_share", "digit_share", "other_punct_share", "non_ascii_share", "distinct_share", "long_word_share", "words_per_line", "lone_mark_share")
#: 1: a greater value never lowers the score; -1: never raises it.
MONOTONE = {"symbol_share": -1, "dup_line_share": -1, "repeat_share": -1, "lone_mark_share": -1}
MIN_WORDS, REPEAT_PERCENT = 50, 50

_UPPER, _DIGIT, _SYMBOL, _PUNCT = 1, 2, 3, 4
_CLASS = np.zeros(256, np.int64)
_CLASS[ord("A") : ord("Z") + 1] = _UPPER
_CLASS[ord("0") : ord("9") + 1] = _DIGIT
_CLASS[[c for c in range(33, 127) if not chr(c).isalnum()]] = _PUNCT
_CLASS[[ord(c) for c in "#*$%&|<>"]] = _SYMBOL
_CLASS[0x80:] = 5
STATS_TYPE = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, " + ", ".join(f"{f} double" for f in FEATURES)


def _later_copies(keys: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Per row: how many keys are equal to an earlier one of the same row."""
    own = tx.mix(keys + tx.mix(rows.astype(np.uint64) + np.uint64(1)))
    _, first = np.unique(own, return_index=True)
    return np.bincount(rows, minlength=n) - np.bincount(rows[first], minlength=n)


def stats_of(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The statistics of each row of a text buffer."""
    n = len(offsets) - 1
    start, end, row = tx.word_bounds(data, offsets)
    words = tx.span_hash(data, start, end)
    n_words = np.bincount(row, minlength=n)
    points = np.zeros(len(data) + 1, np.int64)
    np.cumsum(tx.code_points(data), out=points[1:])
    chars = points[end] - points[start]
    word_chars = np.bincount(row, chars, n).astype(np.int64)

    grams, first = tx.gram_hash(words, row, 3)
    own = tx.mix(grams + tx.mix(row[first].astype(np.uint64) + np.uint64(1)))
    ordered = np.sort(own)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    hit = np.zeros(len(words), bool)
    if len(twice):
        at = first[twice[np.minimum(np.searchsorted(twice, own), len(twice) - 1)] == own]
        for k in range(3):
            hit[at + k] = True
    n_repeat = np.bincount(row[hit], minlength=n)

    breaks = np.flatnonzero(data == 10)
    line_start = np.unique(np.concatenate([offsets[:-1], breaks + 1]))
    line_start = line_start[line_start < len(data)]
    line_end = np.append(line_start[1:], len(data))
    at_break = np.zeros(len(data) + 1, bool)
    at_break[breaks] = True
    line_end = line_end - at_break[line_end - 1]
    line_end = np.maximum(line_end, line_start)
    opened = np.zeros(len(data) + 1, np.int64)
    opened[start + 1] = 1
    np.cumsum(opened, out=opened)
    with_word = opened[line_end] > opened[line_start]
    line_start, line_end = line_start[with_word], line_end[with_word]
    line_row = np.searchsorted(offsets, line_start, "right") - 1
    n_dup = _later_copies(tx.span_hash(data, line_start, line_end), line_row, n)
    n_lines = np.bincount(line_row, minlength=n)

    kinds = np.bincount(np.repeat(np.arange(n) * 6, np.diff(offsets)) + _CLASS[data], minlength=6 * n)[: 6 * n].reshape(n, 6)
    distinct = n_words - _later_copies(words, row, n)
    marked = (end - start > 1) & np.isin(_CLASS[data[end - 1]], (_SYMBOL, _PUNCT)) & np.isin(_CLASS[data[np.maximum(end - 2, 0)]], (_SYMBOL, _PUNCT))
    marked |= (end - start == 1) & np.isin(_CLASS[data[start]], (_SYMBOL, _PUNCT))
    per_word, size = np.maximum(n_words, 1), np.maximum(np.diff(offsets), 1)
    return {
        "n_words": n_words, "word_chars": word_chars, "n_symbols": kinds[:, _SYMBOL], "n_dup_lines": n_dup, "n_repeat_words": n_repeat,
        "log_words": np.log1p(n_words), "word_len": word_chars / per_word, "symbol_share": kinds[:, _SYMBOL] / size, "dup_line_share": n_dup / np.maximum(n_lines, 1),
        "repeat_share": n_repeat / per_word, "upper_share": kinds[:, _UPPER] / size, "digit_share": kinds[:, _DIGIT] / size, "other_punct_share": kinds[:, _PUNCT] / size,
        "non_ascii_share": kinds[:, 5] / size, "distinct_share": distinct / per_word, "long_word_share": np.bincount(row[chars > 20], minlength=n) / per_word,
        "words_per_line": n_words / np.maximum(n_lines, 1), "lone_mark_share": np.bincount(row[marked], minlength=n) / per_word,
    }


@dataclass
class RuleTrees:
    """All trees in flat arrays; a leaf points to itself. Scores are log-odds of good quality."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    bias: float

    def score(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.bias)
        for at in range(0, len(x), 4096):
            part = x[at : at + 4096]
            node, rows = np.tile(self.roots, (len(part), 1)), np.arange(len(part))[:, None]
            for _ in range(self.depth):
                node = np.where(part[rows, self.feature[node]] <= self.threshold[node], self.left[node], self.right[node])
            out[at : at + 4096] += self.value[node].sum(axis=1)
        return out


def _bins(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(e, c, "left") for e, c in zip(edges, x.T, strict=True)], axis=1).astype(np.uint8)


def _walk(bins: np.ndarray, nodes: np.ndarray, roots: list[int], depth: int) -> np.ndarray:
    """The node that each row reaches in each tree; ``nodes`` holds feature, bin, left and right."""
    node, rows = np.tile(np.array(roots, np.int64), (len(bins), 1)), np.arange(len(bins))[:, None]
    for _ in range(depth):
        node = np.where(bins[rows, nodes[node, 0]] <= nodes[node, 1], nodes[node, 2], nodes[node, 3])
    return node


def _score(bins: np.ndarray, nodes: np.ndarray, values: np.ndarray, roots: list[int], depth: int) -> np.ndarray:
    out = np.zeros(len(bins))
    for at in range(0, len(bins) if roots else 0, 4096):
        out[at : at + 4096] = values[_walk(bins[at : at + 4096], nodes, roots, depth)].sum(axis=1)
    return out


def _level_sums(bins: np.ndarray, y: np.ndarray, score: np.ndarray, nodes: np.ndarray, root: int, level: int, front: list[int]) -> np.ndarray:
    """First and second derivatives of the loss, in units, by node of the front, feature and bin."""
    place = np.full(len(nodes), -1)
    place[front] = np.arange(len(front))
    own = place[_walk(bins, nodes, [root], level)[:, 0]]
    bins, y, score, own = bins[own >= 0], y[own >= 0], score[own >= 0], own[own >= 0]
    p = 1 / (1 + np.exp(-score))
    out = np.zeros((len(front), 2, bins.shape[1], BINS), np.int64)
    for k, value in enumerate((p - y, np.maximum(p * (1 - p), 1e-6))):
        units = np.rint(value * UNIT)  # sums of a chunk stay below 2**53
        for f in range(bins.shape[1]):
            out[:, k, f] = np.bincount(own * BINS + bins[:, f], units, len(front) * BINS).reshape(len(front), BINS).astype(np.int64)
    return out


def _boosted(sums: Callable, edges: list[np.ndarray], share: float, monotone: np.ndarray, trees: int = 60, depth: int = 3, rate: float = 0.15, l2: float = 1.0, least: float = 2.0) -> RuleTrees:
    """Newton boosting for the logistic loss; a split that breaks a feature's direction is not taken, and children keep to their side of its midpoint.

    ``sums`` gives _level_sums over all rows for the trees so far, of which the last one grows.
    """
    share = np.clip(share, 1e-3, 1 - 1e-3)
    bias = float(np.log(share / (1 - share)))
    nodes, roots = [], []
    value = lambda g, h, low, high: np.clip(-g / (h + l2), low, high)

    def leaf(v: float) -> int:
        nodes.append([0, np.inf, len(nodes), len(nodes), rate * v, BINS])
        return len(nodes) - 1

    for _ in range(trees):
        roots.append(leaf(0.0))
        front = [(roots[-1], -4.0, 4.0)]
        for level in range(depth):
            if not front:
                break
            flat = np.array([[n[0], n[5], n[2], n[3]] for n in nodes], np.int64)
            found = sums(flat, np.array([n[4] for n in nodes]), roots, bias, depth, level, [n for n, _, _ in front]) / UNIT
            after = []
            for (me, low, high), (gs_of, hs_of) in zip(front, found, strict=True):
                g, h = gs_of[0].sum(), hs_of[0].sum()
                if not level:
                    nodes[me][4] = rate * float(value(g, h, low, high))
                best = (1e-3, None)
                for f, edge in enumerate(edges):
                    if not len(edge):
                        continue
                    gs, hs = np.cumsum(gs_of[f])[: len(edge)], np.cumsum(hs_of[f])[: len(edge)]
                    gain = gs**2 / (hs + l2) + (g - gs) ** 2 / (h - hs + l2) - g**2 / (h + l2)
                    lv, rv = value(gs, hs, low, high), value(g - gs, h - hs, low, high)
                    gain[(hs < least) | (h - hs < least) | (monotone[f] * (rv - lv) < 0)] = -np.inf
                    if gain[k := int(np.argmax(gain))] > best[0]:
                        best = (float(gain[k]), (f, k, float(lv[k]), float(rv[k])))
                if best[1]:
                    f, k, lv, rv = best[1]
                    mid = (lv + rv) / 2
                    bounds = {1: ((low, mid), (mid, high)), -1: ((mid, high), (low, mid)), 0: ((low, high), (low, high))}[int(monotone[f])]
                    left, right = leaf(lv), leaf(rv)
                    nodes[me][:4], nodes[me][5] = [f, float(edges[f][k]), left, right], k
                    after += [(left, *bounds[0]), (right, *bounds[1])]
            front = after
    return _trees([n[:5] for n in nodes], roots, depth, bias)


def fit_trees(x: np.ndarray, y: np.ndarray, monotone: np.ndarray, edges: list[np.ndarray] | None = None, **options) -> RuleTrees:
    """Trees boosted on rows at hand, over quantile bins unless edges are given."""
    edges = edges or [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
    bins, score, done = _bins(x, edges), np.zeros(len(x)), 0

    def sums(nodes: np.ndarray, values: np.ndarray, roots: list[int], bias: float, depth: int, level: int, front: list[int]) -> np.ndarray:
        nonlocal score, done
        score, done = score + _score(bins, nodes, values, roots[done:-1], depth), len(roots) - 1
        return sum(_level_sums(bins[at : at + CHUNK_ROWS], y[at : at + CHUNK_ROWS], bias + score[at : at + CHUNK_ROWS], nodes, roots[-1], level, front) for at in range(0, len(x), CHUNK_ROWS))

    return _boosted(sums, edges, y.mean(), monotone, **options)


def quantile_edges(rows: DataFrame) -> list[np.ndarray]:
    """Each feature's quantiles over all rows, from counts by cell of a fixed grid: some thousand cells a feature, however many rows."""
    n = len(FEATURES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = [(np.asarray(batch.column(f), np.float32).view(np.uint32) >> _CELL).astype(np.int64) * n + k for k, f in enumerate(FEATURES)]
            found, count = np.unique(np.concatenate(cells), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(count, pa.int64())], names=["cell", "n"])

    counts = rows.select(*FEATURES).mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toPandas().sort_values("cell")
    cell, rows_in, edges = counts["cell"].to_numpy(), counts["n"].to_numpy(), []
    for k in range(n):
        own = cell % n == k
        top, upto = ((((cell[own] // n) + 1) << _CELL) - 1).astype(np.uint32).view(np.float32).astype(float), np.cumsum(rows_in[own])
        at = np.searchsorted(upto, np.linspace(0, 1, BINS + 1)[1:-1] * upto[-1], "left")
        edges.append(np.unique(top[at]))
    return edges


def fit_spread_trees(rows: DataFrame, share: float, monotone: np.ndarray, **options) -> RuleTrees:
    """fit_trees over a table of statistics and _quality, whose rows stay in their tasks: a job a level gives back sums."""
    edges, n = quantile_edges(rows), len(FEATURES)

    def chunk(rows: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([np.ascontiguousarray(v).tobytes()], pa.binary()) for v in (rows[:, :n], rows[:, n])], names=["bins", "y"])

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((0, n + 1), np.uint8)
        for batch in batches:
            bins = _bins(np.stack([np.asarray(batch.column(f), float) for f in FEATURES], axis=1), edges)
            held = np.vstack([held, np.column_stack([bins, np.asarray(batch.column("_quality")).astype(np.uint8)])])
            while len(held) >= CHUNK_ROWS:
                yield chunk(held[:CHUNK_ROWS])
                held = held[CHUNK_ROWS:]
        if len(held):
            yield chunk(held)

    table = written(rows.mapInArrow(binned, "bins binary, y binary"), "op4-bins")
    table = table.coalesce(table.sparkSession.sparkContext.defaultParallelism)

    def sums(nodes: np.ndarray, values: np.ndarray, roots: list[int], bias: float, depth: int, level: int, front: list[int]) -> np.ndarray:
        shape, done = (len(front), 2, n, BINS), roots[:-1]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out = np.zeros(shape, np.int64)
            for batch in batches:
                for data, labels in zip(batch.column("bins"), batch.column("y"), strict=True):
                    bins, y = np.frombuffer(data.as_py(), np.uint8).reshape(-1, n), np.frombuffer(labels.as_py(), np.uint8)
                    out += _level_sums(bins, y, bias + _score(bins, nodes, values, done, depth), nodes, roots[-1], level, front)
            yield pa.RecordBatch.from_arrays([pa.array([out.tobytes()], pa.binary())], names=["sums"])

        return sum(np.frombuffer(r["sums"], np.int64).reshape(shape) for r in table.mapInArrow(run, "sums binary").collect())  # a row a task, of tasks as many as cores

    return _boosted(sums, edges, share, monotone, **options)


def _trees(nodes: list[list], roots: list[int], depth: int, bias: float) -> RuleTrees:
    f, t, left, right, v = map(np.array, zip(*nodes, strict=True))
    return RuleTrees(f.astype(int), t.astype(float), left.astype(int), right.astype(int), v.astype(float), np.array(roots), depth, bias)


def document_stats(docs: DataFrame, trees: RuleTrees | None = None, min_score: float = 0.0, keep_columns: list[str] | None = None) -> DataFrame:
    """doc_id (or keep_columns), the statistics, and with trees the score and ``kept``.

    A row's own columns of these names give way to the statistics.
    """
    keep = keep_columns if keep_columns is not None else ["doc_id"]
    names = [s.split()[0] for s in STATS_TYPE.split(", ")]
    schema = ", ".join([*(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep), STATS_TYPE, "score double", "base_failed boolean", "kept boolean"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tx.chunks(batches):
            stats = stats_of(*tx.flat(batch.column("text")))
            x = np.stack([stats[f] for f in FEATURES], axis=1)
            score = trees.score(x) if trees else np.zeros(len(x))
            failed = (stats["n_words"] < MIN_WORDS) | (100 * stats["n_repeat_words"] > REPEAT_PERCENT * stats["n_words"])
            values = [pa.array(stats[c], pa.float64() if c in FEATURES else pa.int64()) for c in names]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), *values, pa.array(score), pa.array(failed), pa.array(~failed & (score >= min_score))], names=[*keep, *names, "score", "base_failed", "kept"])

    return docs.select(*dict.fromkeys([*keep, "text"])).mapInArrow(run, schema)


def fit_rules(docs: DataFrame, labels: DataFrame, local_rows: int = LOCAL_ROWS) -> RuleTrees | None:
    """Trees that tell quality 1 from 0, from all labelled documents; None when either is missing among the labels."""
    known = labels.where("doc_id is not null and quality in (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("_quality"))
    texts = docs.select("doc_id", "text")
    if known.count() <= MAX_BROADCAST_LABELS:
        stats = document_stats(texts.join(F.broadcast(known), "doc_id"), keep_columns=["doc_id", "_quality"])
    else:
        stats = document_stats(texts).join(known, "doc_id")
    # a doc_id counts once, by its least statistics, however many rows it has; no text is shuffled
    once = stats.groupBy("doc_id").agg(F.min(F.struct(F.col("_quality").cast("int").alias("_quality"), *FEATURES)).alias("_r")).select("_r.*")
    rows = written(once, "op4-features")
    n, good = rows.agg(F.count("*"), F.sum("_quality")).first()
    if not n or good in (0, n):
        return None
    monotone = np.array([MONOTONE.get(f, 0) for f in FEATURES])
    if n > local_rows:
        return fit_spread_trees(rows, good / n, monotone)
    few = rows.toPandas()
    return fit_trees(few[list(FEATURES)].to_numpy(float), few["_quality"].to_numpy(float), monotone)


def quality_rules(docs: DataFrame, labels: DataFrame, local_rows: int = LOCAL_ROWS, min_score: float = 0.0) -> DataFrame:
    """doc_id, the counts, score, base_failed and kept of every document."""
    return document_stats(docs, fit_rules(docs, labels, local_rows), min_score)
