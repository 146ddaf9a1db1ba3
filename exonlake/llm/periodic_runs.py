"""Runs of repeated words: maximal stretches of a period that repeats three times or more.

The words of a chunk of documents, each document closed by a word of its own, are compressed
into a run-length grammar by recompression: blocks of one letter become a letter with a count,
then every letter falls to one of two sides and neighbours from the first to the second side
become one letter, and so on until one letter is left.  Equal stretches are parsed alike but
for their rims, so the longest common extension of two places, onwards or backwards, climbs
the grammar while both places begin (or end) a letter, and descends where the letters differ:
a few steps a level, for all places asked at once.

Candidates stand on the harmonic grid: a run of period q holds a multiple t of q so that the
eight words from t are those from t + q, as it is at least max(24, 3q) long.  Documents in which
no eight words repeat have no run; of the others, grid places whose eight words hash alike at
both places are asked for their extensions, which are exact.  Of a period's places only those
that no extension has covered yet are asked.  Runs of one stretch share their smallest period.

A document with h = crc32(decimal doc_id) divisible by 10 is rewritten first (``rewritten``), as a
planted case: the contract of the query asks so.

Defined cases: a null, empty or blank text has no words and no run; a null doc_id is not
rewritten; repeated rows are each reported; a long document is a chunk of its own; an empty
table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .textops import chunks, mix

MIN_LENGTH, MIN_EXPONENT = 24, 3
#: Words that must repeat at a grid place; MIN_LENGTH and MIN_EXPONENT warrant as many.
GRAM = 8
#: Grid places that one step works on.
GRID_STEP = 1 << 21
SCHEMA = "doc_id long, n_runs long, start long, period long, length long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"


class Grammar:
    """The levels of a sequence of letters under recompression, and extensions found by climbing and descending them."""

    def __init__(self, letters: np.ndarray):
        self.letters: list[np.ndarray] = []  # of each level
        self.up: list[np.ndarray] = []  # place of each letter's parent, a level up
        self.down: list[np.ndarray] = []  # first child of each letter of the level above, and the end
        self.blocks: list[bool] = []  # whether the level above is of blocks
        self.size = len(letters)
        now, turn = self._named(letters), 0
        while len(now) > 1:
            opens = np.ones(len(now), bool)
            blocks = turn % 2 == 0
            if blocks:
                opens[1:] = now[1:] != now[:-1]
            else:
                second = (mix(now.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15 * turn & (1 << 64) - 1)) >> np.uint64(63)).astype(bool)
                opens[1:] = second[:-1] | ~second[1:]
            turn += 1
            if opens.all():
                continue
            first = np.flatnonzero(opens)
            ends = np.append(first[1:], len(now))
            size = ends - first
            tail = size if blocks else np.where(size == 2, now[ends - 1] + 1, 0)
            self.letters.append(now.astype(np.int32))
            self.blocks.append(blocks)
            self.up.append(np.repeat(np.arange(len(first), dtype=np.int32), size))
            self.down.append(np.append(first, len(now)).astype(np.int32))
            now = self._named(now[first] * (len(now) + 2) + tail)

    @staticmethod
    def _named(names: np.ndarray) -> np.ndarray:
        return np.unique(names, return_inverse=True)[1].astype(np.int64)

    def _edge(self, k: int, x: np.ndarray, back: bool) -> np.ndarray:
        """Whether the letters at x begin (or, if back, end) their parents."""
        parent = self.up[k][x]
        return self.down[k][parent + 1] - 1 == x if back else self.down[k][parent] == x

    def _alike(self, k: int, x: np.ndarray, y: np.ndarray, back: bool) -> np.ndarray:
        """Steps for which x and y go on alike within their parents: of a block the rest that both have, else one letter."""
        same = self.letters[k][x] == self.letters[k][y]
        if not self.blocks[k]:
            return same.astype(np.int64)
        rest = lambda z: z - self.down[k][self.up[k][z]] + 1 if back else self.down[k][self.up[k][z] + 1] - z
        return np.where(same, np.minimum(rest(x), rest(y)), 0)

    def extension(self, i: np.ndarray, j: np.ndarray, back: bool = False) -> np.ndarray:
        """How many letters from places i on are those from places j on; or, if back, before i those before j.

        Places differ, and every stretch asked for meets a letter that stands nowhere else before the sequence ends.
        """
        step = -1 if back else 1
        a, b = (i - 1, j - 1) if back else (i.copy(), j.copy())
        turned = np.zeros(len(a), np.int64)
        live = np.arange(len(a))
        for k in range(len(self.letters)):  # a pair climbs while both begin a parent, after one step at most
            x, y = a[live], b[live]
            inside = ~(self._edge(k, x, back) & self._edge(k, y, back))
            move = np.where(inside, self._alike(k, x, y, back), 0)
            x, y = x + step * move, y + step * move
            climbs = ~inside | ((move > 0) & self._edge(k, x, back) & self._edge(k, y, back))
            a[live], b[live] = x, y
            turned[live[~climbs]] = k
            live = live[climbs]
            if not len(live):
                break
            a[live], b[live] = self.up[k][x[climbs]], self.up[k][y[climbs]]
        for k in range(int(turned.max(initial=0)), -1, -1):  # where the letters differ, down to their children, and one step at most
            here = np.flatnonzero(turned >= k)
            x, y = a[here], b[here]
            move = step * self._alike(k, x, y, back)
            x, y = x + move, y + move
            if k:
                first = self.down[k - 1]
                x, y = (first[x + 1] - 1, first[y + 1] - 1) if back else (first[x], first[y])
            a[here], b[here] = x, y
        return (i - 1 - a) if back else (a - i)


def gram_names(letters: np.ndarray) -> np.ndarray:
    """Hashes of the GRAM letters from each place on, by doubling; the last places have none and get the place's own."""
    out = mix(letters.astype(np.uint64) + np.uint64(1))
    size = 1
    while size < min(GRAM, len(out)):
        out[: len(out) - size] = mix(out[: len(out) - size] * np.uint64(0x9E3779B97F4A7C15) + out[size:])
        size *= 2
    return out


def grid(starts: np.ndarray, sizes: np.ndarray, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """place, period and number of (document, period) of the grid places whose grams are alike a period apart, in order."""
    periods = np.maximum(sizes // MIN_EXPONENT, 0)
    of = np.repeat(np.arange(len(sizes)), periods)
    q = np.arange(len(of)) - np.repeat(np.cumsum(periods) - periods, periods) + 1
    n = np.maximum((sizes[of] - GRAM - q) // q + 1, 0)
    ends = np.cumsum(n)
    found, at = [], 0
    while at < len(of):
        done = ends[at - 1] if at else 0
        upto = max(at + 1, int(np.searchsorted(ends, done + GRID_STEP, "right")))
        pair = np.repeat(np.arange(at, upto), n[at:upto])
        k = np.arange(len(pair)) - np.repeat(ends[at:upto] - n[at:upto] - done, n[at:upto])
        place = starts[of[pair]] + k * q[pair]
        hit = np.flatnonzero(grams[place] == grams[place + q[pair]])
        found.append((place[hit], q[pair[hit]], pair[hit]))
        at = upto
    return tuple(np.concatenate(x) if found else np.zeros(0, np.int64) for x in (zip(*found, strict=True) if found else ((), (), ())))


def runs_of(letters: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """start, end and smallest period of all runs, by start and period.

    Stretches [start, start + size) of letters are documents; a letter that stands nowhere else is
    before the first and behind each.
    """
    place, q, pair = grid(starts, sizes, gram_names(letters))
    if not len(place):
        return place, place, place
    grammar, found, rounds = Grammar(letters), [], 0
    while len(place):
        rounds += 1
        first = np.ones(len(pair), bool)
        first[1:] = (pair[1:] != pair[:-1]) | (rounds > 4)  # where a period has many stretches, all places left are asked at once
        p, d = place[first], q[first]
        ends = np.concatenate([p[k : k + GRID_STEP // 8] + grammar.extension(p[k : k + GRID_STEP // 8], (p + d)[k : k + GRID_STEP // 8]) for k in range(0, len(p), GRID_STEP // 8)])
        begins = np.concatenate([p[k : k + GRID_STEP // 8] - grammar.extension(p[k : k + GRID_STEP // 8], (p + d)[k : k + GRID_STEP // 8], back=True) for k in range(0, len(p), GRID_STEP // 8)])
        found.append((begins, ends + d, d))
        rest = place > ends[np.cumsum(first) - 1]
        rest &= ~first
        place, q, pair = place[rest], q[rest], pair[rest]
    start, end, q = (np.concatenate(x) for x in zip(*found, strict=True))
    long = end - start >= np.maximum(MIN_LENGTH, MIN_EXPONENT * q)
    start, end, q = start[long], end[long], q[long]
    order = np.lexsort((q, end, start))
    start, end, q = start[order], end[order], q[order]
    new = np.ones(len(start), bool)
    new[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    start, end, q = start[new], end[new], q[new]
    order = np.lexsort((q, start))
    return start[order], end[order], q[order]


def rewritten(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The words with a tail made periodic, if the hash of the id says so."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    n = len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    unit = words[a : a + p]
    return words[:a] + (unit * ((n - a) // len(unit) + 1))[: n - a]


def _best(runs: list[tuple[int, int, int]]) -> tuple[int, int, int]:
    """(start, length, period) of the greatest length / period; of equal ones the first in order of start, then period."""
    best = runs[0]
    for run in runs[1:]:
        if run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def _chunk(batch: pa.RecordBatch) -> pa.RecordBatch:
    ids = batch.column("doc_id").to_pylist()
    texts = batch.column("text").cast(pa.large_binary()).to_pylist()
    names: defaultdict[bytes, int] = defaultdict(count().__next__)
    docs = [rewritten((t or b"").split(), i) for t, i in zip(texts, ids, strict=True)]  # bytes are split at the six separators
    letters = [np.fromiter(map(names.__getitem__, w), np.int64, len(w)) for w in docs]
    sizes = np.array([len(w) for w in docs], np.int64)
    # only documents in which some gram repeats
    grams = [np.sort(gram_names(x)[: len(x) - GRAM + 1]) if len(x) >= MIN_LENGTH else x[:0] for x in letters]
    chosen = np.flatnonzero([bool((g[1:] == g[:-1]).any()) for g in grams])
    runs: dict[int, list[tuple[int, int, int]]] = {}
    if len(chosen):
        parts, alone = [np.array([len(names)])], len(names) + 1
        for d in chosen:
            parts += [letters[d], np.array([alone])]
            alone += 1
        starts = np.cumsum(sizes[chosen] + 1) - sizes[chosen]
        start, end, q = runs_of(np.concatenate(parts), starts, sizes[chosen])
        of = np.searchsorted(starts, start, "right") - 1
        for d, s, e, p in zip(chosen[of].tolist(), (start - starts[of]).tolist(), (end - starts[of]).tolist(), q.tolist(), strict=True):
            runs.setdefault(d, []).append((s, e - s, p))
    rows = []
    for d, (i, words) in enumerate(zip(ids, docs, strict=True)):
        own = runs.get(d, [])
        if own:
            change = np.zeros(len(words) + 1, np.int64)
            s, n, p = np.array(own).T
            np.add.at(change, s + p, 1)
            np.add.at(change, s + n, -1)
            words = [words[k] for k in np.flatnonzero(np.cumsum(change[:-1]) == 0)]
        best = _best(own) if own else (None, None, None)
        listed = "".join(f"{s},{n},{p}\n" for s, n, p in own)
        rows.append((i, len(own), best[0], best[2], best[1], 1000 * best[1] // best[2] if own else None, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(b" ".join(words)).hexdigest()))
    types = [pa.int64()] * 6 + [pa.string()] * 2
    columns = [f.split()[0] for f in SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows, strict=True), types, strict=True)], columns)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches):
        yield _chunk(batch)


def periodic_runs(docs: DataFrame) -> DataFrame:
    """doc_id, n_runs, the run of the greatest exponent (start, period, length, exponent_milli; nulls without one), runs_sha256 and collapsed_sha256 of every document."""
    return docs.selectExpr("cast(doc_id as long) as doc_id", "text").mapInArrow(_runs, SCHEMA)
