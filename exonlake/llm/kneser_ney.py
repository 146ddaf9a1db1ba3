"""Quality classifier: an interpolated modified Kneser-Ney model of characters, and thresholds by language.

N-grams are of characters, not words: their number is bounded by the alphabet, so the
model's tables stay small beside the corpus.  A gram is a long of 12 bits a character
(code points fold to 4096 classes, white space runs to one space, texts begin with
``ORDER - 1`` marks), so contexts and suffixes are shifts and masks and all counts are
joined as sharded tables:

1. tasks count grams of all trusted documents; sums are grouped by gram;
2. lower orders hold continuation counts; discounts come from counts of counts;
3. each order joins its contexts' totals and the order below to probabilities;
4. documents are scored against the tables: sent to every task while they have at most
   ``MAX_BROADCAST_ROWS`` rows (checked), else by joining every document's grams with
   the sharded tables, order by order, with equal results;
5. a document is kept if its perplexity is at most the ``quantile`` of trusted documents
   of its language that the model has not seen: one in ``HELD_OUT`` trusted documents, by
   hash of its id, is not trained on but gives the thresholds.  A language with fewer than
   ``LEAST`` of them takes the quantile of all of them; where there are none at all, that
   of the trained ones.

Defined cases: null or empty texts have no grams, a null perplexity, and are not kept;
a null language is a language of its own; of a document labelled twice the lower label
counts, nulls do not; repeated rows are scored each; without trusted text nothing has
a threshold and every text with grams is kept; an empty table gives an empty result;
further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from . import textops as tx
from .store import written

ORDER = 5
QUANTILE = 0.995
HELD_OUT, LEAST = 4, 30
#: Grams that a task counts at once.
HELD = 500_000
MAX_BROADCAST_ROWS = 8_000_000
MAX_BROADCAST_IDS = 1_000_000
_BITS, _CLASSES, _BEGIN = 12, 4096, 2


def _classes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Character classes of all texts with their marks, and each row's first and past-last place."""
    data, offsets = tx.flat(column)
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    rank = np.concatenate([[0], np.cumsum(tx.code_points(data))])
    bounds = rank[offsets]
    c = np.where(points < 2048, points, 2048 + points % 2048).astype(np.int64)
    space = (c == 32) | ((c >= 9) & (c <= 13))
    c[space] = 32
    keep = np.ones(len(c), bool)
    keep[1:] = ~(space[1:] & space[:-1])
    heads = bounds[:-1][bounds[:-1] < len(c)]
    keep[heads] = True
    kept = np.concatenate([[0], np.cumsum(keep)])[bounds]
    sizes = np.diff(kept)
    start = kept[:-1] + (ORDER - 1) * np.arange(1, len(kept))
    out = np.full(len(points[keep]) + (ORDER - 1) * len(sizes), _BEGIN, np.int64)
    out[np.repeat(start - kept[:-1], sizes) + np.arange(kept[-1])] = c[keep]
    return out, np.stack([start, start + sizes])


def grams_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, gram) for every character of every text."""
    c, (start, end) = _classes(column)
    sizes = end - start
    row = np.repeat(np.arange(len(sizes)), sizes)
    at = np.arange(len(row)) + np.repeat(start - (np.cumsum(sizes) - sizes), sizes)
    gram = np.zeros(len(at), np.int64)
    for k in range(ORDER - 1, -1, -1):
        gram = (gram << _BITS) | c[at - k]
    return row, gram


def gram_counts(docs: DataFrame) -> DataFrame:
    """(gram, c) over all texts of docs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def counted() -> pa.RecordBatch:
            gram, c = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(gram), pa.array(c)], names=["gram", "c"])

        for batch in tx.chunks(batches):
            held.append(grams_of(batch.column("text"))[1])
            if sum(map(len, held)) > HELD:
                yield counted()
        if held:
            yield counted()

    return docs.select("text").mapInArrow(run, "gram long, c long").groupBy("gram").agg(F.sum("c").alias("c"))


def _discounts(counts: DataFrame) -> list[float]:
    """D1, D2 and D3+ from the counts of counts."""
    n = {int(r["c"]): r["n"] for r in counts.where("c <= 4").groupBy("c").agg(F.count("*").alias("n")).collect()}  # four rows at most
    n1, n2, n3, n4 = (n.get(k, 0) for k in (1, 2, 3, 4))
    y = n1 / (n1 + 2 * n2) if n1 else 0.5
    ratio = lambda a, b: a / b if b else 0.0
    return [min(max(d, 0.05), k - 0.05) for k, d in ((1, 1 - 2 * y * ratio(n2, n1)), (2, 2 - 3 * y * ratio(n3, n2)), (3, 3 - 4 * y * ratio(n4, n3)))]


def fit_model(trusted: DataFrame) -> DataFrame:
    """(kind, level, gram, value): kind p has log-probabilities of grams, kind g the log-weights that contexts give the order below."""
    counts = {ORDER: written(gram_counts(trusted), "op3-counts")}
    for level in range(ORDER - 1, 0, -1):
        suffix = F.col("gram").bitwiseAND((1 << _BITS * level) - 1)
        counts[level] = written(counts[level + 1].groupBy(suffix.alias("gram")).agg(F.count("*").alias("c")), f"op3-counts{level}")
    parts, lower = [], None
    for level in range(1, ORDER + 1):
        d1, d2, d3 = _discounts(counts[level])
        context = F.shiftright("gram", _BITS).alias("context")
        discount = F.when(F.col("c") == 1, d1).when(F.col("c") == 2, d2).otherwise(d3)
        totals = counts[level].groupBy(context).agg(F.sum("c").alias("total"), (F.sum(discount) / F.sum("c")).alias("weight"))
        own = counts[level].select("gram", "c", context, F.col("gram").bitwiseAND((1 << _BITS * (level - 1)) - 1).alias("suffix")).join(totals, "context")
        if lower is None:
            p = F.lit(1.0 / _CLASSES)
        else:
            own, p = own.join(lower.select(F.col("gram").alias("suffix"), F.col("p").alias("_p")), "suffix"), F.col("_p")
        lower = written(own.select("gram", ((F.col("c") - discount) / F.col("total") + F.col("weight") * p).alias("p")), f"op3-p{level}")
        parts.append(lower.select(F.lit("p").alias("kind"), F.lit(level).alias("level"), "gram", F.log("p").alias("value")))
        parts.append(totals.select(F.lit("g").alias("kind"), F.lit(level).alias("level"), F.col("context").alias("gram"), F.log("weight").alias("value")))
    model = parts[0]
    for part in parts[1:]:
        model = model.unionByName(part)
    return written(model, "op3-model")


def _scores_sent(docs: DataFrame, keep: list[str], model: DataFrame) -> DataFrame:
    rows = model.toArrow()
    tables = {}
    for kind in "pg":
        for level in range(1, ORDER + 1):
            part = rows.filter((pc.field("kind") == kind) & (pc.field("level") == level))
            gram = part.column("gram").to_numpy()
            order = np.argsort(gram)
            tables[kind, level] = gram[order], part.column("value").to_numpy()[order].astype(np.float32)
    shared = docs.sparkSession.sparkContext.broadcast(tables)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = shared.value

        def look(kind: str, level: int, gram: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            known, value = tables[kind, level]
            if not len(known):
                return np.zeros(len(gram), bool), np.zeros(len(gram), np.float32)
            at = np.minimum(np.searchsorted(known, gram), len(known) - 1)
            return known[at] == gram, value[at]

        for batch in tx.chunks(batches):
            row, gram = grams_of(batch.column("text"))
            gram, back = np.unique(gram, return_inverse=True)
            total, left = np.zeros(len(gram)), np.arange(len(gram))
            for level in range(ORDER, 0, -1):
                own = gram[left] & ((1 << _BITS * level) - 1)
                found, value = look("p", level, own)
                total[left[found]] += value[found]
                left, own = left[~found], own[~found]
                found, value = look("g", level, own >> _BITS)
                total[left[found]] += value[found]
            total[left] -= np.log(_CLASSES)
            n = np.bincount(row, minlength=batch.num_rows)
            logp = np.bincount(row, total[back], batch.num_rows)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(n), pa.array(logp)], names=[*keep, "n_grams", "logp"])

    schema = ", ".join([*(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep), "n_grams long, logp double"])
    return docs.select(*keep, "text").mapInArrow(run, schema)


def _scores_joined(docs: DataFrame, keep: list[str], model: DataFrame) -> DataFrame:
    """The same by joins of every document's gram counts with the sharded tables."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tx.chunks(batches):
            row, gram = grams_of(batch.column("text"))
            order = np.lexsort((gram, row))
            row, gram = row[order], gram[order]
            first = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (gram[1:] != gram[:-1])])) if len(row) else np.zeros(0, int)
            n = np.diff(np.append(first, len(row)))
            yield pa.RecordBatch.from_arrays([batch.column("_row").take(pa.array(row[first])), pa.array(gram[first]), pa.array(n)], names=["_row", "gram", "n"])

    rows = written(docs.select(*keep, "text").withColumn("_row", F.monotonically_increasing_id()), "op3-rows")
    left = rows.select("_row", "text").mapInArrow(run, "_row long, gram long, n long").withColumn("add", F.lit(0.0))
    sums = None
    for level in range(ORDER, 0, -1):
        own = F.col("gram").bitwiseAND((1 << _BITS * level) - 1)
        p = model.where(f"kind = 'p' and level = {level}").select(F.col("gram").alias("_g"), F.col("value").cast("float").cast("double").alias("_p"))
        g = model.where(f"kind = 'g' and level = {level}").select(F.col("gram").alias("_c"), F.col("value").cast("float").cast("double").alias("_w"))
        seen = left.withColumn("_own", own).join(p, F.col("_own") == F.col("_g"), "left")
        part = seen.where("_g is not null").groupBy("_row").agg(F.sum("n").alias("n"), F.sum(F.col("n") * (F.col("add") + F.col("_p"))).alias("logp"))
        sums = part if sums is None else sums.unionByName(part)
        left = seen.where("_g is null").withColumn("_x", F.shiftright("_own", _BITS)).join(g, F.col("_x") == F.col("_c"), "left").select("_row", "gram", "n", (F.col("add") + F.coalesce("_w", F.lit(0.0))).alias("add"))
    last = left.groupBy("_row").agg(F.sum("n").alias("n"), F.sum(F.col("n") * (F.col("add") - float(np.log(_CLASSES)))).alias("logp"))
    sums = sums.unionByName(last).groupBy("_row").agg(F.sum("n").alias("n_grams"), F.sum("logp").alias("logp"))
    return rows.join(sums, "_row", "left").select(*keep, F.coalesce("n_grams", F.lit(0)).alias("n_grams"), F.coalesce("logp", F.lit(0.0)).alias("logp"))


def classify(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE, max_broadcast_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """doc_id, lang, n_grams, perplexity, threshold and kept of every document."""
    good = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("_q")).where("_q = 1").select("doc_id", F.lit(True).alias("_trusted"))
    good = F.broadcast(good) if good.count() <= MAX_BROADCAST_IDS else good
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "text")
    held_out = F.pmod(F.xxhash64("doc_id", F.lit("held out")), F.lit(HELD_OUT)) == 0
    model = fit_model(rows.where(~held_out).join(good, "doc_id").where("text is not null"))
    score = _scores_sent if model.count() <= max_broadcast_rows else _scores_joined
    scored = written(score(rows.join(good, "doc_id", "left"), ["doc_id", "lang", "_trusted"], model), "op3-scores")
    scored = scored.withColumn("perplexity", F.when(F.col("n_grams") > 0, F.exp(-F.col("logp") / F.greatest("n_grams", F.lit(1))))).withColumn("_lang", F.coalesce("lang", F.lit("")))
    limit = F.percentile_approx("perplexity", quantile, 10000)
    known = scored.where("_trusted and n_grams > 0")
    own = written(known.where(held_out).groupBy("_lang").agg(F.count("*").alias("_n"), limit.alias("_own")).where(F.col("_n") >= LEAST).drop("_n"), "op3-limits")
    own = F.broadcast(own) if own.count() <= MAX_BROADCAST_IDS else own  # a row a language
    every = known.where(held_out).agg(limit.alias("_all")).first()[0]
    if every is None:
        every = known.agg(limit.alias("_all")).first()[0]
    out = scored.join(own, "_lang", "left").withColumn("threshold", F.coalesce("_own", F.lit(every).cast("double")))
    return out.select("doc_id", "lang", "n_grams", "perplexity", "threshold", (F.col("perplexity").isNotNull() & F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(True))).alias("kept"))
