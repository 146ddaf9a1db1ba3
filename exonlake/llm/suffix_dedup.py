"""Removal of byte strings that occur again, by range-partitioned sorted suffixes.

Every 200-byte string has an anchor: the place in it whose ``LEAD`` bytes have the
least hash (leftmost of ties).  Equal strings have equal anchors, so each anchor
suffix stands for a run of consecutive strings, its segment:

1. anchors whose leading bytes stand anywhere else are kept;
2. segments that are equal as a whole are repeated throughout and fold into one;
3. what differs is range-partitioned by its ``LEAD`` leading bytes, from the anchor on, at
   sampled splitters, as many buckets as its bytes fill, and each bucket sorts the strings
   of its segments by multikey quicksort, eight bytes a character and equal parts only
   going on; equal leading bytes are never split between buckets, so that the strings at a
   boundary need no comparison with the next bucket's;
4. leading bytes with over ``HOT`` different segments would make a bucket too large:
   their segments are cut into parts of ``PART`` strings, and parts whose common bytes
   stand nowhere else go, equal parts fold, and the strings of the rest are counted by
   digest over all tasks, which is exact too.

Strings are told apart by their bytes (in 4 and for whole segments by 128 bits).

Defined cases: null or short texts keep everything; matches never cross documents; a
document counts once for each row it has; doc_id may be null or repeat; ties need no
order; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import textops as tx
from .store import written

LEAD = tx.WINDOW
#: Different segments of one anchor that a bucket sorts; more go by digest.
HOT = 1500
#: Bytes of segments in a bucket, about.
BUCKET_BYTES = 8 << 20
#: Strings of a part of a hot segment.
PART = 16
#: Strings that one sort works on, about.
SORT_STRINGS = 300_000
#: Document ids that may be broadcast to fetch texts; beyond, the join shuffles.
MAX_BROADCAST_IDS = 1_000_000
_KEY = ["doc_id", "th"]
_SEGMENT = ["lead", "digest", "size", "off"]


def anchors(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """row, anchor, first and last string start, lead hash and segment hash of every anchor."""
    n = len(data)
    if n < length:
        return tuple(np.zeros(0, np.int64) for _ in range(4)) + (np.zeros(0, np.uint64),) * 2
    value = windows = tx.window_hash(data)
    place = np.arange(n - LEAD + 1, dtype=np.int32)
    width, step = length - LEAD + 1, 1
    while 2 * step <= width:
        value, place = _least(value[:-step], value[step:], place[:-step], place[step:])
        step *= 2
    if rest := width - step:
        value, place = _least(value[:-rest], value[rest:], place[:-rest], place[rest:])
    ends = np.repeat(offsets[1:], np.diff(offsets))[: len(place)]
    valid = np.arange(len(place)) + length <= ends
    change = np.ones(len(place), bool)
    change[1:] = (place[1:] != place[:-1]) | (valid[1:] != valid[:-1])
    # the strings of the last document end before the next begins, so a change of row is a gap in valid
    first = np.flatnonzero(change & valid)
    last = np.append(np.flatnonzero(change)[1:], len(place))[np.searchsorted(np.flatnonzero(change), first)] - 1
    row = np.searchsorted(offsets, first, "right") - 1
    return row, place[first].astype(np.int64), first, last, value[first], tx.windows_span(windows, first, last + length)


def _least(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    left = a <= b
    return np.where(left, a, b), np.where(left, i, j)


def _anchor_rows(docs: DataFrame, length: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tx.chunks(batches):
            _, offsets = own = tx.flat(batch.column("text"))
            row, place, first, last, lead, digest = anchors(*own, length)
            if len(row):
                rows = pa.array(row)
                ints = (pa.array(x.astype(np.int32)) for x in (last - first, place - first, first - offsets[row]))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(rows), batch.column("th").take(rows), pa.array(lead.view(np.int64)), pa.array(digest.view(np.int64)), *ints], names=[*_KEY, *_SEGMENT, "lo"])

    return docs.mapInArrow(run, "doc_id long, th long, lead long, digest long, size int, off int, lo int")


def repeated(data: np.ndarray, start: np.ndarray, group: np.ndarray, length: int) -> np.ndarray:
    """Which of the strings data[start : start + length] occur twice or more in their group: multikey quicksort on eight bytes at a time."""
    eight = np.zeros(max(0, len(data) - 7), np.uint64)
    for k in range(8):
        eight |= data[k : len(eight) + k].astype(np.uint64) << np.uint64(56 - 8 * k)
    live = np.arange(len(start))
    part = group.copy()
    for k in (*range(0, length - 7, 8), *([length - 8] if length % 8 else [])):
        if not len(live):
            break
        here = eight[start[live] + k]
        order = np.lexsort((here, part))
        live, part, here = live[order], part[order], here[order]
        new = np.ones(len(live), bool)
        new[1:] = (part[1:] != part[:-1]) | (here[1:] != here[:-1])
        part = np.cumsum(new) - 1
        keep = (np.bincount(part) > 1)[part]
        live, part = live[keep], part[keep]
    out = np.zeros(len(start), bool)
    out[live] = True
    return out


def _runs(rows: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the first and last of each run of consecutive at within a row."""
    new = np.ones(len(at), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (at[1:] != at[:-1] + 1)
    first = np.flatnonzero(new)
    return first, np.append(first[1:], len(at)) - 1


def _expand(count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(record, string in it) for records of so many strings."""
    record = np.repeat(np.arange(len(count)), count)
    return record, np.arange(len(record)) - np.repeat(np.cumsum(count) - count, count)


def _sorted_buckets(segments: DataFrame, length: int) -> DataFrame:
    """Spans (doc_id, th, s, e) of single segments whose strings occur again in another one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = [b for b in batches if b.num_rows]
        if not own:
            return
        bucket = pa.Table.from_batches(own)  # about as large as its fellows: see HOT
        lead = bucket.column("lead").to_numpy()
        order = np.argsort(lead, kind="stable")
        bounds = np.append(np.flatnonzero(np.diff(lead[order], prepend=lead[order][0] - 1 if len(lead) else 0)), len(lead))
        bounds[0] = 0
        strings = np.concatenate([[0], np.cumsum(bucket.column("size").to_numpy()[order] + 1)])
        at = 0
        while at < len(bounds) - 1:
            to = max(at + 1, int(np.searchsorted(strings[bounds], strings[bounds[at]] + SORT_STRINGS, "right")) - 1)
            part = bucket.take(pa.array(order[bounds[at] : bounds[to]])).combine_chunks()
            at = to
            data, offsets = _binary(part.column("bytes").combine_chunks())
            size, off = (part.column(c).to_numpy().astype(np.int64) for c in ("size", "off"))
            record, k = _expand(size + 1)
            _, group = np.unique(part.column("lead").to_numpy(), return_inverse=True)
            hit = repeated(data, offsets[record] + k, group[record] * 65536 + (off[record] - k), length)
            hit &= part.column("single").to_numpy(zero_copy_only=False)[record]
            record, k = record[hit], k[hit]
            if len(record):
                first, last = _runs(record, k)
                rows = pa.array(record[first])
                lo = part.column("lo").to_numpy()[record[first]].astype(np.int64)
                cols = [part.column(c).combine_chunks().take(rows) for c in _KEY]
                yield pa.RecordBatch.from_arrays([*cols, pa.array((lo + k[first]).astype(np.int32)), pa.array((lo + k[last] + length).astype(np.int32))], names=[*_KEY, "s", "e"])

    return segments.mapInArrow(run, "doc_id long, th long, s int, e int")


def _hot_parts(segments: DataFrame, length: int) -> DataFrame:
    """Segments cut into parts of up to ``PART`` strings at fixed distances from the anchor.

    core names the bytes that all strings such a part can have share, whole the part's own bytes and strings.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tx.chunks(batches, "bytes", 1 << 19):
            data, offsets = _binary(batch.column("bytes"))
            size, off, lo = (batch.column(c).to_numpy().astype(np.int64) for c in ("size", "off", "lo"))
            top, bottom = off // PART, (off - size) // PART  # parts by the distance of a string's start from the anchor
            record, k = _expand(top - bottom + 1)
            part = top[record] - k
            high, low = np.minimum(off[record], part * PART + PART - 1), np.maximum(off[record] - size[record], part * PART)
            anchor = offsets[record] + off[record]
            first, last = anchor - high, anchor - low
            both = tx.window_hash(data), tx.window_hash(data, 1)
            named = lambda s, e, salt: tuple(pa.array(tx.mix(tx.windows_span(x, s, e) + salt.astype(np.uint64)).view(np.int64)) for x in both)
            core = named(anchor - part * PART, anchor - part * PART - (PART - 1) + length, part)
            whole = named(first, last + length, part * 65536 + high * 256 + low)
            rows = pa.array(record)
            starts = lo[record] + off[record] - high
            pieces = [data[s:e].tobytes() for s, e in zip(first, last + length, strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c).take(rows) for c in (*_KEY, "single")), pa.array(starts.astype(np.int32)), pa.array((last - first).astype(np.int32)), pa.array(high), *core, *whole, pa.array(pieces, pa.binary())], names=[*_KEY, "single", "s", "size", "high", "c1", "c2", "w1", "w2", "bytes"])

    return segments.mapInArrow(run, "doc_id long, th long, single boolean, s int, size int, high long, c1 long, c2 long, w1 long, w2 long, bytes binary")


def _hot_strings(parts: DataFrame, length: int) -> DataFrame:
    """(doc_id, th, s, h1, h2, single) of every string of the parts; h1 and h2 name its bytes and its distance from the anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tx.chunks(batches, "bytes", 1 << 18):
            data, offsets = _binary(batch.column("bytes"))
            size, high, s = (batch.column(c).to_numpy().astype(np.int64) for c in ("size", "high", "s"))
            record, k = _expand(size + 1)
            start, gap = offsets[record] + k, (high[record] - k).astype(np.uint64)
            digest = [pa.array(tx.mix(tx.windows_span(tx.window_hash(data, seed), start, start + length) + gap).view(np.int64)) for seed in (0, 1)]
            rows = pa.array(record)
            yield pa.RecordBatch.from_arrays([*(batch.column(c).take(rows) for c in (*_KEY, "single")), pa.array((s[record] + k).astype(np.int32)), *digest], names=[*_KEY, "single", "s", "h1", "h2"])

    return parts.mapInArrow(run, "doc_id long, th long, single boolean, s int, h1 long, h2 long")


def _hot_spans(segments: DataFrame, length: int) -> DataFrame:
    """Spans (doc_id, th, s, e) of single hot segments: parts whose core is shared, whole parts that are equal, then string by string."""
    parts = written(_hot_parts(segments, length), "op2-parts")
    shared = parts.groupBy("c1", "c2").agg(F.count("*").alias("c")).where("c > 1").select("c1", "c2")
    live = written(parts.join(shared, ["c1", "c2"]), "op2-live")
    wholes = live.groupBy("w1", "w2").agg(F.count("*").alias("c"), F.min(F.struct(F.coalesce("doc_id", F.lit(-1)).alias("k"), *_KEY, "single", "s", "size", "high", "bytes")).alias("r"))
    equal = live.where("single").join(wholes.where("c > 1").select("w1", "w2"), ["w1", "w2"]).select(*_KEY, "s", (F.col("s") + F.col("size") + length).alias("e"))
    # of equal parts one stands for all, and needs no span of its own
    rest = wholes.select("r.doc_id", "r.th", (F.col("r.single") & (F.col("c") == 1)).alias("single"), "r.s", "r.size", "r.high", "r.bytes")
    strings = written(_hot_strings(rest, length), "op2-strings")
    again = strings.groupBy("h1", "h2").agg(F.count("*").alias("c")).where("c > 1").select("h1", "h2")
    own = strings.where("single").join(again, ["h1", "h2"]).select(*_KEY, "s", (F.col("s") + length).alias("e"))
    return equal.unionByName(own)


def _binary(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a binary column and each row's bounds."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, 8 * column.offset)
    return np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def _cut(texts: DataFrame, length: int) -> DataFrame:
    """segment bytes of each (doc, [segment]) row, and the head, the bytes from the anchor on that segments of one lead share."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tx.chunks(batches, limit=1 << 19):
            data, offsets = tx.flat(batch.column("text"))
            lists = batch.column("segments")
            own = lists.flatten()
            rows = pa.array(np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy()))
            lo, size = own.field("lo").to_numpy(), own.field("size").to_numpy()
            start = offsets[rows.to_numpy()] + lo
            pieces = [data[s : s + n + length].tobytes() for s, n in zip(start, size, strict=True)]
            heads = [p[o : o + LEAD] for p, o in zip(pieces, own.field("off").to_pylist(), strict=True)]
            fields = ("lead", "size", "off", "lo", "single", "hot")
            yield pa.RecordBatch.from_arrays([*(batch.column(c).take(rows) for c in _KEY), *(own.field(c) for c in fields), pa.array(heads, pa.binary()), pa.array(pieces, pa.binary())], names=[*_KEY, *fields, "head", "bytes"])

    return texts.mapInArrow(run, "doc_id long, th long, lead long, size int, off int, lo int, single boolean, hot boolean, head binary, bytes binary")


def _removed(texts: DataFrame) -> DataFrame:
    """n_removed, n_spans, the digest and the text of what is left of each (doc, [span]) row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tx.chunks(batches, limit=1 << 19):
            out: dict[str, list] = {"n_removed": [], "n_spans": [], "kept_sha256": [], "kept": []}
            for text, spans in zip(batch.column("text").cast(pa.large_binary()), batch.column("spans"), strict=True):
                text, at, kept, runs = text.as_py(), 0, [], 0
                reach = -1
                for s, e in sorted((x["s"], x["e"]) for x in spans.as_py()):
                    if s > reach:
                        runs += 1
                        kept.append(text[max(reach, 0) : s])
                    reach = max(reach, e)
                kept = b"".join([*kept, text[max(reach, at) :]])
                for c, v in zip(out, (len(text) - len(kept), runs, hashlib.sha256(kept).hexdigest(), kept), strict=True):
                    out[c].append(v)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in _KEY), pa.array(out["n_removed"], pa.int64()), pa.array(out["n_spans"], pa.int64()), pa.array(out["kept_sha256"]), pa.array(out["kept"], pa.binary())], names=[*_KEY, *out])

    return texts.mapInArrow(run, "doc_id long, th long, n_removed long, n_spans long, kept_sha256 string, kept binary")


def repeated_spans(docs: DataFrame, length: int = 200) -> tuple[DataFrame, DataFrame]:
    """Spans (doc_id, th, s, e) that cover every repeated string, and the texts of the documents they need."""
    if length < LEAD + PART:
        raise ValueError(f"strings of {length} bytes are shorter than {LEAD + PART}")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("th"), F.coalesce("text", F.lit("")).alias("text"))
    found = _anchor_rows(rows.where(F.octet_length("text") >= length), length)
    # leads are written before they are joined with: a join of two plain shuffles is one that Spark splits where a lead is hot
    shared = written(_anchor_rows(rows.where(F.octet_length("text") >= length), length).groupBy("lead").agg(F.count("*").alias("c")).where("c > 1").select("lead"), "op2-leads")
    cand = written(found.join(shared, "lead"), "op2-anchors")
    kinds = cand.groupBy(*_SEGMENT).agg(F.count("*").alias("c"), F.min(F.struct(F.coalesce("doc_id", F.lit(-1)).alias("k"), "doc_id", "th", "lo")).alias("rep"))
    kinds = written(kinds, "op2-kinds")
    whole = cand.join(kinds.where("c > 1").select(*_SEGMENT), _SEGMENT).select(*_KEY, F.col("lo").alias("s"), (F.col("lo") + F.col("size") + length).alias("e"))
    mixed = written(kinds.groupBy("lead").agg(F.count("*").alias("kinds")).where("kinds > 1"), "op2-mixed")
    reps = kinds.join(mixed, "lead").select("rep.doc_id", "rep.th", "lead", F.col("size"), "off", "rep.lo", (F.col("c") == 1).alias("single"), (F.col("kinds") > HOT).alias("hot"))
    per_doc = reps.groupBy(*_KEY).agg(F.collect_list(F.struct("lead", "size", "off", "lo", "single", "hot")).alias("segments"))
    whole_docs = whole.select(*_KEY).distinct()
    ids = written(whole_docs.unionByName(per_doc.select(*_KEY)).distinct(), "op2-ids")
    same = [rows["doc_id"].eqNullSafe(ids["doc_id"]), rows["th"] == ids["th"]]
    small = ids.count() <= MAX_BROADCAST_IDS
    texts = written(rows.join(F.broadcast(ids) if small else ids, same, "left_semi").distinct(), "op2-texts")
    cut = written(_cut(_with(texts, per_doc), length), "op2-segments")
    size = cut.where("not hot").agg(F.sum(F.octet_length("bytes"))).first()[0] or 0
    tasks = max(1, texts.sparkSession.sparkContext.defaultParallelism, -(-size // BUCKET_BYTES))
    plain = _sorted_buckets(cut.where("not hot").drop("hot").repartitionByRange(tasks, "head"), length)
    hot = _hot_spans(cut.where("hot").drop("hot", "lead", "head"), length)
    return whole.unionByName(plain).unionByName(hot), texts


def _with(texts: DataFrame, more: DataFrame) -> DataFrame:
    """texts joined with the lists of more by document."""
    other = more.withColumnsRenamed({c: f"_{c}" for c in _KEY})
    return texts.join(other, texts["doc_id"].eqNullSafe(other["_doc_id"]) & (texts["th"] == other["_th"])).drop("_doc_id", "_th")


def remove_repeats(docs: DataFrame, length: int = 200) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, of documents that lose something, the bytes kept."""
    spans, texts = repeated_spans(docs, length)
    spans = spans.groupBy(*_KEY).agg(F.collect_list(F.struct("s", "e")).alias("spans"))
    done = written(_removed(_with(texts, spans)), "op2-removed").withColumnsRenamed({"doc_id": "_doc_id", "th": "_th"})
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("th"), F.octet_length(text).cast("long").alias("n_bytes"), F.sha2(text.cast("binary"), 256).alias("whole"))
    out = rows.join(done, rows["doc_id"].eqNullSafe(done["_doc_id"]) & (rows["th"] == done["_th"]), "left")
    zero = F.lit(0).cast("long")
    return out.select("doc_id", "n_bytes", F.coalesce("n_removed", zero).alias("n_removed"), F.coalesce("n_spans", zero).alias("n_spans"), F.coalesce("kept_sha256", "whole").alias("kept_sha256"), "kept")
