"""Benchmark decontamination by latent semantic retrieval and subsequence checks.

1. Document frequencies of hashed terms are counted over all documents.
2. A randomised SVD (subspace iteration; tasks return sums over their passages)
   of the TF-IDF rows of benchmark items and of corpus passages gives ``RANK``
   directions, scaled by the terms' weights. It is fitted on all items and the passages of at most ``FIT_DOCS``
   documents, by hash of their ids; every passage is indexed.
3. Every passage of every document, in overlapping windows of a few lengths, is
   compared by latent cosine with every benchmark item, items in blocks. What the
   directions do not span lowers that cosine, the more the more items there are, so
   every stretch that has enough of an item's words to be a leak is a candidate
   too: of the item's rarest words a leak must hold a number, which is counted in
   bins. That bound is exact, so ``leaked`` depends on neither the number of
   directions nor the least cosine; such candidates alone have no cosine.
4. Candidates are checked on words: the longest common subsequence with the item
   in any stretch of the window's surroundings, and that of the item's answer (its
   last fifth).  ``leaked``: 80 % of the item's words in order, or, for paraphrases,
   60 % with 80 % of the answer.

Windows are not limited in number and texts are read whole.

Defined cases: words are lower-cased runs of letters, digits and non-ASCII bytes;
null or wordless texts and items match nothing; repeated rows each match; item_id may
be of any type that can be grouped by and keeps it; of items that share an item_id the
best match counts, and those with a null item_id share that; a doc_id is a number or null; an empty table on either side gives an
empty result; further columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from . import textops as tx
from .sampling import sampled
from .store import written

DIMS = 1 << 16
RANK = 256
#: Weight of a benchmark item's row beside a corpus passage's, so that the directions span the items first.
ITEM_WEIGHT = 8.0
#: Share of documents from which a term is too common to weigh.
COMMON = 0.3
FIT_DOCS = 50
ITEM_BLOCK = 4096
#: Items and words whose bins are counted in one step.
OVERLAP_ITEMS, OVERLAP_WORDS = 256, 1 << 17
#: Words of a block, and blocks of a window; windows are powers of two in order.
STRIDE, WINDOWS = 8, (2, 4, 8)
MIN_COSINE = 0.45
_CHUNK = 1 << 18
_SEP = np.ones(256, bool)
_SEP[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


def terms_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, word hash) of every word, in order."""
    data, offsets = tx.flat(pc.utf8_lower(column))
    start, end, row = tx.word_bounds(data, offsets, _SEP)
    return row, tx.span_hash(data, start, end)


def _dim(words: np.ndarray) -> np.ndarray:
    return (words % np.uint64(DIMS)).astype(np.int64)


def document_frequencies(docs: DataFrame) -> np.ndarray:
    """idf of each hashed term; the result has DIMS entries whatever the corpus."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(DIMS, np.int64), 0
        for batch in tx.chunks(batches):
            row, words = terms_of(batch.column("text"))
            total += np.bincount(np.unique(row * DIMS + _dim(words)) % DIMS, minlength=DIMS)
            n += batch.num_rows
        if n:
            term = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(np.append(term, -1)), pa.array(np.append(total[term], n))], names=["term", "df"])

    rows = docs.select("text").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).toPandas()
    df, n = np.zeros(DIMS), 0
    for term, count in zip(rows["term"], rows["df"], strict=True):
        if term < 0:
            n = count
        else:
            df[term] = count
    idf = np.log((n + 1) / (df + 1)).astype(np.float32) + np.float32(0.1)
    idf[df > max(COMMON * n, 50)] = 0
    return idf


def _passages(column: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(passage, term) of texts cut every so many words; 0: not cut."""
    row, hashes = terms_of(column)
    place = np.arange(len(row)) - np.searchsorted(row, row)
    key = row * (1 << 32) + (place // words if words else 0)
    _, passage = np.unique(key, return_inverse=True)
    return passage, _dim(hashes), int(passage.max()) + 1 if len(passage) else 0


def _drawn(terms: np.ndarray, width: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, rows) of a random basis for the terms alone; a term has the same row in every task."""
    place, q = np.full(DIMS, -1), np.zeros((len(terms), width), np.float32)
    place[terms] = np.arange(len(terms))
    for block in range(0, DIMS, 4096):
        own = terms[(terms >= block) & (terms < block + 4096)]
        if len(own):
            q[place[own]] = np.random.Generator(np.random.PCG64([seed, block])).standard_normal((4096, width), np.float32)[own - block]
    return place, q


def _fit_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray, int]]:
    for batch in tx.chunks(batches, limit=_CHUNK // 4):
        for cut in (0, 32):
            part = batch.filter(pc.equal(batch.column("words"), cut))
            yield (cut, *_passages(part.column("text"), cut))


def _fit_terms(texts: DataFrame) -> np.ndarray:
    """The terms of the texts, in order; at most DIMS."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, term, _ in _fit_parts(batches):
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(term), pa.int64())], names=["term"])

    return np.sort(texts.mapInArrow(run, "term long").distinct().toArrow().column("term").to_numpy())


def fit_directions(texts: DataFrame, idf: np.ndarray, rank: int = RANK, more: int = 8, rounds: int = 3, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """(place, directions): orthonormal directions of the terms that the texts have, and each term's row there, -1 if it has none.

    texts has text and words (the cut, 0: none).  Tasks draw the first basis from the seed and return
    sums for the terms that they met; the driver adds them up a row at a time and holds one row for
    each term of the bounded sample.
    """
    sc, width = texts.sparkSession.sparkContext, rank + more
    used, weights = _fit_terms(texts), sc.broadcast(idf)
    place, z = np.full(DIMS, -1), np.zeros((len(used), width), np.float32)
    place[used] = np.arange(len(used))
    for step in range(rounds if len(used) else 0):
        basis = sc.broadcast((place, z) if step else None)

        def run(batches: Iterator[pa.RecordBatch], basis=basis, step=step) -> Iterator[pa.RecordBatch]:
            terms, sums, parts = [], [], list(_fit_parts(batches))
            place, q = basis.value if step else _drawn(np.unique(np.concatenate([p[2] for p in parts] or [np.zeros(0, int)])), width, seed)
            for cut, passage, term, n in parts:
                if n:
                    x = weights.value[term][:, None]
                    first = np.searchsorted(passage, np.arange(n))
                    norm = np.sqrt(np.add.reduceat(x[:, 0] ** 2, first))[:, None]
                    y = np.add.reduceat(x * q[place[term]], first) * ((1.0 if cut else ITEM_WEIGHT) / np.maximum(norm, 1e-6)) ** 2
                    order = np.argsort(term, kind="stable")
                    own, at = np.unique(term[order], return_index=True)
                    terms.append(own)
                    sums.append(np.add.reduceat((x * y[passage])[order], at))
            if terms:
                term, vector = np.concatenate(terms), np.concatenate(sums)
                order = np.argsort(term, kind="stable")
                own, at = np.unique(term[order], return_index=True)
                vector = np.ascontiguousarray(np.add.reduceat(vector[order], at), np.float32)
                for k in range(0, len(own), 2000):
                    yield pa.RecordBatch.from_arrays([pa.array(own[k : k + 2000]), pa.array([v.tobytes() for v in vector[k : k + 2000]], pa.binary())], names=["term", "vector"])

        z = np.zeros((len(used), width), np.float32)
        for r in texts.mapInArrow(run, "term long, vector binary").toLocalIterator():
            z[place[r["term"]]] += np.frombuffer(r["vector"], np.float32)
        basis.destroy()
        # the left singular vectors of z by the eigenvectors of its small square
        square = np.zeros((width, width))
        for k in range(0, len(z), 2000):
            square += z[k : k + 2000].T.astype(float) @ z[k : k + 2000]
        power, axes = np.linalg.eigh(square)
        keep = np.flatnonzero(power > 1e-9 * max(power[-1], 1e-30))[::-1]
        turn = (axes[:, keep] / np.sqrt(power[keep])).astype(np.float32)
        for k in range(0, len(z), 2000):
            z[k : k + 2000, : len(keep)] = z[k : k + 2000] @ turn
        z, width = z[:, : len(keep)], len(keep)
    weights.destroy()
    tx.release()
    return place, np.ascontiguousarray(z[:, :rank], np.float32)


def word_masks(needle: list[int]) -> dict[int, int]:
    """The places of each word of needle as bits."""
    masks: dict[int, int] = {}
    for k, w in enumerate(needle):
        masks[w] = masks.get(w, 0) | 1 << k
    return masks


def common_subsequence(n: int, hits: list[int]) -> int:
    """Length of the longest common subsequence of n words and a stretch; hits are the masks of those of its words that are among the n."""
    full = (1 << n) - 1
    rest = full
    for mask in hits:
        hit = rest & mask
        rest = ((rest + hit) | (rest - hit)) & full
    return n - rest.bit_count()


def _stretch(n: int) -> int:
    """Words of a stretch that an item of n words is sought in."""
    return n + n // 4 + 2


def _least(n: int) -> int:
    """Words in order that any leak of an item of n words has."""
    return -(-3 * n // 5)


def _shared(needle: list[int], counts: list[tuple[int, int]], stretch: list[int]) -> bool:
    """Whether a stretch has enough of an item's words for a leak, in whatever order."""
    known, least = set(stretch), _least(len(needle))
    if sum(map(known.__contains__, needle)) < least:
        return False
    return sum(min(n, stretch.count(w)) for w, n in counts if w in known) >= least


def _overlap_index(needles: list[list[int]], idf: np.ndarray) -> list[tuple]:
    """For every OVERLAP_ITEMS items: (words, first posting of each, items, hits needed by item, bin width by item, place of the first item).

    Of any n - t + m words of an item, a stretch with t of its n words has m; the rarest are taken.
    """
    out = []
    for k in range(0, len(needles), OVERLAP_ITEMS):
        words, items, need, width = [], [], [], []
        for j, needle in enumerate(needles[k : k + OVERLAP_ITEMS]):
            own, n = np.array(needle, np.uint64), len(needle)
            t = _least(n)
            m = max(1, t // 5)
            rare = np.unique(own[np.argsort(-idf[_dim(own)], kind="stable")[: n - t + m]])
            words.append(rare)
            items.append(np.full(len(rare), j))
            need.append(m)
            width.append(-(-_stretch(n) // 2))
        words, items = np.concatenate(words), np.concatenate(items)
        order = np.argsort(words, kind="stable")
        own, first = np.unique(words[order], return_index=True)
        out.append((own, np.append(first, len(order)), items[order], np.array(need), np.array(width), k))
    return out


def _overlaps(words: np.ndarray, index: list[tuple]) -> Iterator[tuple[int, int, int]]:
    """(item, start, stop) of words in which the item's rare words are frequent enough for a leak."""
    for own, first, posting, need, width, k in index:
        reach = 2 * int(width.max())
        for low in range(0, len(words), OVERLAP_WORDS):
            part = words[low : low + OVERLAP_WORDS + reach]
            slot = np.minimum(np.searchsorted(own, part), len(own) - 1)
            at = np.flatnonzero(own[slot] == part)
            slot = slot[at]
            n = first[slot + 1] - first[slot]
            item = posting[np.repeat(first[slot] - np.cumsum(n) + n, n) + np.arange(int(n.sum()))]
            bins = len(part) // width + 3  # the last two stay empty, so that no sum reaches the next item
            start = np.cumsum(bins) - bins
            hits = np.bincount(start[item] + np.repeat(at, n) // width[item], minlength=int(bins.sum()))
            hits[:-2] += hits[1:-1] + hits[2:]  # no stretch is longer than two bins: it lies within three
            key = np.flatnonzero(hits >= np.repeat(need, bins))
            j = np.searchsorted(start, key, "right") - 1
            s = (key - start[j]) * width[j]
            real = s < len(part)
            yield from zip((k + j[real]).tolist(), (low + s[real]).tolist(), np.minimum(len(words), low + s[real] + 3 * width[j[real]]).tolist(), strict=True)


def _leaked(common: int, common_answer: int, n: int) -> bool:
    return 5 * common >= 4 * n or (5 * common >= 3 * n and 5 * common_answer >= 4 * min(n, max(3, n // 5)))


def _answer(needle: list[int]) -> list[int]:
    return needle[-max(3, len(needle) // 5) :]


def _best(masks: dict[int, int], answer: dict[int, int], n: int, n_answer: int, words: list[int], low: int, high: int) -> tuple[int, int]:
    """The longest subsequence, and that of the answer, over stretches a quarter longer than the item; masks are those of its words."""
    size, least, best = _stretch(n), _least(n), (False, -1, -1)
    known = [k for k in range(low, high) if words[k] in masks]
    hits = [masks[words[k]] for k in known]
    for s in range(low, max(low + 1, high - size + 4), 4):
        a, b = bisect_left(known, s), bisect_left(known, min(high, s + size))
        if b - a < least and b - a <= best[1]:
            continue  # no longer than its words are many
        common = common_subsequence(n, hits[a:b])
        if common > best[1] or common >= least:
            in_answer = common_subsequence(n_answer, [m for w in words[s : min(high, s + size)] if (m := answer.get(w))])
            best = max(best, (_leaked(common, in_answer, n), common, in_answer))
    return best[1:]


def leaks(docs: DataFrame, benchmark: DataFrame, min_cosine: float = MIN_COSINE) -> DataFrame:
    """doc_id, item_id, item_words, common_words, answer_words, common_answer, cosine, leaked of every checked candidate."""
    spark = docs.sparkSession
    idf = document_frequencies(docs)
    items = benchmark.select("item_id", "text").where("text is not null")
    fit_items = items.select("text", F.lit(0).alias("words"))
    fit_docs = sampled(docs.where("text is not null").select("doc_id", "text"), "doc_id", FIT_DOCS, ("text",)).select("text", F.lit(32).alias("words"))
    fit = written(fit_items.unionByName(fit_docs).coalesce(4), "op5-fit")
    place, directions = fit_directions(fit, idf)
    directions *= idf[np.flatnonzero(place >= 0)][:, None]
    known = spark.sparkContext.broadcast((idf, place, directions))
    out = None
    for k in range(max(1, -(-items.count() // ITEM_BLOCK))):
        block = items.orderBy("item_id", "text").offset(k * ITEM_BLOCK).limit(ITEM_BLOCK).toArrow()
        found = _search(docs, known, block, items.schema["item_id"].dataType.simpleString(), min_cosine)
        out = found if out is None else out.unionByName(found)
    best = F.max(F.struct("leaked", "common_words", "common_answer", "cosine", "item_words", "answer_words")).alias("m")
    return out.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "m.item_words", "m.common_words", "m.answer_words", "m.common_answer", "m.cosine", "m.leaked")


def _search(docs: DataFrame, known, block: pa.Table, id_name: str, min_cosine: float) -> DataFrame:
    spark = docs.sparkSession
    idf, place, directions = known.value
    row, words = terms_of(block.column("text").combine_chunks()) if block.num_rows else (np.zeros(0, int), np.zeros(0, np.uint64))
    ids = block.column("item_id").to_pylist()
    vectors, needles, kept = [], [], []
    for i in range(block.num_rows):
        own = words[row == i]
        if not len(own):
            continue
        dims = _dim(own)[place[_dim(own)] >= 0]
        a = directions[place[dims]].sum(axis=0)
        vectors.append(a / max(float(np.linalg.norm(a)), 1e-9))
        needles.append(own.tolist())
        kept.append(ids[i])
    id_type = block.schema.field("item_id").type
    items = spark.sparkContext.broadcast((np.array(vectors, np.float32).reshape(len(vectors), directions.shape[1]), needles, kept, _overlap_index(needles, idf)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idf, at_row, directions = known.value
        lengths = np.append(np.sqrt(np.einsum("ij,ij->i", directions, directions)), 0)  # the last for terms without a row
        vectors, needles, item_ids, index = items.value
        counts = [[(w, x.count(w)) for w in set(x)] for x in needles]
        masks = [(word_masks(x), word_masks(_answer(x)), len(x), len(_answer(x))) for x in needles]
        for batch in tx.chunks(batches, limit=_CHUNK):
            if not needles:
                return
            row, words = terms_of(batch.column("text"))
            if not len(words):
                continue
            term = _dim(words)
            first_word = np.searchsorted(row, row)
            place = np.arange(len(row)) - first_word
            heads = np.flatnonzero(place % STRIDE == 0)
            head_row = row[heads]
            energy = np.concatenate([[0], np.cumsum(np.add.reduceat(idf[term].astype(np.float64) ** 2, heads))])
            block_of = np.cumsum(place % STRIDE == 0) - 1
            last = np.searchsorted(head_row, head_row, "right")
            # no window is longer in the latent space than its terms together: most end here
            longest = lengths[at_row[term]].astype(np.float64)
            reach = np.concatenate([[0], np.cumsum(np.add.reduceat(longest, heads))])
            spans, wanted = [], np.zeros(len(heads) + 1, np.int64)
            for size in WINDOWS:
                stop = np.minimum(np.arange(len(heads)) + size, last)
                norm = np.sqrt(np.maximum(energy[stop] - energy[:-1], 1e-9))
                near = np.flatnonzero(reach[stop] - reach[:-1] >= min_cosine * norm)
                spans.append((size, near, norm[near]))
                np.add.at(wanted, near, 1)
                np.add.at(wanted, stop[near], -1)
            within = np.cumsum(wanted)[:-1] > 0
            own, spot = np.flatnonzero(within), np.cumsum(within) - 1  # a window's blocks stay neighbours
            live = np.flatnonzero((at_row[term] >= 0) & (idf[term] > 0) & within[block_of])
            if len(live):
                rows = np.full((STRIDE, len(own)), -1)
                rows[place[live] % STRIDE, spot[block_of[live]]] = at_row[term[live]]
                latent = np.zeros((len(own), directions.shape[1]), np.float32)
                for r in rows:
                    has = np.flatnonzero(r >= 0)
                    latent[has] += directions[r[has]]
            bounds = np.searchsorted(row, np.arange(batch.num_rows + 1))
            cand: dict[tuple[int, int], list] = {}
            summed, text = 1, head_row[own]
            for size, near, norm in spans if len(live) else ():
                while summed < size:  # sums of so many blocks, or of those that are left of the text, by doubling
                    ends = np.flatnonzero(text[summed:] != text[:-summed])
                    alone = latent[ends]
                    latent[:-summed] += latent[summed:]
                    latent[ends] = alone
                    summed *= 2
                for part in np.array_split(np.arange(len(near)), len(near) // 4096 + 1):
                    b = latent[spot[near[part]]]
                    far = np.einsum("ij,ij->i", b, b) >= (min_cosine * norm[part]) ** 2
                    part, b = part[far], b[far]
                    cosine = b @ vectors.T / norm[part, None]
                    for i, j in zip(*np.nonzero(cosine >= min_cosine), strict=True):
                        h = near[part[i]]
                        r = int(head_row[h])
                        cand.setdefault((r, int(j)), []).append((int(heads[h]), int(min(heads[h] + STRIDE * size, bounds[r + 1])), float(cosine[i, j])))
            flat = words.tolist()
            for j, s, e in _overlaps(words, index):
                for r in range(int(row[s]), int(row[e - 1]) + 1):
                    low, high = max(s, int(bounds[r])), min(e, int(bounds[r + 1]))
                    if _shared(needles[j], counts[j], flat[low:high]):
                        cand.setdefault((r, j), []).append((low, high, None))
            if not cand:
                continue
            out = {c: [] for c in ("r", "item_id", "item_words", "common_words", "answer_words", "common_answer", "cosine", "leaked")}
            for (r, j), spans in cand.items():
                needle = needles[j]
                n, answer_n = len(needle), len(_answer(needle))
                best, merged = (-1, -1), []
                for s, e, _ in sorted(spans, key=lambda x: x[:2]):
                    s, e = max(int(bounds[r]), s - n // 2 - 4), min(int(bounds[r + 1]), e + n // 2 + 4)
                    s -= (s - int(bounds[r])) % 4  # stretches start where they do in the whole text
                    if merged and s <= merged[-1][1]:
                        merged[-1][1] = max(e, merged[-1][1])
                    else:
                        merged.append([s, e])
                for s, e in merged:
                    best = max(best, _best(*masks[j], flat, s, e), key=lambda b: (_leaked(*b, n), *b))
                out["r"].append(r)
                out["item_id"].append(item_ids[j])
                out["item_words"].append(n)
                out["common_words"].append(best[0])
                out["answer_words"].append(answer_n)
                out["common_answer"].append(best[1])
                out["cosine"].append(max((c for _, _, c in spans if c is not None), default=None))
                out["leaked"].append(_leaked(*best, n))
            doc = batch.column("doc_id").take(pa.array(out.pop("r"), pa.int64())).cast(pa.int64())
            kinds = {"item_id": id_type, "cosine": pa.float64(), "leaked": pa.bool_()}
            yield pa.RecordBatch.from_arrays([doc, *(pa.array(v, kinds.get(c, pa.int32())) for c, v in out.items())], names=["doc_id", *out])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id long, item_id {id_name}, item_words int, common_words int, answer_words int, common_answer int, cosine double, leaked boolean")
