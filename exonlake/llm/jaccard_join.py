"""N-gram Jaccard self-join by a token-group matrix, and the classes it links.

A document's set holds its distinct word shingles as 64-bit hashes.  Two sets
with Jaccard >= t share ``SHARED`` tokens (or all of a smaller overlap) among each
other's first ``n - ceil(t*n) + SHARED`` in any common order; rare tokens are ordered
first, by counted tokens and by the product of their words' shares of all words.  The
matrix has those tokens against documents, then against groups of them:

1. equal sets fold into one representative by their 128-bit digest;
2. tokens of one document alone leave the matrix, then documents with fewer tokens left
   than a link needs;
3. for a few rounds each token names a leader, and what is within t of a leader that it
   shares enough tokens with joins its class, as what is in one class need not be compared;
4. similar documents, those of one leader and like size, form groups of at most ``GROUP``.
   The matrix is taken again as (token, group), the union of a group's tokens.  A pair of
   groups shares no more tokens than their unions do: where that is enough for a link of
   their smallest members, and sizes and classes allow one, the pair is opened.

Members of opened pairs are first bounded by signatures (how many tokens of each set fall
into each of ``PARTS`` parts of the token space), then compared on exact sets.  Every pair
that could join two classes is compared, so no link between different classes is lost;
pairs already joined need no comparison.  Nothing is capped: what is similar fills as many
groups as it needs, and a leader with many members is dealt out in blocks of them.  The
tables of frequent tokens and words that are sent to every task are bounded by
``MAX_FREQUENT``; they set the order only, never a result.

Defined cases: null or wordless text has an empty set, links with nothing and is
its own component; fewer words than a shingle make one shingle; rows that share a
doc_id and have words share a component, whatever their texts; rows with a null doc_id
have a null component; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from . import textops as tx
from .components import merge_labels
from .store import dropped, written

#: Members that a leader is compared with in one task.
BLOCK = 64
#: Members of a group of the matrix.
GROUP = 256
#: Tokens that prefixes are longer by, so that linked sets share as many (or all of a smaller overlap).
SHARED = 6
#: Parts of the token space; a signature counts a set's tokens in each.  FINE ones are for what is about to be compared.
PARTS, FINE = 128, 2048
ROUNDS = 2
#: Frequent tokens and words sent to tasks, at most of each (12 bytes each).
MAX_FREQUENT = 200_000
#: Hashes that a task counts at once, and the count from which it tells of one.
HELD, TOLD = 500_000, 4
#: Steps of the order for each doubling of a token's count.
_STEPS = 16
#: Rows of ids or labels that may be broadcast; beyond, joins shuffle them.
MAX_BROADCAST_ROWS = 200_000
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _hashed_words(data: np.ndarray, offsets: np.ndarray, seeds: tuple[int, ...] = (0,)) -> tuple[np.ndarray, ...]:
    """(row, hash by each seed) of every word, lower-cased, in order."""
    data = _LOWER[data]
    start, end, row = tx.word_bounds(data, offsets)
    return row, *(tx.span_hash(data, start, end, seed) for seed in seeds)


def _shingles(hashes: np.ndarray, row: np.ndarray, n_rows: int, words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, token, first word or -1) of all shingles by row and token, repeated ones too."""
    grams, first = tx.gram_hash(hashes, row, words)
    rows = row[first]
    counts = np.bincount(row, minlength=n_rows)
    for short in np.flatnonzero((counts > 0) & (counts < words)):
        own = hashes[row == short]
        grams = np.append(grams, tx.mix(np.array([int(sum(int(h) * pow(0x9E3779B97F4A7C15, len(own) - 1 - k, 1 << 64) for k, h in enumerate(own)) % (1 << 64)) ^ len(own)], np.uint64)))
        rows, first = np.append(rows, short), np.append(first, -1)
    order = np.argsort(grams, kind="stable")
    small = np.uint16 if n_rows < 1 << 16 else np.int64
    order = order[np.argsort(rows[order].astype(small), kind="stable")]
    return rows[order], grams[order], first[order]


def _distinct(rows: np.ndarray, grams: np.ndarray) -> np.ndarray:
    new = np.ones(len(grams), bool)
    new[1:] = (grams[1:] != grams[:-1]) | (rows[1:] != rows[:-1])
    return np.flatnonzero(new)


def token_sets(data: np.ndarray, offsets: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, token) of each row's distinct shingles, by row and token."""
    row, hashes = _hashed_words(data, offsets)
    rows, grams, _ = _shingles(hashes, row, len(offsets) - 1, words)
    new = _distinct(rows, grams)
    return rows[new], grams[new]


def _digests(docs: DataFrame, words: int) -> DataFrame:
    """kind 0: doc_id, n, h1, h2 of each row; kinds 1 and 2: h1, a token or a word that is frequent in its task, and its count n."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[np.ndarray]] = {1: [], 2: []}

        def frequent(kind: int) -> pa.RecordBatch:
            values, counts = np.unique(np.concatenate(held[kind]), return_counts=True)
            held[kind].clear()
            values, counts = values[counts >= TOLD], counts[counts >= TOLD]
            none = pa.nulls(len(values), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(values), kind, np.int32)), none, pa.array(counts, pa.int64()), pa.array(values.view(np.int64)), none], names=["kind", "doc_id", "n", "h1", "h2"])

        for batch in tx.chunks(batches):
            n = batch.num_rows
            row, hashes, others = _hashed_words(*tx.flat(batch.column("text")), (0, 1))
            rows, tokens, first = _shingles(hashes, row, n, words)
            new = _distinct(rows, tokens)
            rows, tokens, first = rows[new], tokens[new], first[new]
            counts = np.bincount(rows, minlength=n)
            ends, out = np.cumsum(counts), []
            # two independent hashes of the words name a set
            second = tx.mix(tokens)
            whole = first >= 0
            second[whole] = tx.gram_hash_at(others, first[whole], words)
            for salt, own in ((0x5851F42D4C957F2D, tokens), (0x14057B7EF767814F, second)):
                sums = np.zeros(len(tokens) + 1, np.uint64)
                np.cumsum(tx.mix(own ^ np.uint64(salt)), out=sums[1:])
                out.append(pa.array((sums[ends] - sums[ends - counts]).view(np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array(np.zeros(n, np.int32)), batch.column("doc_id").cast(pa.int64()), pa.array(counts, pa.int64()), *out], names=["kind", "doc_id", "n", "h1", "h2"])
            for kind, values in ((1, tokens), (2, hashes)):
                held[kind].append(values)
                if sum(map(len, held[kind])) > HELD:
                    yield frequent(kind)
        for kind in held:
            if held[kind]:
                yield frequent(kind)

    return docs.select("doc_id", "text").mapInArrow(run, "kind int, doc_id long, n long, h1 long, h2 long")


def _most_frequent(counts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(hash, count) by hash of the most frequent ones, by octaves of counts, as many octaves as ``MAX_FREQUENT`` rows hold."""
    octave = F.floor(F.log2("n")).cast("int")
    left, least = MAX_FREQUENT, 64
    for r in sorted(counts.groupBy(octave.alias("o")).agg(F.count("*").alias("k")).collect(), reverse=True):  # 64 rows at most
        left -= r["k"]
        if left < 0:
            break
        least = r["o"]
    top = counts.where(octave >= least).toArrow()
    known = top.column("h1").to_numpy().view(np.uint64)
    order = np.argsort(known)
    return known[order], top.column("n").to_numpy()[order]


def _steps(share: np.ndarray) -> np.ndarray:
    return np.round(np.log2(share) * _STEPS).astype(np.int32)


def _looked_up(known: np.ndarray, values: np.ndarray, sought: np.ndarray, missing: int) -> np.ndarray:
    if not len(known):
        return np.full(len(sought), missing, np.int32)
    at = np.minimum(np.searchsorted(known, sought), len(known) - 1)
    return np.where(known[at] == sought, values[at], missing)


def _matrix_tokens(docs: DataFrame, words: int, percent: int, frequent: tuple[np.ndarray, np.ndarray], common_words: tuple[np.ndarray, np.ndarray], n_words: int) -> DataFrame:
    """(token, doc_id, n): each row's prefix under the order rare first, then by hash.

    How often a token is to be expected is the number of all words times the shares of its words;
    tokens known to be more frequent have their count.
    """
    total = max(1, n_words)
    tables = (frequent[0], _steps(frequent[1]), common_words[0], _steps(common_words[1] / total))
    common = docs.sparkSession.sparkContext.broadcast(tables)
    all_words, rare = int(_steps(np.array([total]))[0]), int(_steps(np.array([1 / total]))[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token, times, word, share = common.value
        for batch in tx.chunks(batches):
            row, hashes = _hashed_words(*tx.flat(batch.column("text")))
            rows, tokens, first = _shingles(hashes, row, batch.num_rows, words)
            new = _distinct(rows, tokens)
            rows, tokens, first = rows[new], tokens[new], first[new]
            cost = np.concatenate([[0], np.cumsum(_looked_up(word, share, hashes, rare), dtype=np.int64)])
            expected = np.where(first >= 0, all_words + cost[np.minimum(first + words, len(hashes))] - cost[first], 0)
            weight = np.maximum(expected, _looked_up(token, times, tokens, -(1 << 30)))
            order = np.lexsort((tokens, weight, rows))
            rows, tokens = rows[order], tokens[order]
            counts = np.bincount(rows, minlength=batch.num_rows)
            place = np.arange(len(rows)) - (np.cumsum(counts) - counts)[rows]
            keep = place < (counts - (percent * counts + 99) // 100 + SHARED)[rows]
            rows, tokens = rows[keep], tokens[keep]
            ids = batch.column("doc_id").cast(pa.int64()).take(pa.array(rows))
            yield pa.RecordBatch.from_arrays([pa.array(tokens.view(np.int64)), ids, pa.array(counts[rows].astype(np.int32))], names=["token", "doc_id", "n"])

    return docs.select("doc_id", "text").mapInArrow(run, "token long, doc_id long, n int")


def _with_signatures(docs: DataFrame, words: int, parts: int) -> DataFrame:
    """doc_id, text, n and sig, the number of the set's tokens in each part of the token space (all 255 if one is over 255)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tx.chunks(batches):
            rows, tokens = token_sets(*tx.flat(batch.column("text")), words)
            n = batch.num_rows
            counts = np.bincount(rows * parts + (tokens % np.uint64(parts)).astype(np.int64), minlength=n * parts).reshape(n, parts)
            counts[(counts > 255).any(axis=1)] = 255
            sig = pa.array([c.tobytes() for c in counts.astype(np.uint8)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), batch.column("text"), pa.array(np.bincount(rows, minlength=n)), sig], names=["doc_id", "text", "n", "sig"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, text string, n long, sig binary")


def _matrix(column: pa.Array) -> np.ndarray:
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), np.uint8).reshape(len(rows), -1)


def _screened(edges: DataFrame, percent: int) -> DataFrame:
    """Edges (a, b, n1, n2, sig1, sig2) whose sizes and signatures allow a link, as (a, b)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                ok = _may_link(_matrix(part.column("sig1")), _matrix(part.column("sig2")), part.column("n1").to_numpy(), part.column("n2").to_numpy(), percent)
                yield part.select(["a", "b"]).filter(pa.array(ok))

    return edges.mapInArrow(run, "a long, b long")


def _may_link(one: np.ndarray, two: np.ndarray, n1: np.ndarray, n2: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets can reach the threshold by their sizes and the overlap that their signatures bound."""
    bound = np.minimum(one, two).sum(axis=-1, dtype=np.int64)
    fits = 100 * np.minimum(n1, n2) >= percent * np.maximum(n1, n2)
    return fits & (((100 + percent) * bound >= percent * (n1 + n2)) | (bound == 255 * one.shape[-1]))


def _screen_groups(sides: DataFrame, percent: int) -> DataFrame:
    """Members (pid, side, doc_id, label) of opened pairs of groups that may link with a member of the other side in another class."""

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        side, label, n, sig = table.column("side").to_numpy(), table.column("label").to_numpy(), table.column("n").to_numpy(), _matrix(table.column("sig"))
        right = np.flatnonzero(side == side.max())  # a group against itself has one side only
        keep = np.zeros(len(side), bool)
        for i in np.flatnonzero(side == 0):
            ok = right[(label[right] != label[i]) & _may_link(sig[i], sig[right], n[i], n[right], percent)]
            keep[ok] = True
            keep[i] |= len(ok) > 0
        return table.select(["pid", "side", "doc_id", "label"]).filter(pa.array(keep))

    return sides.groupBy("pid").applyInArrow(run, f"pid {sides.schema['pid'].dataType.simpleString()}, side int, doc_id long, label long")


def _open_groups(sides: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Links (a, b) between the two sides of each pid; sides has pid, side, doc_id and label. Classes that are joined need no further link."""

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        side, ids, label = (table.column(c).to_numpy() for c in ("side", "doc_id", "label"))
        rows, tokens = token_sets(*tx.flat(table.column("text")), words)
        sizes = np.bincount(rows, minlength=len(ids))
        ends = np.cumsum(sizes)
        own = [tokens[e - n : e] for e, n in zip(ends, sizes, strict=True)]
        parent = {int(x): int(x) for x in label}

        def root(x: int) -> int:
            while parent[x] != x:
                parent[x] = x = parent[parent[x]]
            return x

        found: tuple[list[int], list[int]] = ([], [])
        for i, j in product(np.flatnonzero(side == 0), np.flatnonzero(side == side.max())):
            one, two = root(int(label[i])), root(int(label[j]))
            if one == two or 100 * min(sizes[i], sizes[j]) < percent * max(sizes[i], sizes[j]):
                continue
            both = np.sort(np.concatenate([own[i], own[j]]), kind="stable")
            shared = int(np.count_nonzero(both[1:] == both[:-1]))
            if 100 * shared >= percent * (sizes[i] + sizes[j] - shared):
                parent[max(one, two)] = min(one, two)
                found[0].append(int(ids[i]))
                found[1].append(int(ids[j]))
        return pa.table({"a": pa.array(found[0], pa.int64()), "b": pa.array(found[1], pa.int64())})

    def sought() -> DataFrame:
        """The texts of the sides, and no others, so that none else is moved."""
        return texts.join(_sent_if_small(written(sides.select("doc_id").distinct(), "op9-sought")), "doc_id", "left_semi")

    # fine signatures first: they are smaller than texts, and few pairs that pass them do not link
    fine = _with_signatures(sought(), words, FINE).select("doc_id", "n", "sig")
    sides = written(_screen_groups(sides.join(fine, "doc_id"), percent), "op9-fine")
    return sides.join(sought(), "doc_id").groupBy("pid").applyInArrow(run, "a long, b long").distinct()


def _sent_if_small(df: DataFrame, rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """df, marked for broadcast if it has at most so many rows; beyond, joins shuffle it."""
    return F.broadcast(df) if df.count() <= rows else df


def _needed(n: Column, percent: int) -> Column:
    """Tokens of a prefix that a link of a set of n tokens shares at least."""
    return F.least(F.lit(SHARED), F.floor((n * percent + 99) / 100))


def _shared_tokens(tokens: DataFrame, percent: int) -> DataFrame:
    """The rows (token, doc_id, n) of tokens in several documents, of documents with enough of them for a link."""
    own = Window.partitionBy("token")  # rows of a common token spill, they are not held
    matrix = tokens.withColumns({"_lo": F.min("doc_id").over(own), "_hi": F.max("doc_id").over(own)}).where("_lo < _hi")
    matrix = written(matrix.select("token", "doc_id", "n"), "op9-shared")
    enough = matrix.groupBy("doc_id").agg(F.count("*").alias("_c"), F.min(_needed(F.col("n"), percent)).alias("_need")).where("_c >= _need").select("doc_id")
    return written(matrix.join(_sent_if_small(enough), "doc_id", "left_semi").select("token", "doc_id", "n"), "op9-matrix")


def jaccard_classes(docs: DataFrame, words: int = 4, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles and component_id of every row; sets link when 100 * shared >= percent * union."""
    digests = written(_digests(docs, words), "op9-sets")
    tables = []
    for kind in (1, 2):
        counted = written(digests.where(f"kind = {kind}").groupBy("h1").agg(F.sum("n").alias("n")), "op9-frequent")
        tables.append(_most_frequent(counted))
    n_words = digests.where("kind = 2").agg(F.sum("n")).first()[0] or 1

    sets = digests.where("kind = 0").select("doc_id", "n", "h1", "h2")
    classes = sets.where("doc_id is not null and n > 0").groupBy("h1", "h2", "n").agg(F.min("doc_id").alias("rep"))
    member = written(sets.join(classes, ["h1", "h2", "n"], "left").select("doc_id", "n", "rep"), "op9-member")
    # rows that share a doc_id but not their set: none of them is left out as a copy, and its sets are joined
    clashing = written(member.where("rep is not null").groupBy("doc_id").agg(F.min("rep").alias("_lo"), F.max("rep").alias("_hi")).where("_lo < _hi").select("doc_id"), "op9-clash")
    copies = member.where("rep <> doc_id").select("doc_id").distinct().join(_sent_if_small(clashing), "doc_id", "left_anti")

    tokens = written(_matrix_tokens(docs.where("doc_id is not null").join(_sent_if_small(written(copies, "op9-copies")), "doc_id", "left_anti"), words, percent, *tables, n_words), "op9-tokens")
    matrix = _shared_tokens(tokens, percent)
    dropped(tokens)
    ids = written(matrix.select("doc_id").distinct(), "op9-ids")
    texts = written(_with_signatures(docs.select("doc_id", "text").join(_sent_if_small(ids), "doc_id", "left_semi"), words, PARTS), "op9-texts")
    sigs, texts = texts.select("doc_id", "n", "sig"), texts.select("doc_id", "text")

    twins = member.join(_sent_if_small(clashing), "doc_id", "left_semi").where("rep <> doc_id").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    twins = written(twins, "op9-twins")
    named_ids = ids.unionByName(twins.select(F.col("a").alias("doc_id"))).unionByName(twins.select(F.col("b").alias("doc_id"))).distinct()
    labels = merge_labels(named_ids.withColumn("label", F.col("doc_id")), twins, "op9")

    side = lambda c, k: sigs.select(F.col("doc_id").alias(c), F.col("n").alias(f"n{k}"), F.col("sig").alias(f"sig{k}"))
    fits = lambda x, y: F.least(x, y) * 100 >= F.greatest(x, y) * percent
    for k in range(ROUNDS):
        rows, lead = _mixed(matrix, labels, k)
        edges = rows.join(lead, "token").where((F.col("label") != F.col("lead.label")) & fits(F.col("n"), F.col("lead.n")))
        need = F.min(_needed(F.greatest("n", "lead.n"), percent)).alias("_need")
        edges = edges.groupBy(F.col("doc_id").alias("a"), F.col("lead.doc_id").alias("b")).agg(F.count("*").alias("_c"), need).where("_c >= _need").select("a", "b")
        near = _named(_screened(edges.join(side("a", 1), "a").join(side("b", 2), "b"), percent), labels)
        labels = merge_labels(labels, _linked(written(near, f"op9-led{k}"), texts, words, percent), "op9")

    rows, lead = _mixed(matrix, labels, ROUNDS)
    many = written(rows.join(lead, "token").select("token", "doc_id", "n", "label", F.struct("lead.h", "lead.doc_id").alias("lead")), "op9-open")
    # sizes that can link are at most one class apart
    many = many.withColumn("size", F.floor(F.log("n") / float(np.log(100 / percent)) + 1e-9).cast("int"))
    homes = many.groupBy("doc_id", "label", "size").agg(F.min("lead").alias("home"))
    blocks = homes.groupBy("home", "size").agg(F.ceil(F.count("*") / GROUP).alias("blocks"))
    homes = homes.join(blocks, ["home", "size"]).select("doc_id", "label", F.struct(F.col("home.doc_id").alias("home"), "size", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).alias("k")).alias("g"))
    members = written(homes.join(sigs, "doc_id"), "op9-members")
    groups = members.groupBy("g").agg(F.min("n").alias("least"), F.max("n").alias("most"), F.min("label").alias("lo"), F.max("label").alias("hi"))
    in_group = many.select("token", "doc_id").join(_sent_if_small(members.select("doc_id", "g").distinct()), "doc_id").select("token", "g").distinct()
    unions = written(in_group.join(groups, "g"), "op9-unions")
    left = unions.select("token", F.col("g").alias("g1"), F.struct("least", "most", "lo", "hi").alias("x"), F.explode(F.array(F.col("g.size"), F.col("g.size") + 1)).alias("size"))
    right = unions.select("token", F.col("g").alias("g2"), F.struct("least", "most", "lo", "hi").alias("y"), F.col("g.size").alias("size"))
    two_classes = ~((F.col("x.lo") == F.col("x.hi")) & (F.col("y.lo") == F.col("y.hi")) & (F.col("x.lo") == F.col("y.lo")))
    sizes = (F.col("x.most") * 100 >= F.col("y.least") * percent) & (F.col("y.most") * 100 >= F.col("x.least") * percent)
    pairs = left.join(right, ["token", "size"]).where((F.col("g1.size") < F.col("g2.size")) | (F.col("g1") <= F.col("g2"))).where(two_classes & sizes)
    need = F.min(_needed(F.greatest("x.least", "y.least"), percent)).alias("_need")
    opened = pairs.groupBy("g1", "g2").agg(F.count("*").alias("_c"), need).where("_c >= _need").select("g1", "g2")
    both = F.array(F.struct(F.lit(0).alias("side"), F.col("g1").alias("g")), F.struct(F.lit(1).alias("side"), F.col("g2").alias("g")))
    sides = opened.select(F.struct("g1", "g2").alias("pid"), F.explode(F.filter(both, lambda s: (s["side"] == 0) | (F.col("g1") != F.col("g2")))).alias("s"))
    sides = written(_screen_groups(sides.select("pid", "s.side", "s.g").join(members, "g").drop("g"), percent), "op9-sides")
    labels = merge_labels(labels, _open_groups(sides, texts, words, percent), "op9")

    named = member.join(_sent_if_small(labels.select(F.col("doc_id").alias("rep"), "label")), "rep", "left")
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("label", "rep", "doc_id"))
    return named.select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"))


def _named(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs (a, b) of two classes, with label and label_b."""
    own = _sent_if_small(labels)
    named = pairs.join(own.select(F.col("doc_id").alias("a"), "label"), "a").join(own.select(F.col("doc_id").alias("b"), F.col("label").alias("label_b")), "b")
    return named.where("label <> label_b").select("a", "label", "b", "label_b")


def _linked(edges: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Links (a, b) among edges (a, label, b, label_b) by whole sets, each b with blocks of its a."""
    blocks = edges.groupBy("b").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    dealt = edges.join(blocks, "b").withColumn("pid", F.struct("b", F.pmod(F.xxhash64("a"), F.col("blocks")).alias("k")))
    leaders = dealt.select("pid", F.lit(0).alias("side"), F.col("b").alias("doc_id"), F.col("label_b").alias("label")).distinct()
    return _open_groups(leaders.unionByName(dealt.select("pid", F.lit(1).alias("side"), F.col("a").alias("doc_id"), "label")), texts, words, percent)


def _mixed(matrix: DataFrame, labels: DataFrame, salt: int) -> tuple[DataFrame, DataFrame]:
    """The matrix rows with labels, and of each token in more than one class its leading row of this round."""
    named = matrix.join(_sent_if_small(labels), "doc_id")
    lead = F.min(F.struct(F.xxhash64("doc_id", F.lit(salt)).alias("h"), "doc_id", "label", "n")).alias("lead")
    kinds = named.groupBy("token").agg(F.min("label").alias("_lo"), F.max("label").alias("_hi"), lead).where("_lo < _hi")
    return named, kinds.select("token", "lead")
