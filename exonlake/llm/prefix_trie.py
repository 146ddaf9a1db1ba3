"""The trie of conversation prefixes, rolled up in bands of depth.

A node is a distinct sequence of first turns (role, text); its members are the conversations
that begin so.  ``numbered`` gives every turn its place, ``prefixes`` every conversation's
nodes, ``trie`` the nodes with their members, children and what their subtrees sum up to.

Places: rows are range-partitioned by conversation and turn, so that one conversation may
span many tasks, and counted per (conversation, task).  Names of nodes: a turn at a place has
a digest of its place, role and text, cut into four numbers of 40 bits; a prefix is named by
the sums of these over its turns, taken within blocks of BLOCK places and joined with one row
a block, so that no conversation is one task.

Rollup: a node adds its own values to its ancestors within its band of ``height`` depths only,
at most ``height`` rows a node.  The tops of bands with these sums are a trie of their own, of a
depth that is ``height`` times smaller, and are rolled up the same way, and so on until one
band is left.  Then the completed totals of band tops go to the ancestors in the band above
them, level by level down.  So there are 2 * log(depth) / log(height) rounds, each of which
explodes a node into ``height`` rows at most.

The digest of the members that end at a node is a running SHA-256 over pieces of ids: pieces
are made within ranges of (node, id), and only they meet in order, one row for PIECE ids.

Defined cases: turns are ordered by turn (null first), then role, then text; null role and
text are empty; repeated rows are turns of their own; rows with a null conv_id belong to no
conversation; a conversation without a turn left is a member of the root; an empty table gives
no node, not even the root; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .hotjoin import join_counted
from .store import written

ROOT = "root"
#: Depths of a band.
HEIGHT = 16
#: Places of a block of running sums.
BLOCK = 1024
#: Ids of a piece of a digest.
PIECE = 4096
#: Conversations whose first turns come from the first of them.
FAMILY = 20
LANES = ("l0", "l1", "l2", "l3")


def numbered(conversations: DataFrame) -> DataFrame:
    """conv_id, part, place (within conv_id and part, from 0), digest and words of every turn; written, as parts are of one run."""
    rows = conversations.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text"), F.rand(7)]  # equal turns may be split too
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order[:-1]).withColumn("_id", F.monotonically_increasing_id())
    digest = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)
    words = F.when(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.size(F.split(F.regexp_replace("text", r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", ""), r"[\x20\x09-\x0D]+"))).otherwise(0)
    placed = written(placed.select("conv_id", "_id", F.unhex(digest).alias("digest"), words.cast("long").alias("words")), "op11-turns")
    placed = placed.withColumn("part", F.shiftright("_id", 33))
    firsts = placed.groupBy("conv_id", "part").agg(F.min("_id").alias("_first"))
    return placed.join(firsts, ["conv_id", "part"]).select("conv_id", "part", (F.col("_id") - F.col("_first")).alias("place"), "digest", "words")


def borrowed_turns(conv_id: Column) -> Column:
    """Number of turns that a conversation takes from the first of its family."""
    return F.crc32(F.encode(conv_id.cast("string"), "utf-8")) % 4


def rebuilt(turns: DataFrame, family: int = FAMILY) -> tuple[DataFrame, DataFrame]:
    """Turns (conv_id, place, digest, words, last) of rebuilt conversations, and (conv_id, size) of all of them."""
    parts = written(turns.groupBy("conv_id", "part").agg(F.count("*").alias("_n")), "op11-parts")
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    convs = parts.groupBy("conv_id").agg(F.sum("_n").alias("_own")).withColumns({"_h": borrowed_turns(F.col("conv_id")), "_base": F.col("conv_id") - F.col("conv_id") % family})
    bases = convs.select(F.col("conv_id").alias("_base"), F.col("_own").alias("_there"))
    convs = convs.join(bases, "_base", "left").withColumn("_taken", F.least("_h", F.coalesce("_there", F.lit(0))))
    convs = written(convs.select("conv_id", "_base", "_h", "_taken", (F.col("_taken") + F.greatest(F.col("_own") - F.col("_h"), F.lit(0))).alias("size")), "op11-convs")
    known = offsets.join(convs, "conv_id").select("conv_id", "part", "_before", "_h", "_taken", "size")
    own = turns.join(known, ["conv_id", "part"]).withColumn("place", F.col("place") + F.col("_before"))
    heads = turns.join(offsets.where("_before < 3").select("conv_id", "part", "_before"), ["conv_id", "part"]).select(F.col("conv_id").alias("_base"), (F.col("place") + F.col("_before")).alias("place"), "digest", "words").where("place < 3")
    taken = convs.where("_taken > 0").join(heads, "_base").where("place < _taken")
    out = ["conv_id", "place", "digest", "words", "size"]
    kept = own.where("place >= _h").withColumn("place", F.col("place") - F.col("_h") + F.col("_taken"))
    return kept.select(*out).unionByName(taken.select(*out)).withColumn("last", F.col("place") + 1 == F.col("size")).drop("size"), convs.select("conv_id", "size")


def _name(depth: Column, lanes: list[Column]) -> Column:
    return F.when(depth == 0, ROOT).otherwise(F.md5(F.concat_ws(":", depth, *lanes)))


def prefixes(turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """conv_id, depth (from 1), node, parent, words and last of every turn."""
    hashed = turns.withColumn("_x", F.sha2(F.concat(F.encode(F.concat(F.col("place").cast("string"), F.lit(":")), "utf-8"), F.col("digest")), 256)).drop("digest")
    cut = hashed.withColumns({lane: F.conv(F.substring("_x", 1 + 10 * i, 10), 16, 10).cast("long") for i, lane in enumerate(LANES)}).withColumn("_block", F.floor(F.col("place") / block)).drop("_x")
    within = Window.partitionBy("conv_id", "_block").orderBy("place")
    sums = cut.withColumns({f"_s{lane}": F.sum(lane).over(within) for lane in LANES})
    blocks = cut.groupBy("conv_id", "_block").agg(*(F.sum(lane).alias(lane) for lane in LANES))
    earlier = Window.partitionBy("conv_id").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("conv_id", "_block", *(F.coalesce(F.sum(lane).over(earlier), F.lit(0)).alias(f"_b{lane}") for lane in LANES))
    upto = [F.col(f"_s{lane}") + F.col(f"_b{lane}") for lane in LANES]
    above = [F.col(f"_s{lane}") + F.col(f"_b{lane}") - F.col(lane) for lane in LANES]
    depth = F.col("place") + 1
    return sums.join(blocks, ["conv_id", "_block"]).select("conv_id", depth.alias("depth"), _name(depth, upto).alias("node"), _name(F.col("place"), above).alias("parent"), "words", "last")


def _chains(rows: DataFrame, stride: int, height: int) -> DataFrame:
    """For each conversation and band of depths that are multiples of the stride, the band's nodes in order of depth."""
    own = rows.where(F.col("depth") % stride == 0).withColumn("_band", F.floor(F.col("depth") / (stride * height)))
    chains = own.groupBy("conv_id", "_band").agg(F.array_sort(F.collect_list(F.struct("depth", "node"))).alias("_c"))  # at most height
    nodes = F.transform("_c", lambda s: s["node"])
    return chains.select("conv_id", "_band", F.when(F.col("_band") == 0, F.concat(F.array(F.lit(ROOT)), nodes)).otherwise(nodes).alias("_chain"))


def _add_up(values: DataFrame, chains: DataFrame, stride: int, height: int, band: Column, upto: Column, sums: list[str]) -> DataFrame:
    """Sums of values over the first ``upto`` nodes of the chain that each row's conversation has in the band."""
    own = values.withColumns({"_band": band, "_upto": upto})
    met = own.join(chains, ["conv_id", "_band"])
    return met.select(F.explode(F.slice("_chain", F.lit(1), F.col("_upto").cast("int"))).alias("node"), *sums).groupBy("node").agg(*(F.sum(c).alias(c) for c in sums))


def rollup(nodes: DataFrame, rows: DataFrame, sums: list[str], height: int = HEIGHT) -> DataFrame:
    """node and the sums of its subtree, itself included; nodes has node, conv_id, depth and sums, rows the nodes of each conversation.

    The root's chain needs no row: every conversation begins with it.
    """
    deepest = nodes.agg(F.coalesce(F.max("depth"), F.lit(0))).first()[0]
    place = nodes.select("node", "conv_id", "depth")
    values, stride, found = nodes.select("node", "conv_id", "depth", *sums), 1, []
    while True:
        chains = written(_chains(rows, stride, height), "op11-chains")
        # a conversation that has the root only has no chain: the root adds to itself by a chain of its own
        level = values.where("depth > 0")
        inside = _add_up(level, chains, stride, height, F.floor(F.col("depth") / (stride * height)), F.floor(F.col("depth") / stride) % height + 1, sums)
        whole = inside.unionByName(values.where("depth = 0").select("node", *sums)).groupBy("node").agg(*(F.sum(c).alias(c) for c in sums))
        whole = written(whole.join(place, "node"), "op11-bands")
        found.append((stride, chains, whole))
        stride *= height
        if deepest < stride:
            break
        values = whole.where(F.col("depth") % stride == 0)
    total = found[-1][2]
    for stride, chains, inside in reversed(found[:-1]):
        tops = total.where(F.col("depth") > 0)
        lent = _add_up(tops, chains, stride, height, F.floor(F.col("depth") / (stride * height)) - 1, F.lit(height), sums)
        both = inside.select("node", *sums).unionByName(lent)
        total = written(both.groupBy("node").agg(*(F.sum(c).alias(c) for c in sums)).join(place, "node"), "op11-totals")
    return total.select("node", *sums)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, conv_id) in order to (node, first, n, text): ids of a node joined by commas, PIECE at most."""
    node, ids = None, []

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"node": [node], "first": pa.array([ids[0]], pa.int64()), "text": [",".join(map(str, ids))]})

    for batch in batches:
        for of, one in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if ids and (of != node or len(ids) == PIECE):
                yield out()
                ids = []
            node = of
            ids.append(one)
    if ids:
        yield out()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, first, text) in order to (node, ends_sha256); only one node's running digest is held."""
    node, state = None, None
    for batch in batches:
        names, values = [], []
        for of, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
            if of != node:
                if state is not None:
                    names.append(node)
                    values.append(state.hexdigest())
                node, state = of, hashlib.sha256(text.encode())
            else:
                state.update(b"," + text.encode())
        if names:
            yield pa.RecordBatch.from_pydict({"node": names, "ends_sha256": values})
    if state is not None:
        yield pa.RecordBatch.from_pydict({"node": [node], "ends_sha256": [state.hexdigest()]})


def end_digests(ends: DataFrame) -> DataFrame:
    """node and the SHA-256 of the ids, ascending and joined by commas, of the conversations that end there."""
    order = ["node", "conv_id"]
    pieces = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_pieces, "node string, first long, text string")
    return pieces.repartition("node").sortWithinPartitions("node", "first").mapInArrow(_digests, "node string, ends_sha256 string")


def trie(conversations: DataFrame, family: int = FAMILY, height: int = HEIGHT, block: int = BLOCK) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens and ends_sha256 of every node."""
    turns, convs = rebuilt(written(numbered(conversations), "op11-numbered"), family)
    rows = written(prefixes(turns, block), "op11-prefixes")
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0").select(F.lit(ROOT).alias("node"), F.lit(0).cast("long").alias("depth"), F.lit(None).cast("string").alias("parent"), "conv_id", "n_convs", F.lit(0).cast("long").alias("words"))
    nodes = rows.groupBy("node").agg(F.min("depth").cast("long").alias("depth"), F.min("parent").alias("parent"), F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.min("words").alias("words")).unionByName(root)
    nodes = written(nodes, "op11-nodes")
    children = nodes.where("parent is not null").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
    nodes = nodes.join(children, "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    nodes = written(nodes.withColumns({"n_leaves": (F.col("n_children") == 0).cast("long"), "saved_tokens": (F.col("n_convs") - 1) * F.col("words")}), "op11-counted")
    totals = rollup(nodes, rows, ["n_leaves", "saved_tokens"], height)
    parents = nodes.where("n_children > 0").select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"), F.col("n_children").alias("_rows"))
    n_children = parents.agg(F.coalesce(F.sum("_rows"), F.lit(0))).first()[0]
    out = join_counted(nodes.drop("n_leaves", "saved_tokens"), parents, "parent", "_rows", n_children, "node")
    ends = rows.where("last").select("node", "conv_id").unionByName(convs.where("size = 0").select(F.lit(ROOT).alias("node"), "conv_id"))
    out = out.join(totals, "node").join(end_digests(ends), "node", "left")
    none = hashlib.sha256(b"").hexdigest()
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"))
