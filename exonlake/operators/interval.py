"""Stranded interval operators as binned equi-joins and windows over bins.

Joins put intervals into bins by their length: the finest level's width is fitted to the
lengths of both sides, so that a bin holds little more than what overlaps there, and each
coarser level's bins are FACTOR times wider, so that no row has more than FACTOR + 1 copies
at its own level.  A pair meets at the coarser of its two levels, in the first bin that it
shares there, and so exactly once.  A copy at a level coarser than its own meets only rows
that belong to that level, never another copy, and is made only where the other side has such
rows.  Windows (clusters, nearest, ranks) run within bins; what earlier bins hold comes from
one row per bin, so no chromosome and no gene is one task.  Numbers of bins lead the keys that
joins and windows sort by: few chromosomes and two strands tell hardly any rows apart.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.coords import KEYS, forward, rows_by_suffix
from ..store import written

#: Width of the bins of windows, in bases.
BIN = 4096
#: Bins of a level are so many times wider than those of the level before; levels end where no length goes beyond.
FACTOR, LEVELS = 8, 12
#: Fitted widths are powers of two in this range.
MIN_WIDTH, MAX_WIDTH = 32, 1 << 20
#: Bits of a spot below its bin's number, which say where rows meet.
MEET_BITS = 5


def _last() -> Column:
    return F.greatest(F.col("end") - 1, F.col("start"))


def _size() -> Column:
    return _last() - F.col("start") + 1


def _level(width: int) -> Column:
    """The first level at which a row touches FACTOR + 1 bins at most."""
    return reduce(lambda rest, k: F.when(_size() < width * FACTOR ** (k + 1), k).otherwise(rest), range(LEVELS - 2, -1, -1), F.lit(LEVELS - 1))


def fitted(left: DataFrame, right: DataFrame, bin_size: int | None = None) -> tuple[int, set[int], set[int]]:
    """The width of the finest bins and the levels of either side's rows, from one count of lengths by their number of bits.

    The width is about the median lengths of both sides together, unless bin_size states it.
    """
    bits = F.length(F.bin(_size()))
    cut = bits if bin_size is None else _level(bin_size)
    sides = left.select(F.lit(0).alias("side"), cut.alias("cut")).unionByName(right.select(F.lit(1).alias("side"), cut.alias("cut")))
    counts = [{}, {}]
    for r in sides.groupBy("side", "cut").count().collect():  # 64 lengths a side at most
        counts[r["side"]][r["cut"]] = r["count"]
    if bin_size is not None:
        return bin_size, set(counts[0]), set(counts[1])
    total = 0
    for side in counts:
        seen = 0
        for length in sorted(side):
            seen += side[length]
            if 2 * seen >= sum(side.values()):
                total += 1 << length
                break
    width = min(max(1 << max(total - 1, 1).bit_length(), MIN_WIDTH), MAX_WIDTH)
    level = lambda length: next((k for k in range(LEVELS - 1) if 1 << length <= width * FACTOR ** (k + 1)), LEVELS - 1)
    return width, {level(x) for x in counts[0]}, {level(x) for x in counts[1]}


def _binned(df: DataFrame, width: int, own: set[int], other: set[int], right: bool) -> DataFrame:
    """Adds _spot, the number of a bin and of where rows meet, a row for each bin that an interval touches at each level where it meets others.

    A meet is twice the level, where rows that belong to it on the left meet those and coarser copies
    on the right, and one more, where copies on the left meet rows that belong to it on the right.
    Both are one number, so that joins sort by a key that tells most rows apart at once.
    """
    level, none = F.col("_level"), F.array().cast("array<bigint>")

    def at(meet: int, ok: Column) -> Column:
        size = width * FACTOR ** (meet // 2)
        spot = lambda c: F.shiftleft(F.floor(c / size), MEET_BITS) + F.lit(meet).cast("long")
        return F.when(ok, F.sequence(spot(F.col("start")), spot(_last()), F.lit(1 << MEET_BITS).cast("long"))).otherwise(none)

    if right:
        spots = [at(2 * k, level <= k) for k in sorted(other)] + [at(2 * k + 1, level == k) for k in sorted(own) if any(x < k for x in other)]
    else:
        spots = [at(2 * k, level == k) for k in sorted(own) if any(x <= k for x in other)] + [at(2 * k + 1, level < k) for k in sorted(other)]
    return df.withColumn("_level", _level(width)).withColumn("_spot", F.explode(F.concat(none, *spots))).drop("_level")


def candidates(left: DataFrame, right: DataFrame, by: Sequence[str] = KEYS, suffix: str = "_ref", bin_size: int | None = None) -> tuple[DataFrame, int]:
    """Pairs of rows that share ``by`` and a bin where they meet, and the width of the finest bins; overlap_join keeps those that overlap."""
    width, ours, theirs = fitted(left, right, bin_size)
    other = rows_by_suffix(_binned(right, width, theirs, ours, True), (*by, "_spot"), suffix)
    return _binned(left, width, ours, theirs, False).join(other, ["_spot", *by]), width


def overlap_join(left: DataFrame, right: DataFrame, by: Sequence[str] = KEYS, suffix: str = "_ref", bin_size: int | None = None) -> DataFrame:
    """All pairs of rows that share ``by`` and at least one base; the right columns get the suffix.

    Without a bin_size, widths are fitted to the rows, which reads both sides beforehand: tables that
    are costly to build are best written first.
    """
    pairs, width = candidates(left, right, by, suffix, bin_size)
    level = F.shiftright(F.col("_spot").bitwiseAND((1 << MEET_BITS) - 1), 1).cast("int")
    size = F.element_at(F.array(*(F.lit(width * FACTOR**k) for k in range(LEVELS))), level + 1)
    met = F.shiftright("_spot", MEET_BITS) == F.floor(F.greatest(F.col("start"), F.col("start" + suffix)) / size)
    share = (F.col("start") < F.col("end" + suffix)) & (F.col("start" + suffix) < F.col("end"))
    return pairs.where(share & met).drop("_spot")


def overlapping(left: DataFrame, right: DataFrame, id_col: str, by: Sequence[str] = KEYS, bin_size: int | None = None) -> DataFrame:
    """Left rows that share a base with some right row."""
    hits = overlap_join(left.select(*by, "start", "end", id_col), right.select(*by, "start", "end"), by, bin_size=bin_size).select(id_col).distinct()
    return left.join(hits, id_col, "left_semi")


def not_overlapping(left: DataFrame, right: DataFrame, id_col: str, by: Sequence[str] = KEYS, bin_size: int | None = None) -> DataFrame:
    """Left rows whose id shares no base with any right row."""
    hits = overlap_join(left.select(*by, "start", "end", id_col), right.select(*by, "start", "end"), by, bin_size=bin_size).select(id_col).distinct()
    return left.join(hits, id_col, "left_anti")


def running(df: DataFrame, by: Sequence[str], order: Sequence[str], values: dict[str, Column], bin_size: int | None = BIN, backward: bool = False, position: str = "start", strict: bool = False, after: dict[str, Column] | None = None) -> DataFrame:
    """Running maxima over the rows before each one (minima over those after it, if backward, and of ``after``), by bins of position.

    In a bin a window sees its own rows, led by a row that holds what other bins give.  Without a
    bin_size the window is one for each key, for keys that are small, such as transcripts.  With
    strict, rows before are those of a smaller position, so that equal ones get the same.

    Backward windows run from the last row down: a frame that ends at the last row is read anew for
    every row, which is quadratic in the rows of a key.
    """
    if strict and after:
        raise ValueError("strict values run one way")
    if strict:
        order = [position]
    each = {c: (v, backward) for c, v in values.items()} | {c: (v, True) for c, v in (after or {}).items()}
    turned = lambda cols, down: [F.col(c).desc() if down else F.col(c) for c in cols]
    edge = (Window.unboundedPreceding, -1)
    framed = lambda w: w.rangeBetween(*edge) if strict else w.rowsBetween(*edge)
    pick = lambda col, down: F.min(col) if down else F.max(col)
    if bin_size is None:
        whole = lambda down: framed(Window.partitionBy(*by).orderBy(*turned(order, down)))
        return df.withColumns({c: pick(v, down).over(whole(down)) for c, (v, down) in each.items()})
    binned = df.withColumn("_bin", F.floor(F.col(position) / bin_size)).withColumns({f"_v_{c}": v for c, (v, _) in each.items()})
    there = lambda down: Window.partitionBy(*by).orderBy(*turned(["_bin"], down)).rowsBetween(*edge)
    bins = binned.groupBy(*by, "_bin").agg(*(pick(f"_v_{c}", down).alias(f"_b_{c}") for c, (_, down) in each.items()))
    beyond = (F.col("_bin") + 1) * bin_size if backward else F.col("_bin") * bin_size - 1  # before all rows of the bin on the window's way
    leads = bins.select(*by, "_bin", beyond.cast(df.schema[position].dataType).alias(position), F.lit(False).alias("_own"), *(pick(f"_b_{c}", down).over(there(down)).alias(f"_v_{c}") for c, (_, down) in each.items()))
    rows = binned.withColumn("_own", F.lit(True)).unionByName(leads, allowMissingColumns=True)
    here = lambda down: framed(Window.partitionBy("_bin", *by).orderBy(*([] if strict else ["_own"]), *turned(order, down)))
    return rows.withColumns({c: pick(f"_v_{c}", down).over(here(down)) for c, (_, down) in each.items()}).where("_own").drop("_bin", "_own", *(f"_v_{c}" for c in each))


def cluster(df: DataFrame, by: Sequence[str] = KEYS, out: str = "cluster_start", bin_size: int | None = BIN) -> DataFrame:
    """Adds the start of the island of overlapping or touching intervals that each row is in; with ``by`` it names the island.

    Rows with their reach are written in between, as the second pass reads them twice; df is read twice too.
    """
    seen = running(df, by, ["start", "end"], {"_reach": F.col("end")}, bin_size, strict=True)
    opens = seen.withColumn("_open", F.when(F.col("_reach").isNull() | (F.col("start") > F.col("_reach")), F.col("start")))
    if bin_size is not None:
        opens = written(opens, "reach")
    found = running(opens, by, ["start", "end"], {"_before": F.col("_open")}, bin_size, strict=True)
    return found.withColumn(out, F.coalesce("_open", "_before")).drop("_reach", "_open", "_before")


def number_islands(df: DataFrame, by: Sequence[str], out: str, downward: Column | None = None, bin_size: int = BIN) -> DataFrame:
    """Adds the number of each row's island of overlapping or touching intervals in its key, from 1 along the coordinate, or against it where ``downward`` holds for the key.

    Islands are counted where they open: within bins by a window, over bins from one row for each, so
    a key with very many rows, or the null key, is not one task.  Rows with their reach are written
    in between, as both counts read them.
    """
    seen = running(df, by, ["start", "end"], {"_reach": F.col("end")}, bin_size, strict=True)
    opens = written(seen.select(*df.columns, (F.col("_reach").isNull() | (F.col("start") > F.col("_reach"))).alias("_open")), "reach")
    inside = Window.partitionBy("_bin", *by)
    leads = F.row_number().over(inside.orderBy("start", "end")) == F.rank().over(inside.orderBy("start"))  # one of the rows that begin alike
    marked = opens.withColumn("_bin", F.floor(F.col("start") / bin_size)).withColumn("_leads", (F.col("_open") & leads).cast("int"))
    local = marked.withColumn("_in", F.sum("_leads").over(inside.orderBy("start")))
    names = ["_bin", *reversed(by)]  # what tells most rows apart leads
    whole = Window.partitionBy(*by)
    bins = marked.groupBy(*names).agg(F.sum("_leads").alias("_n"))
    before = F.coalesce(F.sum("_n").over(whole.orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    bins = bins.select(*(F.col(c).alias(f"_k_{i}") for i, c in enumerate(names)), before.alias("_before"), F.sum("_n").over(whole).alias("_all"))
    same = reduce(and_, (F.col(c).eqNullSafe(F.col(f"_k_{i}")) for i, c in enumerate(names)))
    along = F.col("_before") + F.col("_in")
    number = along if downward is None else F.when(downward, F.col("_all") - along + 1).otherwise(along)
    return local.join(bins, same).withColumn(out, number.cast("int")).select(*df.columns, out)


def merge(df: DataFrame, by: Sequence[str] = KEYS, bin_size: int | None = BIN) -> DataFrame:
    """The islands themselves: by, start, end."""
    own = cluster(df.select(*by, "start", "end"), by, "_island", bin_size)
    return own.groupBy(*by, "_island").agg(F.max("end").alias("end")).select(*by, F.col("_island").alias("start"), "end")


def gaps(mask: DataFrame, bounds: DataFrame, by: Sequence[str] = KEYS, bin_size: int = BIN) -> DataFrame:
    """by, start and end of what mask leaves of each key's bounds (by, low, high); keys without mask are one gap.

    A gap ends where a row begins past the reach of all rows before it, so one pass finds them, and
    islands need not be named first.
    """
    seen = running(mask.select(*by, "start", "end"), by, ["start", "end"], {"_reach": F.col("end")}, bin_size)
    between = seen.where("start > _reach").join(bounds.select(*by), list(by), "left_semi").select(*by, F.col("_reach").alias("start"), F.col("start").alias("end"))
    edges = bounds.join(mask.groupBy(*by).agg(F.min("start").alias("_first"), F.max("end").alias("_last")), list(by), "left")
    heads = edges.select(*by, F.col("low").alias("start"), F.coalesce("_first", "high").alias("end"))
    tails = edges.select(*by, F.col("_last").alias("start"), F.col("high").alias("end"))
    return between.unionByName(heads).unionByName(tails).where("start < end")


def subtract(left: DataFrame, mask: DataFrame, id_col: str, by: Sequence[str] = KEYS, bin_size: int | None = None) -> DataFrame:
    """Left rows without the bases that mask covers; one row a fragment, none where nothing is left.

    Fragments are what rows share with the gaps between mask's islands: no row ever holds a list of
    pieces, however many islands it spans.
    """
    bounds = left.groupBy(*by).agg(F.min("start").alias("low"), F.max("end").alias("high"))
    free = written(gaps(mask, bounds, by, bin_size or BIN), "gaps")
    own = overlap_join(left, free, by, "_gap", bin_size)
    return own.withColumns({"start": F.greatest("start", "start_gap"), "end": F.least("end", "end_gap")}).select(*left.columns)


def nearest(queries: DataFrame, sites: DataFrame, site_cols: Sequence[str], by: Sequence[str] = KEYS, bin_size: int = BIN) -> DataFrame:
    """Adds the nearest site on the same strand, either way: ``distance`` and site_start, site_end and site_<col>.

    An overlap has distance 0, neighbours that touch 1.  Equal distances go to the more 3' site;
    of sites at one side, the one that reaches farthest 3' or begins first.
    """
    ahead, behind = F.struct("fe", "fs", *site_cols), F.struct("fs", "fe", *site_cols)
    q = forward(queries).withColumns({"_site": F.lit(False), "_at": F.col("fe"), "_a": F.lit(None), "_b": F.lit(None)})
    s = forward(sites.select(*by, "start", "end", *site_cols)).withColumns({"_site": F.lit(True), "_at": F.col("fs"), "_a": ahead, "_b": behind}).select(*by, "_site", "_at", "_a", "_b")
    q = q.withColumns({"_a": F.lit(None).cast(s.schema["_a"].dataType), "_b": F.lit(None).cast(s.schema["_b"].dataType)})
    rows = q.unionByName(s, allowMissingColumns=True)
    # a site that begins where the query ends is after it: queries sort first among equals
    rows = running(rows, by, ["_at", "_site"], {"_left": F.col("_a")}, bin_size, position="_at", after={"_right": F.col("_b")}).where("not _site")
    d_left = F.greatest(F.lit(0).cast("long"), F.col("fs") - F.col("_left.fe") + 1)
    d_right = F.col("_right.fs") - F.col("fe") + 1
    left = F.col("_left").isNotNull() & (F.col("_right").isNull() | (d_left < d_right))
    side = lambda f: F.when(left, F.col(f"_left.{f}")).otherwise(F.col(f"_right.{f}"))
    plus = F.col("strand") == "+"
    out = rows.withColumns({"distance": F.when(left, d_left).otherwise(d_right), "_fs": side("fs"), "_fe": side("fe"), **{f"site_{c}": side(c) for c in site_cols}})
    out = out.withColumns({"site_start": F.when(plus, F.col("_fs")).otherwise(-F.col("_fe")), "site_end": F.when(plus, F.col("_fe")).otherwise(-F.col("_fs"))})
    return out.select(*queries.columns, "distance", "site_start", "site_end", *(f"site_{c}" for c in site_cols))
