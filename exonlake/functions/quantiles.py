"""Exact quantiles of groups of any size by repeated histograms, so that no group is one task's list."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..store import written

#: Buckets of a histogram, and distinct values that a bucket may hold for the last step.
BUCKETS, FEW = 1024, 4096
#: Ranges of values that may be broadcast.
MAX_SENT = 100_000


def _same(cols: Sequence[str], prefix: str) -> Column:
    return reduce(and_, (F.col(c).eqNullSafe(F.col(prefix + c)) for c in cols), F.lit(True))


def _renamed(df: DataFrame, cols: Sequence[str], prefix: str) -> DataFrame:
    return df.withColumnsRenamed({c: prefix + c for c in cols})


def _within(rows: DataFrame, ranges: DataFrame, by: list[str]) -> DataFrame:
    """Values with the ranges of their group that hold them; few ranges are sent to all tasks, many meet their group's values by a shuffle, which AQE splits where a group is hot."""
    small = ranges.count() <= MAX_SENT
    return rows.join(F.broadcast(ranges) if small else ranges, _same(by, "_g_") & (F.col("_v") >= F.col("_low")) & (F.col("_v") <= F.col("_high")))


def exact_quantiles(df: DataFrame, value: str, shares: Sequence[float], by: Sequence[str] = (), buckets: int = BUCKETS, few: int = FEW) -> DataFrame:
    """by and ``q``, an array of the quantiles of value at these shares, linear between neighbours; groups without a value are left out.

    Equal values are counted together first.  Each wanted rank (two for each share) has a range of
    values; a round counts the values of each range in buckets of equal width and narrows the range
    to the bucket that holds the rank, until no range has more than ``few`` distinct values.  These
    are then ranked by a window.  What a round leaves is at most its ranks' buckets, and the number
    of rounds depends on how the values spread, not on how many they are: two are usual.
    """
    by = list(by)
    rows = df.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double"))).groupBy(*by, F.col(value).cast("double").alias("_v")).agg(F.count("*").alias("_n"))
    rows = written(rows, "quantile-values")
    sizes = rows.groupBy(*by).agg(F.sum("_n").alias("_size"), F.min("_v").alias("_low"), F.max("_v").alias("_high"), F.count("*").alias("_kinds"))
    wanted = F.array(*(F.struct(F.lit(i).alias("i"), F.lit(float(s)).alias("share")) for i, s in enumerate(shares)))
    place = F.col("_w.share") * (F.col("_size") - 1)
    spots = sizes.withColumn("_w", F.explode(wanted)).withColumn("_rank", F.explode(F.array_distinct(F.array(F.floor(place), F.ceil(place)))))
    # _rank counts from 0 among the values of [_low, _high]; _all is the rank among all
    spots = written(spots.select(*by, F.col("_w.i").alias("_i"), F.col("_rank").alias("_all"), "_rank", "_low", "_high", "_kinds"), "quantile-ranks")
    while not spots.where(F.col("_kinds") > few).isEmpty():
        wide = _renamed(spots.where(F.col("_kinds") > few), by, "_g_")
        hit = _within(rows, wide, by)
        share = (F.col("_v") - F.col("_low")) / (F.col("_high") - F.col("_low"))
        keys = [*(f"_g_{c}" for c in by), "_i", "_all"]
        counts = hit.withColumn("_b", F.least(F.floor(share * buckets), F.lit(buckets - 1))).groupBy(*keys, "_rank", "_b").agg(F.sum("_n").alias("_c"), F.min("_v").alias("_l"), F.max("_v").alias("_h"), F.count("*").alias("_k"))
        before = F.coalesce(F.sum("_c").over(Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        found = counts.withColumn("_before", before).where((F.col("_before") <= F.col("_rank")) & (F.col("_rank") < F.col("_before") + F.col("_c")))
        narrow = found.select(*(F.col(f"_g_{c}").alias(c) for c in by), "_i", "_all", (F.col("_rank") - F.col("_before")).alias("_rank"), F.col("_l").alias("_low"), F.col("_h").alias("_high"), F.col("_k").alias("_kinds"))
        spots = written(spots.where(F.col("_kinds") <= few).unionByName(narrow), "quantile-ranks")
    last = _renamed(spots, by, "_g_")
    hit = _within(rows, last, by)
    keys = [*(f"_g_{c}" for c in by), "_i", "_all"]
    upto = F.sum("_n").over(Window.partitionBy(*keys).orderBy("_v"))
    exact = hit.withColumn("_upto", upto).where((F.col("_upto") > F.col("_rank")) & (F.col("_upto") - F.col("_n") <= F.col("_rank")))
    exact = exact.select(*(F.col(f"_g_{c}").alias(c) for c in by), "_i", "_all", "_v")
    pairs = exact.groupBy(*by, "_i").agg(F.min(F.struct("_all", "_v")).alias("_a"), F.max(F.struct("_all", "_v")).alias("_b"))
    totals = _renamed(sizes.select(*by, "_size"), by, "_g_")
    pairs = pairs.join(totals, _same(by, "_g_")) if by else pairs.crossJoin(F.broadcast(totals))
    share = F.element_at(F.array(*(F.lit(float(s)) for s in shares)), F.col("_i") + 1)
    part = share * (F.col("_size") - 1) - F.col("_a._all")
    value_at = F.col("_a._v") + part * (F.col("_b._v") - F.col("_a._v"))
    ordered = pairs.select(*by, F.struct("_i", value_at.alias("x")).alias("_p")).groupBy(*by).agg(F.array_sort(F.collect_list("_p")).alias("_p"))  # as many as shares
    return ordered.select(*by, F.transform("_p", lambda p: p["x"]).alias("q"))
