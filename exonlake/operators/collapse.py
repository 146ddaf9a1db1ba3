"""One row per id: metadata collapsed in a stated order."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.quantiles import exact_quantiles


def collapse_metadata(df: DataFrame, id_col: str, order: Sequence[str], standard: Sequence[str] = (), all_values: Sequence[str] = (), distinct_values: Sequence[str] = (), separator: str = ",") -> DataFrame:
    """id_col with the first of ``standard``, all of ``all_values`` and the distinct ones of ``distinct_values``, each joined, by the given order; nulls read NULL."""
    cols = [*dict.fromkeys([*standard, *all_values, *distinct_values])]
    rows = df.groupBy(id_col).agg(F.array_sort(F.collect_list(F.struct(*order, F.struct(*(F.col(c).alias(f"v_{c}") for c in cols)).alias("_v")))).alias("_r"))
    value = lambda c: F.transform("_r", lambda r: r["_v"][f"v_{c}"])
    text = lambda c: F.transform(value(c), lambda v: F.coalesce(v.cast("string"), F.lit("NULL")))
    first = {c: F.element_at(value(c), 1) for c in standard if c != id_col}
    joined = {c: F.array_join(text(c), separator) for c in all_values}
    once = {c: F.array_join(F.array_distinct(text(c)), separator) for c in distinct_values}
    return rows.select(id_col, *(v.alias(c) for c, v in (first | joined | once).items()))


def fill_nulls(df: DataFrame, cols: Sequence[str], text: str = "NULL") -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit(text)) for c in cols})


def count_ids(df: DataFrame, id_col: str) -> DataFrame:
    return df.agg(F.count_distinct(id_col).alias("n"))


def first_of_duplicates(df: DataFrame, subset: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The first row, in a stated order, of those that agree in subset."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*subset).orderBy(*order))).where("_n = 1").drop("_n")


def inconsistent_ids(df: DataFrame, id_col: str, cols: Sequence[str]) -> DataFrame:
    """Ids whose columns, each expected to go with the others, have more than two different numbers of distinct values."""
    counts = df.groupBy(id_col).agg(*(F.count_distinct(c).alias(c) for c in cols))
    return counts.where(F.size(F.array_distinct(F.array(*cols))) > 2).select(id_col)


def collapse_consistent(df: DataFrame, id_col: str, cols: Sequence[str], order: Sequence[str], separator: str = ",") -> DataFrame:
    """Collapses the distinct values of every id that is consistent; the rows of others stay as they are."""
    odd = inconsistent_ids(df, id_col, cols)
    whole = collapse_metadata(df.join(odd, id_col, "left_anti"), id_col, order, distinct_values=cols, separator=separator)
    rest = df.join(odd, id_col, "left_semi").select(id_col, *(F.col(c).cast("string").alias(c) for c in cols))
    return whole.unionByName(rest)


def value_counts(df: DataFrame, cols: Sequence[str], id_col: str | None = None) -> DataFrame:
    """Rows, or distinct ids, for each combination of values."""
    return df.groupBy(*cols).agg((F.count_distinct(id_col) if id_col else F.count("*")).alias("n"))


def value_shares(df: DataFrame, within: Sequence[str], col: str) -> DataFrame:
    """Counts of col's values within groups, and their share of the group."""
    counts = df.groupBy(*within, col).agg(F.count("*").alias("n"))
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(*within)))


def describe(df: DataFrame, col: str, by: Sequence[str] = ()) -> DataFrame:
    """count, mean, std, min, exact deciles and max."""
    out = df.groupBy(*by).agg(F.count(col).alias("count"), F.avg(col).alias("mean"), F.stddev(col).alias("std"), F.min(col).alias("min"), F.max(col).alias("max"))
    deciles = exact_quantiles(df, col, [k / 10 for k in range(1, 10)], by).withColumnsRenamed({c: f"_g_{c}" for c in by})
    same = reduce(and_, (F.col(c).eqNullSafe(F.col(f"_g_{c}")) for c in by), F.lit(True))
    return out.join(deciles, same, "left").select(*by, "count", "mean", "std", "min", *(F.col("q")[k].alias(f"p{k + 1}0") for k in range(9)), "max")
