"""P-value adjustment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

BUCKETS = 1000


def _bucket(p: Column) -> Column:
    """Buckets in the order of p: of equal width from 1 / BUCKETS on, below by its logarithm, as small p-values crowd."""
    small = F.when(p > 0, -F.floor(-F.log2(p) * 64)).otherwise(-100_000)
    return F.when(p * BUCKETS >= 1, F.least(F.floor(p * BUCKETS), F.lit(BUCKETS - 1))).otherwise(small)


def benjamini_hochberg(df: DataFrame, p: str = "pvalue", out: str = "padj") -> DataFrame:
    """Adds BH-adjusted p-values; null p-values take no part.

    Ranks and running minima are taken within buckets of p and joined with one row a bucket, so
    that no task holds all p-values.
    """
    known = df.where(F.col(p).isNotNull()).select(p).withColumn("_b", _bucket(F.col(p)))
    per = known.groupBy("_b").agg(F.count("*").alias("_n"))
    all_rows = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumns({"_before": F.coalesce(F.sum("_n").over(all_rows), F.lit(0)), "_m": F.sum("_n").over(Window.partitionBy())})
    values = known.groupBy("_b", p).agg(F.count("*").alias("_c")).join(F.broadcast(per), "_b")
    upto = F.col("_before") + F.sum("_c").over(Window.partitionBy("_b").orderBy(p))
    raw = values.select("_b", p, (F.col(p) * F.col("_m") / upto).alias("_q"))
    low = raw.groupBy("_b").agg(F.min("_q").alias("_lq")).withColumn("_after", F.min("_lq").over(Window.orderBy("_b").rowsBetween(1, Window.unboundedFollowing)))
    here = F.min("_q").over(Window.partitionBy("_b").orderBy(p).rowsBetween(0, Window.unboundedFollowing))
    done = raw.withColumn("_h", here).join(F.broadcast(low.select("_b", "_after")), "_b").select(p, F.least(F.lit(1.0), "_h", F.coalesce("_after", F.lit(1.0))).alias(out))
    return df.join(done, p, "left")


def gene_q_values(df: DataFrame, gene: str = "gene_id", p: str = "pvalue", out: str = "gene_q") -> DataFrame:
    """gene and q-value: the expected share of false genes among those whose least p-value is as small.

    q(t) = sum over n of genes with n values * (1 - (1-t)^n), over the genes with least p <= t; at most 1.
    """
    genes = df.where(F.col(p).isNotNull()).groupBy(gene).agg(F.min(p).alias("_t"), F.count("*").alias("_n"))
    sizes = genes.groupBy("_n").agg(F.count("*").alias("_m")).agg(F.collect_list(F.struct("_n", "_m")).alias("_s"))  # as many rows as gene sizes
    levels = genes.groupBy("_t").agg(F.count("*").alias("_c"))
    levels = levels.withColumn("_b", _bucket(F.col("_t")))
    per = levels.groupBy("_b").agg(F.sum("_c").alias("_k")).withColumn("_before", F.coalesce(F.sum("_k").over(Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    ranked = levels.join(F.broadcast(per), "_b").withColumn("_upto", F.col("_before") + F.sum("_c").over(Window.partitionBy("_b").orderBy("_t")))
    # 1 - (1-t)^n without losing small t
    false_ones = F.aggregate("_s", F.lit(0.0), lambda acc, s: acc - s["_m"] * F.expm1(s["_n"] * F.log1p(-F.col("_t"))))
    q = ranked.crossJoin(F.broadcast(sizes)).select("_t", F.least(F.lit(1.0), false_ones / F.col("_upto")).alias(out))
    return genes.join(q, "_t").select(gene, out)
