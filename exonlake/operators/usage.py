"""Abundance and usage of last exons from long tables (le_id, gene_id, sample, value)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.quantiles import exact_quantiles


def mean_over_samples(df: DataFrame, n_samples: int, id_col: str, value: str = "tpm", out: str = "mean_tpm") -> DataFrame:
    """Mean over all samples; a sample without a row counts 0."""
    return df.groupBy(id_col).agg((F.sum(value) / n_samples).alias(out))


def keep_expressed(gtf: DataFrame, tracking: DataFrame, min_mean_tpm: float = 1.0) -> DataFrame:
    """Rows of every sample whose transcripts belong to a tracked transcript with a mean TPM over all samples of at least so much.

    tracking: transcript_id, sample, sample_tx, tpm.  gtf: sample, transcript_id and others.
    """
    n = tracking.agg(F.count_distinct("sample").alias("_k"))
    means = tracking.groupBy("transcript_id").agg(F.sum("tpm").alias("_t")).crossJoin(F.broadcast(n)).where(F.col("_t") / F.col("_k") >= min_mean_tpm)
    own = tracking.join(means.select("transcript_id"), "transcript_id", "left_semi").where("sample_tx is not null").select("sample", F.col("sample_tx").alias("transcript_id")).distinct()
    return gtf.join(own, ["sample", "transcript_id"], "left_semi")


def _scaled(df: DataFrame, id_col: str) -> DataFrame:
    """Adds scaled: tpm times the mean length over samples, brought to the sample's total count."""
    lengths = df.groupBy(id_col).agg(F.avg("length").alias("_len"))
    own = df.join(lengths, id_col).withColumn("_raw", F.col("tpm") * F.col("_len"))
    totals = own.groupBy("sample").agg((F.sum("count") / F.nullif(F.sum("_raw"), F.lit(0.0))).alias("_f"))
    return own.join(F.broadcast(totals), "sample").withColumn("scaled", F.coalesce(F.col("_raw") * F.col("_f"), F.lit(0.0))).drop("_raw", "_f", "_len")


def last_exon_abundance(quant: DataFrame, tx2le: DataFrame) -> DataFrame:
    """le_id, sample, tpm, length and length-scaled count, summed over the transcripts of each last exon.

    quant: transcript_id, sample, tpm, length, count.  A last exon's length is the abundance-weighted
    mean of its transcripts; without abundance in a sample, the geometric mean of its other samples,
    and without any the plain mean of its transcripts' lengths.
    """
    rows = _scaled(quant, "transcript_id").join(tx2le, "transcript_id")
    sums = rows.groupBy("le_id", "sample").agg(F.sum("tpm").alias("tpm"), F.sum("scaled").alias("count"), F.sum(F.col("tpm") * F.col("length")).alias("_w"), F.sum("length").alias("_ls"), F.count("*").alias("_lc"))
    own = Window.partitionBy("le_id")
    length = F.try_divide(F.col("_w"), F.nullif(F.col("tpm"), F.lit(0.0)))
    sums = sums.withColumn("_l", length).withColumns({"_g": F.exp(F.avg(F.ln("_l")).over(own)), "_a": F.sum("_ls").over(own) / F.sum("_lc").over(own)})
    filled = sums.select("le_id", "sample", "tpm", "count", F.coalesce("_l", "_g", "_a").alias("length"))
    return _scaled(filled, "le_id").select("le_id", "sample", "tpm", "length", F.col("scaled").alias("count"))


def gene_totals(df: DataFrame, value: str = "tpm") -> DataFrame:
    return df.groupBy("gene_id", "sample").agg(F.sum(value).alias(value))


def by_condition(df: DataFrame, samples: DataFrame, ids: Sequence[str], value: str, functions: Sequence[str] = ("mean", "median")) -> DataFrame:
    """mean_<value> and median_<value> (exact) of each id by condition."""
    known = {"mean": F.avg(value), "median": F.median(value)}
    return df.join(F.broadcast(samples.select("sample", "condition")), "sample").groupBy(*ids, "condition").agg(*(known[f].alias(f"{f}_{value}") for f in functions))


def usage_shares(df: DataFrame, value: str = "tpm", out: str = "ppau") -> DataFrame:
    """The share of its gene's value that each last exon has in a sample; 0 where the gene has none."""
    total = F.sum(value).over(Window.partitionBy("gene_id", "sample"))
    return df.withColumn(out, F.coalesce(F.try_divide(F.col(value), total), F.lit(0.0)))


def condition_means(df: DataFrame, samples: DataFrame, base: str, treatment: str, value: str = "ppau") -> DataFrame:
    """le_id, gene_id, mean of value in both conditions and their difference."""
    rows = df.join(F.broadcast(samples.select("sample", "condition")), "sample")
    mean = lambda c: F.avg(F.when(F.col("condition") == c, F.col(value)))
    out = rows.groupBy("le_id", "gene_id").agg(mean(base).alias("mean_base"), mean(treatment).alias("mean_treatment"))
    return out.withColumn("delta", F.col("mean_treatment") - F.col("mean_base"))


def size_factors(counts: DataFrame) -> DataFrame:
    """sample and size factor: the median over last exons with counts in all samples of count over geometric mean."""
    n = counts.agg(F.count_distinct("sample").alias("_k"))
    logs = counts.groupBy("le_id").agg(F.avg(F.when(F.col("count") > 0, F.ln("count"))).alias("_g"), F.count(F.when(F.col("count") > 0, 1)).alias("_c")).crossJoin(F.broadcast(n)).where("_c = _k").select("le_id", "_g")
    ratios = counts.join(logs, "le_id").select("sample", (F.col("count") / F.exp("_g")).alias("_ratio"))
    return exact_quantiles(ratios, "_ratio", [0.5], ["sample"]).select("sample", F.col("q")[0].alias("size_factor"))


def _largest_mean(df: DataFrame, samples: DataFrame, value, least: float) -> DataFrame:
    """Ids whose greater condition mean of value exceeds ``least``."""
    rows = df.join(F.broadcast(samples.select("sample", "condition")), "sample").groupBy("le_id", "condition").agg(F.avg(value).alias("_m"))
    return rows.groupBy("le_id").agg(F.max("_m").alias("_m")).where(F.col("_m") > least).select("le_id")


def min_mean_count(counts: DataFrame, samples: DataFrame, least: float = 10) -> DataFrame:
    """Rows of last exons whose mean normalised count exceeds ``least`` in some condition."""
    normal = counts.join(F.broadcast(size_factors(counts)), "sample")
    return counts.join(_largest_mean(normal, samples, F.col("count") / F.col("size_factor"), least), "le_id", "left_semi")


def min_relative_usage(counts: DataFrame, samples: DataFrame, least: float = 0.05) -> DataFrame:
    """Rows of last exons whose mean share of the gene's counts exceeds ``least`` in some condition."""
    return counts.join(_largest_mean(usage_shares(counts, "count", "_share"), samples, F.col("_share"), least), "le_id", "left_semi")


def several_isoforms(df: DataFrame) -> DataFrame:
    """Rows of genes with more than one last exon."""
    genes = df.groupBy("gene_id").agg(F.count_distinct("le_id").alias("_n")).where("_n > 1").select("gene_id")
    return df.join(genes, "gene_id", "left_semi")


def wide(df: DataFrame, ids: Sequence[str], samples: Sequence[str], value: str) -> DataFrame:
    """A matrix with one column a sample."""
    return df.groupBy(*ids).pivot("sample", list(samples)).agg(F.first(value))


def long(df: DataFrame, ids: Sequence[str], samples: Sequence[str], value: str) -> DataFrame:
    """The matrix as rows (ids, sample, value)."""
    return df.unpivot(list(ids), list(samples), "sample", value)
