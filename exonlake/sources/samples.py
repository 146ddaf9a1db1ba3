"""Sample sheets, expression tracking tables and per-sample quantification."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from .genomic import folder_before

SHEET = "sample_name string, condition string, path string, fastq1 string, fastq2 string"
#: Samples of a sheet, which the driver reads; more are an error.
MAX_SAMPLES = 100_000
QUANT = "Name string, Length double, EffectiveLength double, TPM double, NumReads double"


@dataclass(frozen=True)
class Design:
    """What a sample sheet says; sheets are small and read on the driver."""

    samples: tuple[str, ...]
    conditions: tuple[str, ...]
    single_end: bool

    @property
    def base(self) -> str:
        return self.conditions[0]

    def contrast(self) -> str:
        if len(self.conditions) != 2:
            raise ValueError(f"a contrast needs two conditions, not {len(self.conditions)}")
        return f"{self.conditions[1]}vs{self.conditions[0]}"


def read_samples(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, header=True, schema=SHEET)


def design(sheet: DataFrame, base_condition: str | None = None) -> Design:
    """Checks a sheet: no hyphens in names; the base is the stated condition or the first row's."""
    rows = sheet.coalesce(1).select("sample_name", "condition", "fastq2").limit(MAX_SAMPLES + 1).collect()
    if len(rows) > MAX_SAMPLES:
        raise ValueError(f"more than {MAX_SAMPLES} samples")
    names = [r["sample_name"] for r in rows]
    if bad := [n for n in names if n is None or "-" in n]:
        raise ValueError(f"sample names must not have hyphens: {bad}")
    if len(set(names)) < len(names):
        raise ValueError("sample names repeat")
    conditions = list(dict.fromkeys(r["condition"] for r in rows))
    if base_condition is not None:
        if base_condition not in conditions:
            raise ValueError(f"no sample has condition {base_condition}")
        conditions.sort(key=lambda c: c != base_condition)
    return Design(tuple(names), tuple(conditions), all(r["fastq2"] is None for r in rows))


def tracking_table(wide: DataFrame, samples: Sequence[str]) -> DataFrame:
    """Long form of a tracking table with one packed column a sample: transcript_id, gene_id, sample, sample_tx, tpm.

    A packed value is q:gene|transcript|exons|..|TPM|length, or - where the sample has none.
    """
    rows = wide.unpivot(["transcript_id", "gene_id", "ref_gene_id", "overlap_class_code"], list(samples), "sample", "packed")
    parts = F.split("packed", "\\|")
    has = F.coalesce(F.col("packed"), F.lit("-")) != "-"
    tpm = F.expr("try_cast(element_at(split(packed, '[|]'), -2) as double)")
    return rows.select("transcript_id", "gene_id", "ref_gene_id", "overlap_class_code", "sample", F.when(has, parts[1]).alias("sample_tx"), F.when(has, tpm).otherwise(0.0).alias("tpm"))


def read_tracking(spark: SparkSession, path: str, samples: Sequence[str]) -> DataFrame:
    schema = ", ".join(f"`{c}` string" for c in ("transcript_id", "gene_id", "ref_gene_id", "overlap_class_code", *samples))
    return tracking_table(spark.read.csv(path, sep="\t", schema=schema), samples)


def read_quant(spark: SparkSession, folder: str, samples: Sequence[str], name: str = "quant.sf") -> DataFrame:
    """transcript_id, sample, length, tpm and count of every sample's folder; a missing one fails the read."""
    rows = spark.read.csv([f"{folder}/{s}/{name}" for s in samples], sep="\t", header=True, schema=QUANT)
    sample = folder_before(name)
    return rows.select(F.col("Name").alias("transcript_id"), sample.alias("sample"), F.col("EffectiveLength").alias("length"), F.col("TPM").alias("tpm"), F.col("NumReads").alias("count"))
