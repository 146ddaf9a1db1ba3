"""Where jobs cut their lineage (see exonlake.store), and sizes of Arrow batches of texts."""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..store import dropped, fresh_path, job, shared_dir, written

__all__ = ["dropped", "fresh_path", "job", "shared_dir", "small_batches", "written"]


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Arrow batches of fewer rows than the default, as texts are long; a session that has set a number keeps it."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000":
        spark.conf.set(key, rows)
