"""Tables that a job reads several times, written once in the folder that the cluster shares, and their removal."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_jobs: list[list[str]] = []


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir of the session; where it names none, a local folder in local mode and an error on a cluster."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not folder:
        folder = spark.sparkContext._jsc.sc().getCheckpointDir()
        folder = folder.get() if folder.isDefined() else None
        if not folder and not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        folder = folder or f"file://{tempfile.mkdtemp(prefix='spark-')}"
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; the job that it is made in, if any, removes it."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if _jobs:
        _jobs[-1].append(path)
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table in the shared folder: plans that read it start there, and a lost executor costs a read."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def removed(spark: SparkSession, path: str) -> None:
    own = spark._jvm.org.apache.hadoop.fs.Path(path)
    own.getFileSystem(spark._jsc.hadoopConfiguration()).delete(own, True)


def dropped(df: DataFrame) -> None:
    """Delete the files of a table that written() made and nothing reads any more."""
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        removed(df.sparkSession, folder)


@contextmanager
def job(spark: SparkSession) -> Iterator[None]:
    """A scope whose tables in the shared folder are removed at its end, also if it fails.

    What a caller makes of them must be written, outside the folder or in an outer scope, before it ends.
    """
    _jobs.append([])
    try:
        yield
    finally:
        for path in _jobs.pop():
            removed(spark, path)
