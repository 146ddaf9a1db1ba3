"""FASTA as a table of chunks, read by byte range with the geometry of its index.

The index (.fai: name, length, offset, bases and bytes a line) is a table of its own; every
chunk of a sequence is a row, read by the task that holds it, so no task reads a genome.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyarrow.fs import FileSystem
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.motif import reverse_complement

CHUNK = 1 << 16
FAI = "chrom string, length long, offset long, linebases long, linewidth long"


def read_fai(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, sep="\t", schema=FAI)


def chunk_plan(fai: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """chrom, chunk and the byte range that holds its bases and line ends."""
    rows = fai.where("length > 0").withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("length") - 1) / chunk))))
    at = lambda p: F.col("offset") + F.floor(p / F.col("linebases")) * F.col("linewidth") + p % F.col("linebases")
    low, high = F.col("chunk") * chunk, F.least(F.col("length"), (F.col("chunk") + 1) * chunk) - 1
    return rows.select("chrom", "chunk", at(low).alias("first"), (at(high) + 1).alias("past"))


def read_fasta(spark: SparkSession, path: str, chunk: int = CHUNK, fai: str | None = None) -> DataFrame:
    """Genome table (chrom, chunk, seq) of an indexed FASTA file; each task reads its byte ranges from the file system that the path names (a folder, HDFS, an object store)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, name = FileSystem.from_uri(path)
        with system.open_input_file(name) as file:
            for batch in batches:
                seqs = [file.read_at(past - first, first).replace(b"\n", b"").replace(b"\r", b"").decode() for first, past in zip(batch["first"], batch["past"], strict=True)]
                yield pd.DataFrame({"chrom": batch["chrom"], "chunk": batch["chunk"], "seq": seqs})

    plan = chunk_plan(read_fai(spark, fai or f"{path}.fai"), chunk)
    return plan.repartition("chrom", "chunk").mapInPandas(run, "chrom string, chunk long, seq string")


def fasta_records(lines: DataFrame) -> DataFrame:
    """name and sequence of records whose whole text is one value (split at >), such as transcript files."""
    parts = F.split("value", "\n", 2)
    return lines.where("trim(value) <> ''").select(F.regexp_extract(parts[0], r"^>?(\S+)", 1).alias("name"), F.regexp_replace(F.coalesce(F.get(parts, F.lit(1)), F.lit("")), r"\s", "").alias("sequence"))


def read_transcripts(spark: SparkSession, path: str) -> DataFrame:
    """Records of a FASTA file of short sequences, cut at each header; needs no index."""
    return fasta_records(spark.read.option("lineSep", "\n>").text(path))


def transcript_sequences(exons: DataFrame, genome: DataFrame, chunk: int = CHUNK, id_col: str = "transcript_id") -> DataFrame:
    """The spliced sequence of each transcript, 5' to 3'."""
    last = F.greatest(F.col("end") - 1, F.col("start"))
    spots = exons.withColumn("chunk", F.explode(F.sequence(F.floor(F.col("start") / chunk), F.floor(last / chunk))))
    low, high = F.greatest(F.col("start") - F.col("chunk") * chunk, F.lit(0)), F.least(F.col("end") - F.col("chunk") * chunk, F.lit(chunk))
    part = F.substring(F.col("seq"), (low + 1).cast("int"), (high - low).cast("int"))
    pieces = spots.join(genome, ["chrom", "chunk"]).groupBy(id_col, "strand").agg(F.array_sort(F.collect_list(F.struct("start", "chunk", part.alias("p")))).alias("_p"))
    seq = F.array_join(F.transform("_p", lambda x: x["p"]), "")
    return pieces.select(id_col, F.when(F.col("strand") == "-", reverse_complement(seq)).otherwise(seq).alias("sequence"))
