"""Evidence for 3' ends: atlas sites nearby, signal motifs, and the choice of one row a last exon."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.coords import on_plus, terminal_window, three_end_base
from ..functions.motif import GRUBER_MOTIFS, least_deviation, motif_hits, motif_string, parse_motif_string, reverse_complement
from .interval import BIN, nearest

ATLAS_COLS = ["nearest_atlas_distance", "atlas_name", "atlas_start", "atlas_end", "atlas_filter"]


def nearest_atlas_site(df: DataFrame, atlas: DataFrame, max_distance: int = 100, bin_size: int = BIN) -> DataFrame:
    """Adds the nearest atlas site (chrom, strand, start, end, name) to each 3' end and atlas_filter, 1 if it is near enough; 0 where there is none."""
    ends = three_end_base(df.withColumns({"_s": F.col("start"), "_e": F.col("end")}))
    found = nearest(ends, atlas, ["name"], bin_size=bin_size)
    near = F.coalesce((F.col("distance") <= max_distance).cast("int"), F.lit(0))
    return found.withColumns({"start": F.col("_s"), "end": F.col("_e"), "atlas_filter": near}).withColumnsRenamed({"distance": "nearest_atlas_distance", "site_name": "atlas_name", "site_start": "atlas_start", "site_end": "atlas_end"}).drop("_s", "_e")


def region_sequences(regions: DataFrame, genome: DataFrame, id_col: str, chunk: int, out: str = "sequence") -> DataFrame:
    """Adds the sequence of each region from a genome of chunks (chrom, chunk, seq); reverse-complemented on -."""
    last = F.greatest(F.col("end") - 1, F.col("start"))
    spots = regions.withColumn("chunk", F.explode(F.sequence(F.floor(F.col("start") / chunk), F.floor(last / chunk))))
    low, high = F.greatest(F.col("start") - F.col("chunk") * chunk, F.lit(0)), F.least(F.col("end") - F.col("chunk") * chunk, F.lit(chunk))
    part = F.substring(F.col("seq"), (low + 1).cast("int"), (high - low).cast("int"))
    parts = spots.join(genome, ["chrom", "chunk"]).select(id_col, "strand", "chunk", part.alias("_p"))
    seq = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("chunk", "_p"))), lambda x: x["_p"]), "")
    whole = parts.groupBy(id_col, "strand").agg(seq.alias("_q")).select(id_col, F.when(F.col("strand") == "-", reverse_complement(F.col("_q"))).otherwise(F.col("_q")).alias(out))
    return regions.join(whole, id_col, "left")


def terminal_motifs(df: DataFrame, genome: DataFrame, id_col: str, chunk: int, motifs: Sequence[str] = GRUBER_MOTIFS, search_length: int = 100) -> DataFrame:
    """Adds motifs, the motif string of the last ``search_length`` bases, and motif_filter, 1 if any was found."""
    ends = terminal_window(df.select(id_col, "chrom", "strand", "start", "end"), search_length)
    hits = motif_hits(F.upper("sequence"), motifs, search_length)
    scanned = region_sequences(ends, genome, id_col, chunk).select(id_col, motif_string(F.coalesce(hits, F.array().cast("array<struct<distance:int,motif:string>>"))).alias("motifs"))
    return df.join(scanned, id_col, "left").withColumn("motif_filter", (F.col("motifs") != "not_found").cast("int"))


def select_atlas(df: DataFrame, le_col: str = "last_exon_id") -> DataFrame:
    """The row of each last exon that is nearest to its site; the more 3' site of equals."""
    toward = F.when(on_plus(), -F.col("atlas_start")).otherwise(F.col("atlas_start"))
    rank = F.row_number().over(Window.partitionBy(le_col).orderBy(F.abs("nearest_atlas_distance"), toward, "transcript_id"))
    return df.withColumn("_n", rank).where("_n = 1").drop("_n")


def select_motif(df: DataFrame, le_col: str = "last_exon_id", expected_distance: int = 21) -> DataFrame:
    """The row of each last exon whose motif is nearest to where one is expected, with its deviation and distance."""
    best = least_deviation(parse_motif_string(F.col("motifs")), expected_distance)
    own = df.withColumns({"min_motif_deviation": best["deviation"], "min_motif_distance": best["distance"]})
    rank = F.row_number().over(Window.partitionBy(le_col).orderBy(F.col("min_motif_deviation").asc_nulls_last(), "transcript_id"))
    return own.withColumn("_n", rank).where("_n = 1").drop("_n")


def snap_to_atlas(df: DataFrame) -> DataFrame:
    """Moves each 3' end to its site; the former coordinate stays as three_end_before."""
    moved = F.col("nearest_atlas_distance") != 0
    plus, minus = moved & on_plus(), moved & ~on_plus()
    before = F.when(on_plus(), F.col("end")).otherwise(F.col("start"))
    return df.withColumns({"three_end_before": before, "end": F.when(plus, F.col("atlas_end")).otherwise(F.col("end")), "start": F.when(minus, F.col("atlas_start")).otherwise(F.col("start"))})
