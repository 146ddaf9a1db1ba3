"""Last-exon identifiers: clusters per gene, 5' to 3' numbers, extensions, metagenes and id maps."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.coords import on_plus
from ..store import written
from .collapse import collapse_metadata
from .interval import BIN, number_islands

GENE = ("chrom", "strand", "ref_gene_id")
#: Last exons of a gene, or numbers of them, that one window goes over; larger genes go by bins.
NUMBERS = 4096


def is_novel(prefix: str, col: str) -> Column:
    return F.coalesce(F.col(col).contains(prefix), F.lit(False))


def common_gene(df: DataFrame, novel_prefix: str = "novel") -> DataFrame:
    """ref_gene_id and ref_gene_name: those of the matched reference for novel genes, else the row's own."""
    novel = is_novel(novel_prefix, "gene_id")
    return df.withColumns({"ref_gene_id": F.when(novel, F.col("gene_id_ref")).otherwise(F.col("gene_id")), "ref_gene_name": F.when(novel, F.col("gene_name_ref")).otherwise(F.col("gene_name"))})


def annotation_status(novel_prefix: str = "novel", col: str = "transcript_id") -> Column:
    return F.when(is_novel(novel_prefix, col), "novel").otherwise("annotated")


def number_last_exons(df: DataFrame, bin_size: int = BIN) -> DataFrame:
    """Adds le_number, the place 5' to 3' of each row's cluster of overlapping last exons in its gene; rows without a gene are a gene."""
    return number_islands(df, GENE, "le_number", ~on_plus(), bin_size)


def renumber_extensions(df: DataFrame, key: str = "last_exon_extension") -> DataFrame:
    """Rows whose event is a last-exon extension become a last exon of their own behind theirs; later numbers move on.

    In closed form: number + extended numbers before it + 1 if the row is an extension.  Extended
    numbers are themselves numbered, in bins of them, and a row's shift is that of the next one.
    """
    extends = F.coalesce(F.col("event_type").contains(key), F.lit(False)).cast("int")
    flagged = df.withColumn("_ext", extends)
    numbers = flagged.groupBy(*GENE, "le_number").agg(F.max("_ext").alias("_any"))
    block = F.floor(F.col("le_number") / NUMBERS)
    within = Window.partitionBy(*reversed(GENE), "_block").orderBy("le_number").rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy(*reversed(GENE)).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    numbers = numbers.withColumn("_block", block)
    blocks = numbers.groupBy(*GENE, "_block").agg(F.sum("_any").alias("_sum"))
    blocks = blocks.select(*(F.col(c).alias(f"_b_{c}") for c in (*GENE, "_block")), F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_before"))
    local = numbers.withColumn("_in", F.coalesce(F.sum("_any").over(within), F.lit(0)))
    shifts = local.join(blocks, _same("_b_", (*GENE, "_block"))).select(*(F.col(c).alias(f"_s_{c}") for c in (*GENE, "le_number")), (F.col("_before") + F.col("_in")).alias("_shift"))
    moved = flagged.join(shifts, _same("_s_", (*GENE, "le_number"))).select(*flagged.columns, "_shift")
    return moved.withColumn("le_number", (F.col("le_number") + F.col("_shift") + F.col("_ext")).cast("int")).drop("_ext", "_shift")


def _same(prefix: str, cols: Sequence[str]) -> Column:
    """Equal values, the last column first, as joins sort by them in order and few chromosomes tell hardly any rows apart."""
    return reduce(and_, (F.col(c).eqNullSafe(F.col(prefix + c)) for c in reversed(cols)))


def le_id() -> Column:
    return F.concat_ws("_", "ref_gene_id", "le_number")


def with_le_ids(df: DataFrame, extensions: bool = True, bin_size: int = BIN) -> DataFrame:
    """Adds le_number and le_id; df is written first, as numbering reads it several times.

    Genes of few rows are numbered by windows over one shuffle; those of more than NUMBERS rows, and
    the rows without a gene if they are so many, by bins.
    """
    rows = written(df, "last-exons")
    large = rows.groupBy(*GENE).agg(F.count("*").alias("_n")).where(F.col("_n") > NUMBERS).select(*(F.col(c).alias(f"_g_{c}") for c in GENE))
    large = written(large, "large-genes")
    if large.isEmpty():
        return _number_small_genes(rows, extensions).withColumn("le_id", le_id())
    binned = number_last_exons(written(rows.join(large, _same("_g_", GENE), "left_semi"), "large"), bin_size)
    binned = renumber_extensions(written(binned, "numbered")) if extensions else binned
    rest = _number_small_genes(rows.join(large, _same("_g_", GENE), "left_anti"), extensions)
    return rest.unionByName(binned).withColumn("le_id", le_id())


def _number_small_genes(df: DataFrame, extensions: bool, key: str = "last_exon_extension") -> DataFrame:
    """number_last_exons, and renumber_extensions if so, by windows over whole genes.

    All windows run 5' to 3' over one sort, so that numbers and extended ones are counted as they are met.
    """
    edge = Window.unboundedPreceding
    along = Window.partitionBy(*reversed(GENE)).orderBy("_fs", "_fe")
    before, upto = along.rowsBetween(edge, -1), along.rowsBetween(edge, 0)
    own = df.withColumns({"_fs": F.when(on_plus(), F.col("start")).otherwise(-F.col("end")), "_fe": F.when(on_plus(), F.col("end")).otherwise(-F.col("start"))})
    own = own.withColumn("_reach", F.max("_fe").over(before))
    own = own.withColumn("_k", F.sum((F.col("_reach").isNull() | (F.col("_fs") > F.col("_reach"))).cast("int")).over(upto))
    number = F.col("_k")
    if extensions:
        own = own.withColumn("_ext", F.coalesce(F.col("event_type").contains(key), F.lit(False)).cast("int"))
        own = own.withColumn("_seen", F.coalesce(F.max(F.when(F.col("_ext") == 1, F.col("_k"))).over(before), F.lit(0)))  # the last island before that is known to be extended
        known = F.col("_seen") == F.col("_k")
        own = own.withColumn("_all", F.sum(F.when(known, 0).otherwise(F.col("_ext"))).over(upto))
        number = number + F.col("_all") - F.when(known, 1).otherwise(F.col("_ext")) + F.col("_ext")
    return own.withColumn("le_number", number.cast("int")).select(*df.columns, "le_number")


def metagenes(novel: DataFrame, reference: DataFrame, order: Sequence[str] = ("chrom", "strand", "start", "end", "transcript_id")) -> tuple[DataFrame, DataFrame]:
    """Both tables with ref_gene_id renamed where a novel last exon matches several genes.

    The genes of such a row, distinct and in order, name a combined gene, which their reference
    rows take too; a gene in several combinations takes the last one by the given order, of the
    columns that novel has.  Links are not followed further.
    """
    genes = F.array_distinct(F.split("ref_gene_id", ","))
    named = novel.withColumns({"ref_gene_id": F.array_join(genes, ","), "_genes": genes})
    place = F.struct(*(c for c in order if c in novel.columns), F.col("ref_gene_id").alias("_g"))
    each = named.where(F.size("_genes") > 1).select(F.explode("_genes").alias("_gene"), F.col("ref_gene_id").alias("_combo"), place.alias("_at"))
    combos = each.groupBy(F.col("_gene").alias("ref_gene_id")).agg(F.max_by("_combo", "_at").alias("_combo"))
    renamed = reference.join(combos, "ref_gene_id", "left").withColumn("ref_gene_id", F.coalesce("_combo", "ref_gene_id")).select(*reference.columns)
    return named.select(*novel.columns), renamed


def genes_with_choice(df: DataFrame, count: str = "rows") -> DataFrame:
    """Rows of genes that have several rows (or several last exons, with count ``le``)."""
    many = F.count("*") if count == "rows" else F.count_distinct("le_id")
    genes = df.groupBy(*GENE).agg(many.alias("_n")).where("_n > 1").select(*(F.col(c).alias(f"_g_{c}") for c in GENE))
    return df.join(genes, _same("_g_", GENE), "left_semi")


def id_maps(df: DataFrame) -> dict[str, DataFrame]:
    """tx2le, tx2gene, le2gene and le2genename, of genes with several rows."""
    rows = genes_with_choice(df)
    return {
        "tx2le": rows.select("transcript_id", "le_id").distinct(),
        "tx2gene": rows.select("transcript_id", F.col("ref_gene_id").alias("gene_id")).distinct(),
        "le2gene": rows.select("le_id", F.col("ref_gene_id").alias("gene_id")).distinct(),
        "le2genename": rows.select("le_id", F.col("ref_gene_name").alias("gene_name")).distinct(),
    }


def id_map_rows(df: DataFrame) -> DataFrame:
    """All rows of the id_maps with the name of their map: map, a and b; for callers of all maps, as genes are looked up once."""
    maps = {"tx2le": ("transcript_id", "le_id"), "tx2gene": ("transcript_id", "ref_gene_id"), "le2gene": ("le_id", "ref_gene_id"), "le2genename": ("le_id", "ref_gene_name")}
    each = F.array(*(F.struct(F.lit(name).alias("map"), F.col(a).alias("a"), F.col(b).alias("b")) for name, (a, b) in maps.items()))
    return genes_with_choice(df).select(F.inline(each)).distinct()


def info_table(df: DataFrame, novel_prefix: str = "novel") -> DataFrame:
    """One row a transcript and last exon of genes with several rows, with place, event and annotation status."""
    rows = genes_with_choice(df)
    return rows.select("transcript_id", "le_id", F.col("ref_gene_id").alias("gene_id"), F.col("ref_gene_name").alias("gene_name"), "event_type", "chrom", "start", "end", "strand", annotation_status(novel_prefix).alias("annot_status")).distinct()


def info_by_le(info: DataFrame) -> DataFrame:
    """The info table with one row a last exon, distinct values joined in order of place."""
    cols = ["gene_id", "gene_name", "event_type", "annot_status", "transcript_id", "chrom", "strand", "start", "end"]
    return collapse_metadata(info.withColumnsRenamed({"start": "_s", "end": "_e"}).withColumns({"start": F.col("_s"), "end": F.col("_e")}), "le_id", ["_s", "_e"], distinct_values=cols)
