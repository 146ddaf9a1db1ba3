"""Sources and sinks of genomic tables. Coordinates are 0-based and half-open inside; GTF text is 1-based and closed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: The nine fields of a GTF line.
GTF_FIELDS = ("chrom", "source", "feature", "start", "end", "score", "strand", "frame", "attributes")
MAX_MOTIFS = 10_000
BED_FIELDS = ("chrom", "start", "end", "name", "score", "strand")


def attribute(text: Column, key: str) -> Column:
    """The quoted value of one attribute, null if it has none; a key never matches the end of a longer one."""
    return F.nullif(F.regexp_extract(text, rf'(?:^|;\s*){key} "([^"]*)"', 1), F.lit(""))


def attribute_list(text: Column, key: str) -> Column:
    """All values of an attribute that repeats, joined by commas."""
    values = F.regexp_extract_all(text, F.lit(rf'(?:^|;\s*){key} "([^"]*)"'), 1)
    return F.when(F.size(values) > 0, F.array_join(values, ","))


def attribute_map(text: Column) -> Column:
    """All attributes as a map; values of a repeated key are joined by commas."""
    keys = F.regexp_extract_all(text, F.lit(r'([^\s;"]+) "([^"]*)"'), 1)
    values = F.regexp_extract_all(text, F.lit(r'([^\s;"]+) "([^"]*)"'), 2)
    pairs = F.arrays_zip(keys.alias("k"), values.alias("v"))
    own = lambda k: F.array_join(F.transform(F.filter(pairs, lambda p: p["k"] == k), lambda p: p["v"]), ",")
    return F.map_from_entries(F.transform(F.array_distinct(keys), lambda k: F.struct(k, own(k))))


def gtf_table(lines: DataFrame, attributes: Sequence[str] | None = None, repeated: Sequence[str] = ()) -> DataFrame:
    """The table of GTF lines (column value): all attributes as a map, or the named ones as columns."""
    parts = F.split("value", "\t")
    rows = lines.where(~F.col("value").startswith("#") & (F.size(parts) >= 9)).select(*(parts[k].alias(c) for k, c in enumerate(GTF_FIELDS)))
    rows = rows.withColumns({"start": F.col("start").cast("long") - 1, "end": F.col("end").cast("long")})
    if attributes is None:
        return rows.withColumn("attributes", attribute_map(F.col("attributes")))
    own = {k: attribute_list(F.col("attributes"), k) if k in repeated else attribute(F.col("attributes"), k) for k in attributes}
    if "exon_number" in own:
        own["exon_number"] = own["exon_number"].cast("double").cast("int")
    return rows.select("chrom", "source", "feature", "start", "end", "score", "strand", "frame", *(v.alias(k) for k, v in own.items()))


def read_gtf(spark: SparkSession, path: str | Sequence[str], attributes: Sequence[str] | None = None, repeated: Sequence[str] = (), feature: str | None = None) -> DataFrame:
    table = gtf_table(spark.read.text(path), attributes, repeated)
    return table.where(F.col("feature") == feature) if feature else table


def read_many_gtf(spark: SparkSession, paths: Sequence[str], suffix: str, origin: str = "sample_id", attributes: Sequence[str] = ("gene_id", "transcript_id")) -> DataFrame:
    """Several files as one table, each row with its file's name less the suffix."""
    lines = spark.read.text(list(paths)).select("value", F.col("_metadata.file_name").alias("_f"))
    name = F.when(F.col("_f").endswith(suffix), F.expr(f"substring(_f, 1, length(_f) - {len(suffix)})")).otherwise(F.col("_f"))
    parts = lines.withColumn(origin, name)
    line = F.split("value", "\t")
    rows = parts.where(~F.col("value").startswith("#") & (F.size(line) >= 9)).select(origin, *(line[k].alias(c) for k, c in enumerate(GTF_FIELDS)))
    return rows.select(origin, "chrom", "source", "feature", (F.col("start").cast("long") - 1).alias("start"), F.col("end").cast("long").alias("end"), "score", "strand", "frame", *(attribute(F.col("attributes"), k).alias(k) for k in attributes))


def gtf_lines(df: DataFrame, attributes: Sequence[str], source: str = "exonlake", feature: str = "exon") -> DataFrame:
    """One column value with a GTF line a row; attributes that are null are left out."""
    have = set(df.columns)
    field = lambda c, default: F.coalesce(F.col(c).cast("string"), F.lit(default)) if c in have else F.lit(default)
    attrs = F.concat_ws(" ", *(F.when(F.col(a).isNotNull(), F.concat(F.lit(f'{a} "'), F.col(a).cast("string"), F.lit('";'))) for a in attributes))
    return df.select(F.concat_ws("\t", "chrom", field("source", source), field("feature", feature), (F.col("start") + 1).cast("string"), F.col("end").cast("string"), field("score", "."), "strand", field("frame", "."), attrs).alias("value"))


def write_gtf(df: DataFrame, path: str, attributes: Sequence[str], **fields: str) -> None:
    gtf_lines(df, attributes, **fields).write.text(path)


def read_bed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, sep="\t", schema="chrom string, start long, end long, name string, score string, strand string", comment="#")


def point_features(bed: DataFrame, add_chr: bool = False, standard_bed6: bool = False, label: str = "CPAS") -> DataFrame:
    """chrom, coordinate, strand and label of sites; the coordinate is in the name chr:coordinate:strand, or start + 1."""
    at = F.col("start") + 1 if standard_bed6 else F.split("name", ":")[1].cast("long")
    chrom = F.concat(F.lit("chr"), "chrom") if add_chr else F.col("chrom")
    return bed.select(chrom.alias("chrom"), at.alias("coordinate"), "strand", F.lit(label).alias("label"))


def read_motifs(spark: SparkSession, path: str) -> list[str]:
    """A motif a line; the list is read on the driver, so more than MAX_MOTIFS are an error."""
    rows = spark.read.text(path).select(F.upper(F.trim("value")).alias("value")).where("value <> ''").limit(MAX_MOTIFS + 1).collect()
    if len(rows) > MAX_MOTIFS:
        raise ValueError(f"more than {MAX_MOTIFS} motifs")
    return [r["value"] for r in rows]


def write_table(df: DataFrame, path: str) -> None:
    """Tab-separated with a header; nulls read NA."""
    df.write.csv(path, sep="\t", header=True, nullValue="NA")


def read_table(spark: SparkSession, path: str | Sequence[str], schema: str | None = None) -> DataFrame:
    """A tab-separated table with a header; NA is null."""
    return spark.read.csv(path, sep="\t", header=True, nullValue="NA", schema=schema)


def folder_before(name: str) -> Column:
    """The folder that holds the file, or the folder of part files, of this name that a row is from."""
    return F.element_at(F.split(F.substring_index(F.col("_metadata.file_path"), f"/{name}", 1), "/"), -1)


def read_experiments(spark: SparkSession, folder: str, name: str, schema: str | None = None) -> DataFrame:
    """The table of this name in every experiment's folder, each row with its experiment_id."""
    rows = spark.read.csv(f"{folder}/*/{name}", sep="\t", header=True, nullValue="NA", schema=schema)
    return rows.withColumn("experiment_id", folder_before(name))
