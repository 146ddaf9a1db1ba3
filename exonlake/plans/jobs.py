"""The composed jobs: DataFrames in, DataFrames out; what a job reads several times is written once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions.coords import KEYS, stranded, with_length
from ..functions.motif import GRUBER_MOTIFS
from ..functions.stats import benjamini_hochberg, gene_q_values
from ..operators import collapse, events, last_exons as le, structure, three_ends, usage
from ..operators.filters import all_of, annotation_rules, by_group
from ..operators.interval import BIN, cluster, subtract
from ..store import written


def filter_annotation(gtf: DataFrame, groups: Sequence[str] = (), group_col: str = "gene_type", more: dict | None = None, **options) -> DataFrame:
    """Reference annotation filter: all rules of the options, and, if groups are listed, those of each group."""
    out = gtf.where(all_of(annotation_rules(**options)))
    return out.where(by_group(group_col, groups, more or {})) if groups else out


def novel_last_exons(novel: DataFrame, reference: DataFrame, **options) -> DataFrame:
    """Novel last exons of exon tables."""
    return events.novel_last_exons(stranded(novel), stranded(reference), **options)


def combine_last_exons(tables: Sequence[DataFrame], with_ids: bool = True, bin_size: int = BIN) -> DataFrame:
    """All tables' rows, with the last_exon_id of the cluster of overlapping rows they are in."""
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    if not with_ids:
        return out
    return cluster(out, KEYS, "_island", bin_size).withColumn("last_exon_id", F.concat_ws(":", "chrom", "strand", "_island")).drop("_island")


def filter_three_ends(df: DataFrame, atlas: DataFrame, genome: DataFrame, chunk: int, max_distance: int = 100, motifs: Sequence[str] = GRUBER_MOTIFS, search_length: int = 100, expected_distance: int = 21, bin_size: int = BIN) -> dict[str, DataFrame]:
    """Rows (transcript_id, last_exon_id, chrom, strand, start, end, event_type) with evidence for their 3' end.

    passed: one row of each last exon near an atlas site, snapped to it, and one of each with only a
    motif; match_stats: every row's evidence and match_class; classes: transcripts of each class.
    """
    near = written(three_ends.nearest_atlas_site(written(df, "last-exons"), atlas, max_distance, bin_size), "nearest")
    stats = three_ends.terminal_motifs(near, genome, "transcript_id", chunk, motifs, search_length)
    stats = stats.withColumn("match_class", F.when((F.col("atlas_filter") == 1) | (F.coalesce("motif_filter", F.lit(0)) == 1), "valid").otherwise("not_valid"))
    stats = written(stats, "three-ends")
    by_site = three_ends.snap_to_atlas(three_ends.select_atlas(stats.where("atlas_filter = 1"))).withColumn("evidence", F.lit("atlas"))
    by_motif = three_ends.select_motif(stats.where("atlas_filter = 0 and motif_filter = 1"), expected_distance=expected_distance).withColumn("evidence", F.lit("motif"))
    return {"passed": by_site.unionByName(by_motif, allowMissingColumns=True), "match_stats": stats, "classes": collapse.value_counts(stats, ["match_class", "atlas_filter", "motif_filter"], "transcript_id")}


def combined_annotation(novel: DataFrame | None, ref_exons: DataFrame | None, novel_prefix: str = "novel", extension_string: str | None = None, bin_size: int | None = None, tables: dict[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    """The quantification annotation of novel and reference last exons.

    novel: transcript_id, chrom, strand, start, end, event_type, gene_id_ref, gene_name_ref.
    Gives last_exons, unique (less the bases of first and internal reference exons), dropped ids,
    the four id maps and info.  ``tables`` are the exon_intron_tables of the reference, if a caller has them.
    """
    own = tables or structure.exon_intron_tables(ref_exons, write=True)
    typed = events.typed_last_exons(ref_exons, ("chrom", "strand", "start", "end", "gene_id", "gene_name"), extension_string, bin_size, own, free=True)
    ref = typed.withColumnsRenamed({"gene_id": "ref_gene_id", "gene_name": "ref_gene_name"})
    cols = ["transcript_id", "chrom", "strand", "start", "end", "event_type", "ref_gene_id", "ref_gene_name", "free"]
    ref = ref.select(*cols)
    if novel is not None:
        new = novel.withColumns({"ref_gene_id": F.col("gene_id_ref"), "ref_gene_name": F.array_join(F.array_distinct(F.split("gene_name_ref", ",")), ","), "free": F.lit(False)}).select(*cols)
        new, ref = le.metagenes(new, ref)
        ref = new.unionByName(ref)
    ids = written(le.with_le_ids(ref), "last-exon-ids")  # read by all that follows
    inner = events.not_last_regions(own["exons"]).select("chrom", "strand", "start", "end")
    rows, free = ids.drop("free"), ids.where("free").drop("free")
    cut = subtract(ids.where("not free").drop("free"), inner, "transcript_id", bin_size=bin_size)  # the others are known to share no base with inner
    unique = written(free.unionByName(cut), "unique-regions")
    dropped = rows.select("transcript_id").distinct().join(unique.select("transcript_id"), "transcript_id", "left_anti")
    return {"last_exons": rows, "unique": unique, "dropped": dropped, "info": le.info_table(unique, novel_prefix), **le.id_maps(unique)}


def reference_annotation(ref_exons: DataFrame | None, extension_string: str | None = None, bin_size: int | None = None, tables: dict[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    """The same from the reference alone."""
    return combined_annotation(None, ref_exons, "novel", extension_string, bin_size, tables)


def usage_matrices(quant: DataFrame, tx2le: DataFrame, le2gene: DataFrame, samples: DataFrame, base: str, treatment: str) -> dict[str, DataFrame]:
    """counts, tpm, ppau (with condition means and delta) and gene totals with their means and medians."""
    known = le2gene.join(usage.last_exon_abundance(quant, tx2le), "le_id")
    ppau = usage.usage_shares(known.select("le_id", "gene_id", "sample", "tpm"))
    genes = usage.gene_totals(known)
    return {
        "counts": known.select("le_id", "gene_id", "sample", "count"), "tpm": known.select("le_id", "gene_id", "sample", "tpm"), "ppau": ppau,
        "means": usage.condition_means(ppau, samples, base, treatment), "gene_tpm": genes, "gene_tpm_by_condition": usage.by_condition(genes, samples, ["gene_id"], "tpm"),
    }


def differential_input(counts: DataFrame, samples: DataFrame, min_mean_count: float = 10, min_relative_usage: float = 0.05) -> DataFrame:
    """Counts of last exons that are expressed and used enough, of genes that have several left."""
    return usage.several_isoforms(usage.min_relative_usage(usage.min_mean_count(counts, samples, min_mean_count), samples, min_relative_usage))


def adjusted_results(pvalues: DataFrame, gene: str = "gene_id") -> DataFrame:
    """P-values with padj and the q-value of their gene."""
    return benjamini_hochberg(pvalues).join(gene_q_values(pvalues, gene), gene, "left")


def annotated_results(results: DataFrame, info: DataFrame, means: DataFrame) -> DataFrame:
    """Results with each last exon's info and usage, in order of gene q-value, gene and last exon."""
    out = results.join(le.info_by_le(info).drop("gene_id"), "le_id", "left").join(means.drop("gene_id"), "le_id", "left")
    return out.orderBy("gene_q", "gene_id", "le_id")


def merge_experiments(rows: DataFrame, min_delta: float | None = None, bin_size: int = BIN) -> dict[str, DataFrame]:
    """Last exons of several experiments (experiment_id, event_type, delta and intervals) as clusters.

    Gives rows with cluster, experiment_count and multiple_datasets, the merged intervals and
    summaries of counts, combinations and event types.
    """
    kept = with_length(rows.where("delta is not null"))
    if min_delta is not None:
        kept = kept.where(F.abs("delta") >= min_delta)
    found = cluster(written(kept, "kept"), KEYS, "_island", bin_size)
    named = written(found.withColumn("cluster", F.concat_ws(":", "chrom", "strand", "_island")).drop("_island"), "clusters")
    per = named.groupBy("cluster").agg(F.count_distinct("experiment_id").alias("experiment_count"), F.array_join(F.array_sort(F.collect_set("experiment_id")), ",").alias("experiments"))
    named = named.join(per, "cluster").withColumn("multiple_datasets", F.col("experiment_count") > 1)
    merged = named.groupBy("cluster", "chrom", "strand").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.max("experiment_count").alias("experiment_count"))
    return {
        "rows": named, "merged": merged, "count_summary": collapse.describe(per, "experiment_count"), "combinations": collapse.value_counts(per, ["experiments"]),
        "event_shares": collapse.value_shares(named, ["multiple_datasets"], "event_type"),
    }


def match_across_samples(exons: DataFrame, bin_size: int = BIN) -> DataFrame:
    """sample, transcript_id and merged_id: transcripts of one intron chain are one, single exons are one where they overlap."""
    own = ["sample", "transcript_id"]
    found = written(structure.shapes(exons, own[::-1]), "shapes")  # what tells most rows apart leads
    many = found.where("intron_chain is not null").select(*own, F.concat_ws(":", "chrom", "strand", "intron_chain").alias("merged_id"))
    single = found.where("intron_chain is null").drop("intron_chain")
    one = cluster(single, KEYS, "_island", bin_size).select(*own, F.concat_ws(":", "chrom", "strand", "_island").alias("merged_id"))
    return many.unionByName(one)


MODES = ("identify", "provided", "precomputed")


def id_maps_for(mode: str, identified: dict[str, DataFrame] | None = None, provided: dict[str, DataFrame] | None = None, precomputed: dict[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    """The id maps that quantification takes in a run mode."""
    if mode not in MODES:
        raise ValueError(f"mode is one of {MODES}, not {mode!r}")
    maps = {"identify": identified, "provided": provided, "precomputed": precomputed}[mode]
    if maps is None:
        raise ValueError(f"mode {mode} needs its id maps")
    return maps


