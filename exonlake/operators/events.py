"""Classification of last exons as extensions of reference exons or as newly spliced."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.coords import five_end, on_plus, three_end_base
from ..store import written
from .interval import not_overlapping, overlap_join
from .structure import TX, exon_intron_tables, internal_regions, terminal_regions

REF = "_ref"
#: Columns of the reference that events carry.
REF_COLS = ("gene_id", "transcript_id", "gene_name", "start", "end")
#: Ranks of regions that are not last, in the order of their events' names.
NOT_LAST = ("first", "internal")
Tables = tuple[dict[str, DataFrame], dict[str, DataFrame]]


def _best(carry: Sequence[str]) -> list[str]:
    return [*(f"best.{c}{REF}" for c in carry), "best.extension", "best.region_rank"]


def event_name(rank: Column, kind: str) -> Column:
    """first, internal or last, followed by the kind of event."""
    return F.concat(rank, F.lit(f"_exon_{kind}"))


def within_five_end_tolerance(first_tolerance: int, other_tolerance: int, rank: str = "region_rank", suffix: str = REF, apart: Column | None = None) -> Column:
    """Whether the 5' ends of a pair, or those that are ``apart`` so far, are as near as the rank of the reference region asks."""
    apart = F.abs(five_end() - five_end("start" + suffix, "end" + suffix)) if apart is None else apart
    return apart <= F.when(F.col(rank) == "first", first_tolerance).otherwise(other_tolerance)


def three_end_matches(last_exons: DataFrame, ref_exons: DataFrame, id_col: str = TX, bin_size: int | None = None, carry: Sequence[str] = REF_COLS) -> DataFrame:
    """Of each last exon that overlaps reference exons: in_exon, whether its last base is in one, and of the one that it extends least past the 3' end ``best``.

    One overlap join serves both: of exons that share a base, those that hold the last one are those not
    extended.  best has extension (may be negative), the reference's columns of ``carry`` and region_rank;
    equal extensions go to the nearest 5' end, then the reference transcript of the smaller id.
    """
    ranked = "region_rank" in ref_exons.columns
    ref = ref_exons.select("chrom", "strand", *dict.fromkeys(("transcript_id", "start", "end", *carry)), (F.col("region_rank") if ranked else F.lit(None).cast("string")).alias("region_rank"))
    pairs = overlap_join(last_exons.select(id_col, "chrom", "strand", "start", "end"), ref, bin_size=bin_size)
    extension = F.when(on_plus(), F.col("end") - F.col("end" + REF)).otherwise(F.col("start" + REF) - F.col("start"))
    apart = F.abs(five_end() - five_end("start" + REF, "end" + REF))
    more = [c + REF for c in carry if c not in ("transcript_id", "start")]
    best = F.min(F.struct(extension.alias("extension"), apart.alias("apart"), F.col("transcript_id" + REF), F.col("start" + REF), *more, F.col("region_rank" + REF).alias("region_rank")))
    return pairs.groupBy(id_col).agg(best.alias("best")).select(id_col, (F.col("best.extension") <= 0).alias("in_exon"), "best")


def no_three_end_overlap(last_exons: DataFrame, ref_exons: DataFrame, id_col: str = TX, bin_size: int | None = None) -> DataFrame:
    """Last exons whose last base is in no reference exon."""
    ends = not_overlapping(three_end_base(last_exons.select("chrom", "strand", "start", "end", id_col)), ref_exons, id_col, bin_size=bin_size)
    return last_exons.join(ends.select(id_col).distinct(), id_col, "left_semi")


def shortest_extension(last_exons: DataFrame, ref_exons: DataFrame, id_col: str = TX, bin_size: int | None = None) -> DataFrame:
    """Each last exon's overlapping reference exon that it extends least past the 3' end: extension (may be negative), the reference's columns and region_rank."""
    return last_exons.join(three_end_matches(last_exons, ref_exons, id_col, bin_size), id_col).select(*last_exons.columns, *_best(REF_COLS))


def _reason(min_length: int, first_tolerance: int, other_tolerance: int, tolerance_filter: bool, apart: Column | None = None) -> Column:
    """Why an extension is rejected; null if it is not."""
    near = within_five_end_tolerance(first_tolerance, other_tolerance, apart=apart) if tolerance_filter else F.lit(True)
    return F.when(F.col("extension") < min_length, "length").when(~near, "five_end")


def extension_events(last_exons: DataFrame, ref_exons: DataFrame, min_length: int = 100, first_tolerance: int = 100, other_tolerance: int = 0, tolerance_filter: bool = True, id_col: str = TX, bin_size: int | None = None) -> DataFrame:
    """Last exons that extend a reference exon by a base or more, with event_type, or with reject_reason ``length`` or ``five_end``."""
    found = shortest_extension(last_exons, ref_exons, id_col, bin_size).where("extension >= 1")
    reason = _reason(min_length, first_tolerance, other_tolerance, tolerance_filter)
    return found.withColumns({"reject_reason": reason, "event_type": F.when(reason.isNull(), event_name(F.col("region_rank"), "extension"))}).drop("region_rank")


def classified_last_exons(last_exons: DataFrame, ref_exons: DataFrame, min_length: int = 100, first_tolerance: int = 100, other_tolerance: int = 0, tolerance_filter: bool = True, id_col: str = TX, bin_size: int | None = None, carry: Sequence[str] = REF_COLS) -> DataFrame:
    """Every last exon with in_exon, whether its last base is in a reference exon, and else its extension with the reference's columns of ``carry`` and reject_reason or event_type; nulls if it extends none."""
    own = last_exons.join(three_end_matches(last_exons, ref_exons, id_col, bin_size, carry), id_col, "left").withColumn("in_exon", F.coalesce("in_exon", F.lit(False)))
    extends = ~F.col("in_exon") & (F.col("best.extension") >= 1)
    flat = own.withColumn("best", F.when(extends, F.col("best"))).select(*last_exons.columns, "in_exon", *_best(carry), F.col("best.apart").alias("_apart"))
    reason = _reason(min_length, first_tolerance, other_tolerance, tolerance_filter, F.col("_apart"))
    return flat.withColumns({"reject_reason": reason, "event_type": F.when(F.col("extension").isNotNull() & reason.isNull(), event_name(F.col("region_rank"), "extension"))}).drop("region_rank", "_apart")


def spliced_events(last_introns: DataFrame, ref_introns: DataFrame, tolerance_filter: bool = True, id_col: str = TX, bin_size: int | None = None, how: str = "inner") -> DataFrame:
    """Pairs of a last intron and a reference intron that it overlaps, with the same 5' splice site if filtered; event_type by the reference's ranks.

    With how ``left``, of filtered pairs alone, last introns without a pair stay, with nulls.
    """
    if how != "inner" and not tolerance_filter:
        raise ValueError("pairs that merely overlap are joined inner")
    ref = ref_introns.select("chrom", "strand", *REF_COLS, "region_rank")
    if tolerance_filter:  # introns that begin at one base overlap, so this is an equi-join
        other = ref.select(*(F.col(c) if c in ("chrom", "strand") else F.col(c).alias(c + REF) for c in ref.columns)).withColumn("_site", five_end("start" + REF, "end" + REF))
        pairs = last_introns.withColumn("_site", five_end()).join(other, ["_site", "chrom", "strand"], how).drop("_site")
    else:
        pairs = overlap_join(last_introns, ref, bin_size=bin_size)
    return pairs.withColumn("event_type", event_name(F.col("region_rank" + REF), "spliced")).drop("region_rank" + REF)


def event_types_by_id(events: DataFrame, id_col: str = TX) -> DataFrame:
    """Each id's event types, sorted and joined by commas."""
    return events.groupBy(id_col).agg(F.array_join(F.array_sort(F.collect_set("event_type")), ",").alias("event_type"))


def novel_last_exons(novel_exons: DataFrame | None, ref_exons: DataFrame | None, min_length: int = 100, first_tolerance: int = 100, other_tolerance: int = 0, extension_filter: bool = True, spliced_filter: bool = True, exclude_five_end_failures: bool = False, bin_size: int | None = None, tables: Tables | None = None) -> DataFrame:
    """Last exons of transcripts whose 3' end is new, one row a transcript.

    Columns: transcript_id, chrom, strand, start, end, event_type and the matching reference's
    gene_id_ref, transcript_id_ref and gene_name_ref, joined by commas.  Extensions that fail the
    5' tolerance may still be found as spliced; exclude_five_end_failures keeps them out.
    """
    return novel_and_rejected(novel_exons, ref_exons, min_length, first_tolerance, other_tolerance, extension_filter, spliced_filter, exclude_five_end_failures, bin_size, tables)[0]


def novel_and_rejected(novel_exons: DataFrame | None, ref_exons: DataFrame | None, min_length: int = 100, first_tolerance: int = 100, other_tolerance: int = 0, extension_filter: bool = True, spliced_filter: bool = True, exclude_five_end_failures: bool = False, bin_size: int | None = None, tables: Tables | None = None, carry: Sequence[str] = ("gene_id", "transcript_id", "gene_name")) -> tuple[DataFrame, DataFrame]:
    """novel_last_exons, with the matching reference's columns of ``carry``, and why each other transcript was rejected; both read one table of classified last exons.

    ``tables`` are the exon_intron_tables of novel and reference, if a caller has them; the exons may be None then.
    """
    novel, ref = tables or (exon_intron_tables(novel_exons, write=True), exon_intron_tables(ref_exons, write=True))
    keep, meta = ["transcript_id", "chrom", "strand", "start", "end"], [c + REF for c in carry]
    last = written(classified_last_exons(novel["last_exons"].select(*keep), ref["exons"], min_length, first_tolerance, other_tolerance, extension_filter, bin_size=bin_size, carry=carry), "last-exons")
    gone = F.coalesce(F.col("reject_reason") == "length", F.lit(False)) if extension_filter else F.lit(False)
    if exclude_five_end_failures:
        gone = gone | F.coalesce(F.col("reject_reason") == "five_end", F.lit(False))
    sought = last.where(~F.col("in_exon") & F.col("event_type").isNull() & ~gone).select("transcript_id")
    introns = novel["last_introns"].select(*keep).join(sought, "transcript_id", "left_semi")
    spliced = spliced_events(introns, ref["introns"], spliced_filter, bin_size=bin_size)
    matches = last.where("event_type is not null").select("transcript_id", "event_type", *meta).unionByName(spliced.select("transcript_id", "event_type", *meta))
    listed = lambda c: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("transcript_id_ref", "event_type", F.coalesce(c, F.lit("NULL")).alias("v")))), lambda s: s["v"]), ",")
    joined = matches.groupBy("transcript_id").agg(F.array_join(F.array_sort(F.collect_set("event_type")), ",").alias("event_type"), *(listed(c).alias(c) for c in meta))
    found = last.select(*keep).join(joined, "transcript_id").select(*keep, "event_type", *meta)
    reason = F.when(F.col("in_exon"), "three_end_in_exon").otherwise(F.coalesce("reject_reason", F.lit("no_five_site_match")))
    rejected = last.join(joined.select("transcript_id"), "transcript_id", "left_anti").select("transcript_id", reason.alias("reason"))
    return found, rejected


def rejections(novel_exons: DataFrame | None, ref_exons: DataFrame | None, *args, **options) -> DataFrame:
    """Why each transcript that has no event was rejected."""
    return novel_and_rejected(novel_exons, ref_exons, *args, **options, carry=())[1]


def not_last_regions(regions: DataFrame, id_col: str = TX) -> DataFrame:
    """First and internal regions; a sole one counts as first.  Ranks say which they are, where regions have them."""
    if "region_rank" in regions.columns:
        return regions.where("region_rank <> 'last'")
    return terminal_regions(regions, "first", id_col).unionByName(internal_regions(regions, id_col))


def reference_event_types(ref_exons: DataFrame | None, extension_string: str | None = None, bin_size: int | None = None, tables: dict[str, DataFrame] | None = None) -> DataFrame:
    """transcript_id and event_type of the reference's own last exons; ``tables`` are its exon_intron_tables, if a caller has them.

    Only last exons whose 3' end is in no first or internal exon have one; those of transcripts
    whose id contains extension_string are last_exon_extension.
    """
    return typed_last_exons(ref_exons, (), extension_string, bin_size, tables)


def typed_last_exons(ref_exons: DataFrame | None, more: Sequence[str], extension_string: str | None = None, bin_size: int | None = None, tables: dict[str, DataFrame] | None = None, free: bool = False) -> DataFrame:
    """reference_event_types with the columns ``more`` of the last exons, which classified rows keep, so that nothing is joined to get them back.

    With free, also the column ``free``: whether a last exon shares no base with a first or internal exon.
    """
    own, keep = tables or exon_intron_tables(ref_exons, write=True), [*dict.fromkeys(["transcript_id", "chrom", "strand", *more])]
    exons, gaps = not_last_regions(own["exons"]), not_last_regions(own["introns"])
    ends = own["last_sites"].select(*dict.fromkeys([*keep, "start", "end", "site"]))
    last = written(classified_last_exons(ends, exons, 1, 0, 0, tolerance_filter=False, bin_size=bin_size, carry=()).where("not in_exon").select(*keep, "site", "event_type", (F.col("extension").isNull() & (F.col("start") < F.col("end"))).alias("free")), "last-exons")
    at = gaps.groupBy(five_end().alias("site"), "chrom", "strand").agg(*(F.max(F.col("region_rank") == rank).alias(f"_{rank}") for rank in NOT_LAST))
    types = F.concat_ws(",", *(F.when(F.col(f"_{rank}"), event_name(F.lit(rank), "spliced")) for rank in NOT_LAST))
    left = last.where("event_type is null and site is not null").drop("event_type").join(at, ["site", "chrom", "strand"], "left")
    spliced = left.withColumn("event_type", F.coalesce(F.nullif(types, F.lit("")), F.lit("last_exon_spliced")))
    out = last.where("event_type is not null").unionByName(spliced.select(*last.columns)).select("transcript_id", *more, "event_type", *(["free"] if free else []))
    return forced_extensions(out, extension_string) if extension_string else out


def forced_extensions(events: DataFrame, text: str, id_col: str = TX) -> DataFrame:
    """event_type becomes last_exon_extension where the id contains the text; an error if none does."""
    if events.where(F.col(id_col).contains(text)).isEmpty():
        raise ValueError(f"no {id_col} contains {text!r}")
    return events.withColumn("event_type", F.when(F.col(id_col).contains(text), "last_exon_extension").otherwise(F.col("event_type")))
