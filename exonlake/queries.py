"""Queries for the operators over tables derived from the star schema, and SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import adapters as ad
from .functions.coords import stranded, terminal_window
from .functions.motif import GRUBER_MOTIFS, least_deviation, motif_hits, motif_string, parse_motif_string, reverse_complement
from .functions.stats import benjamini_hochberg, gene_q_values
from .operators import collapse, events, filters, interval, last_exons as le, structure, three_ends, usage
from .operators.merge import merge_columns
from .plans import jobs
from .sources import fasta, fasta_source, genomic, samples as sheets
from .store import fresh_path, written

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

_EXONS = """
raw AS (SELECT DISTINCT l_orderkey AS tx, l_orderkey // 32 AS g, (l_orderkey // 32) * 10000 + (l_partkey % 40) * 200 AS b, 60 + (CAST(l_quantity AS BIGINT) % 3) * 40 AS n, CASE WHEN l_suppkey % 5 = 0 THEN 10 ELSE 0 END AS j FROM lineitem),
iv AS (SELECT DISTINCT tx, g, CASE WHEN g % 2 = 0 THEN b + j ELSE b + 150 - n END AS s, CASE WHEN g % 2 = 0 THEN b + n ELSE b + 150 - j END AS e FROM raw),
isl AS (SELECT *, CASE WHEN s > max(e) OVER (PARTITION BY tx ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 1 ELSE 0 END AS o FROM iv),
grp AS (SELECT *, sum(o) OVER (PARTITION BY tx ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS k FROM isl),
exons AS (SELECT 'tx' || tx AS transcript_id, 'g' || g AS gene_id, 'n' || g AS gene_name, 'chr' || (g % 5) AS chrom, CASE WHEN g % 2 = 0 THEN '+' ELSE '-' END AS strand, min(s) AS s, max(e) AS e, tx % 4 = 0 AS novel FROM grp GROUP BY tx, g, k),
numbered AS (SELECT *, rank() OVER (PARTITION BY transcript_id ORDER BY CASE WHEN strand = '+' THEN s ELSE -s END) AS num, count(*) OVER (PARTITION BY transcript_id) AS cnt FROM exons),
ranked AS (SELECT *, CASE WHEN num = 1 THEN 'first' WHEN num = cnt THEN 'last' ELSE 'internal' END AS rnk FROM numbered),
introns0 AS (SELECT transcript_id, gene_id, gene_name, chrom, strand, novel, lag(e) OVER (PARTITION BY transcript_id ORDER BY s) AS s, s AS e FROM exons),
introns1 AS (SELECT *, rank() OVER (PARTITION BY transcript_id ORDER BY CASE WHEN strand = '+' THEN s ELSE -s END) AS num, count(*) OVER (PARTITION BY transcript_id) AS cnt FROM introns0 WHERE s IS NOT NULL),
introns AS (SELECT *, CASE WHEN num = 1 THEN 'first' WHEN num = cnt THEN 'last' ELSE 'internal' END AS rnk FROM introns1),
ends AS (SELECT *, CASE WHEN strand = '+' THEN e - 1 ELSE s END AS te FROM ranked WHERE num = cnt)"""
#: Novel last exons whose 3' end is free, their shortest extensions and their events.
_EVENTS = _EXONS + """,
free AS (SELECT * FROM ends n WHERE novel AND NOT EXISTS (SELECT 1 FROM exons r WHERE NOT r.novel AND r.chrom = n.chrom AND r.strand = n.strand AND r.s <= n.te AND r.e > n.te)),
ext0 AS (SELECT n.*, r.gene_id AS gene_id_ref, r.transcript_id AS transcript_id_ref, r.gene_name AS gene_name_ref, r.rnk AS ref_rank, CASE WHEN n.strand = '+' THEN n.e - r.e ELSE r.s - n.s END AS ext, CASE WHEN n.strand = '+' THEN abs(n.s - r.s) ELSE abs(n.e - r.e) END AS five, r.s AS rs
  FROM free n JOIN ranked r ON NOT r.novel AND r.chrom = n.chrom AND r.strand = n.strand AND n.s < r.e AND r.s < n.e),
ext1 AS (SELECT *, row_number() OVER (PARTITION BY transcript_id ORDER BY ext, five, transcript_id_ref, rs) AS rn FROM ext0),
ext AS (SELECT *, CASE WHEN ext < 50 THEN 'length' WHEN five > 0 THEN 'five_end' END AS reason FROM ext1 WHERE rn = 1 AND ext >= 1),
li AS (SELECT * FROM introns i WHERE novel AND num = cnt AND transcript_id IN (SELECT transcript_id FROM free) AND transcript_id NOT IN (SELECT transcript_id FROM ext WHERE reason IS NULL OR reason = 'length')),
spl AS (SELECT i.transcript_id, r.rnk || '_exon_spliced' AS event_type, r.gene_id AS gene_id_ref, r.transcript_id AS transcript_id_ref, r.gene_name AS gene_name_ref FROM li i JOIN introns r ON NOT r.novel AND r.chrom = i.chrom AND r.strand = i.strand AND CASE WHEN i.strand = '+' THEN i.s = r.s ELSE i.e = r.e END),
matched AS (SELECT transcript_id, ref_rank || '_exon_extension' AS event_type, gene_id_ref, transcript_id_ref, gene_name_ref FROM ext WHERE reason IS NULL UNION ALL SELECT * FROM spl),
novel_le AS (SELECT f.transcript_id, f.chrom, f.strand, f.s, f.e, m.event_type, m.gene_id_ref, m.transcript_id_ref, m.gene_name_ref FROM free f JOIN (
  SELECT transcript_id, array_to_string(list_sort(list(DISTINCT event_type)), ',') AS event_type, string_agg(gene_id_ref, ',' ORDER BY transcript_id_ref, event_type) AS gene_id_ref, string_agg(transcript_id_ref, ',' ORDER BY transcript_id_ref, event_type) AS transcript_id_ref, string_agg(gene_name_ref, ',' ORDER BY transcript_id_ref, event_type) AS gene_name_ref
  FROM matched GROUP BY transcript_id) m USING (transcript_id))"""


def query(sql: str | None = None):
    def put(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return put


def _renamed(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({"start": "s", "end": "e"})


def _last_and_ref(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Novel last exons and ranked reference exons."""
    novel, ref = ad.side_tables(spark, sf_dir)
    return novel["last_exons"].select("transcript_id", "chrom", "strand", "start", "end"), ref["exons"]


_OPTIONS = {"min_length": 50, "first_tolerance": 0, "other_tolerance": 0}


@query(f"WITH {_EVENTS} SELECT * FROM novel_le")
def novel_last_exons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _renamed(events.novel_last_exons(None, None, tables=ad.side_tables(spark, sf_dir), **_OPTIONS))


@query(f"""WITH {_EVENTS} SELECT n.transcript_id, CASE WHEN f.transcript_id IS NULL THEN 'three_end_in_exon' ELSE coalesce(x.reason, 'no_five_site_match') END AS reason
FROM ends n LEFT JOIN free f USING (transcript_id) LEFT JOIN ext x USING (transcript_id) WHERE n.novel AND n.transcript_id NOT IN (SELECT transcript_id FROM novel_le)""")
def rejected_last_exons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.rejections(None, None, tables=ad.side_tables(spark, sf_dir), **_OPTIONS)


@query(f"WITH {_EXONS} SELECT n.transcript_id, count(*) AS n_pairs, CAST(sum(least(n.e, r.e) - greatest(n.s, r.s)) AS BIGINT) AS bases FROM exons n JOIN exons r ON n.novel AND NOT r.novel AND n.chrom = r.chrom AND n.strand = r.strand AND n.s < r.e AND r.s < n.e GROUP BY n.transcript_id")
def overlap_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = interval.overlap_join(*ad.sides(spark, sf_dir))
    shared = F.least("end", "end_ref") - F.greatest("start", "start_ref")
    return pairs.groupBy("transcript_id").agg(F.count("*").alias("n_pairs"), F.sum(shared).alias("bases"))


@query(f"WITH {_EXONS} SELECT n.transcript_id, n.chrom, n.strand, n.s, n.e FROM ends n WHERE novel AND NOT EXISTS (SELECT 1 FROM exons r WHERE NOT r.novel AND r.chrom = n.chrom AND r.strand = n.strand AND r.s <= n.te AND r.e > n.te)")
def three_end_anti_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    novel, ref = ad.sides(spark, sf_dir)
    last = structure.exon_intron_tables(novel)["last_exons"]
    return _renamed(events.no_three_end_overlap(last, ref).select("transcript_id", "chrom", "strand", "start", "end"))


@query(f"""WITH {_EXONS}, j AS (SELECT n.transcript_id, CASE WHEN n.strand = '+' THEN n.e - r.e ELSE r.s - n.s END AS extension, CASE WHEN n.strand = '+' THEN abs(n.s - r.s) ELSE abs(n.e - r.e) END AS five, r.transcript_id AS transcript_id_ref, r.rnk AS region_rank, r.s AS rs
FROM ends n JOIN ranked r ON n.novel AND NOT r.novel AND n.chrom = r.chrom AND n.strand = r.strand AND n.s < r.e AND r.s < n.e)
SELECT transcript_id, extension, transcript_id_ref, region_rank FROM (SELECT *, row_number() OVER (PARTITION BY transcript_id ORDER BY extension, five, transcript_id_ref, rs) AS rn FROM j) WHERE rn = 1""")
def shortest_extension(spark: SparkSession, sf_dir: str) -> DataFrame:
    last, ref = _last_and_ref(spark, sf_dir)
    return events.shortest_extension(last, ref).select("transcript_id", "extension", "transcript_id_ref", "region_rank")


@query(f"WITH {_EVENTS} SELECT transcript_id, ext AS extension, coalesce(reason, 'none') AS reject_reason, CASE WHEN reason IS NULL THEN ref_rank || '_exon_extension' ELSE 'none' END AS event_type FROM ext")
def extension_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    last, ref = _last_and_ref(spark, sf_dir)
    found = events.classified_last_exons(last, ref, **_OPTIONS, carry=()).where("extension is not null")  # known where the 3' end is in no exon
    return found.select("transcript_id", "extension", F.coalesce("reject_reason", F.lit("none")).alias("reject_reason"), F.coalesce("event_type", F.lit("none")).alias("event_type"))


@query(f"""WITH {_EVENTS}, x AS (SELECT *, CASE WHEN ext < 50 THEN 'length' WHEN five > CASE WHEN ref_rank = 'first' THEN 60 ELSE 5 END THEN 'five_end' END AS why FROM ext1 WHERE rn = 1 AND ext >= 1)
SELECT transcript_id, coalesce(why, 'none') AS reject_reason, CASE WHEN why IS NULL THEN ref_rank || '_exon_extension' ELSE 'none' END AS event_type FROM x""")
def extension_events_tolerances(spark: SparkSession, sf_dir: str) -> DataFrame:
    last, ref = _last_and_ref(spark, sf_dir)
    found = events.classified_last_exons(last, ref, 50, 60, 5, carry=()).where("extension is not null")
    return found.select("transcript_id", F.coalesce("reject_reason", F.lit("none")).alias("reject_reason"), F.coalesce("event_type", F.lit("none")).alias("event_type"))


_SPLICED = """WITH {exons} SELECT i.transcript_id, array_to_string(list_sort(list(DISTINCT r.rnk || '_exon_spliced')), ',') AS event_type, count(*) AS n FROM introns i JOIN introns r ON i.novel AND i.num = i.cnt AND NOT r.novel AND r.chrom = i.chrom AND r.strand = i.strand AND {on} GROUP BY i.transcript_id"""


def _spliced(spark: SparkSession, sf_dir: str, exact: bool) -> DataFrame:
    novel, ref = ad.sides(spark, sf_dir)
    last = structure.exon_intron_tables(novel)["last_introns"].select("transcript_id", "chrom", "strand", "start", "end")
    found = written(events.spliced_events(last, structure.exon_intron_tables(ref)["introns"], exact).select("transcript_id", "event_type"), "spliced")
    return events.event_types_by_id(found).join(found.groupBy("transcript_id").agg(F.count("*").alias("n")), "transcript_id")


@query(_SPLICED.format(exons=_EXONS, on="CASE WHEN i.strand = '+' THEN i.s = r.s ELSE i.e = r.e END"))
def spliced_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _spliced(spark, sf_dir, True)


@query(_SPLICED.format(exons=_EXONS, on="i.s < r.e AND r.s < i.e"))
def spliced_events_any_site(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _spliced(spark, sf_dir, False)


@query(f"WITH {_EXONS} SELECT transcript_id, s, e, num AS region_number, rnk AS region_rank FROM ranked")
def region_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _renamed(structure.exon_intron_tables(ad.exons(spark, sf_dir))["exons"].select("transcript_id", "start", "end", F.col("region_number").cast("long").alias("region_number"), "region_rank"))


@query(f"WITH {_EXONS} SELECT transcript_id, s, e, num AS region_number, rnk AS region_rank FROM introns")
def introns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _renamed(structure.exon_intron_tables(ad.exons(spark, sf_dir))["introns"].select("transcript_id", "start", "end", F.col("region_number").cast("long").alias("region_number"), "region_rank"))


@query(f"WITH {_EXONS} SELECT transcript_id, s, e, 'first' AS kind FROM ranked WHERE num = 1 AND cnt > 1 UNION ALL SELECT transcript_id, s, e, 'last' FROM ranked WHERE num = cnt AND cnt > 1 UNION ALL SELECT transcript_id, s, e, 'internal' FROM ranked WHERE num > 1 AND num < cnt")
def terminal_and_internal_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = structure.exon_intron_tables(ad.exons(spark, sf_dir), write=True)["exons"]
    kind = lambda df, k: df.select("transcript_id", "start", "end", F.lit(k).alias("kind"))
    first, last = (kind(structure.terminal_regions(own, k, filter_single=True), k) for k in ("first", "last"))
    return _renamed(first.unionByName(last).unionByName(kind(structure.internal_regions(own), "internal")))


_ISLANDS = _EXONS + """,
ci AS (SELECT *, CASE WHEN s > max(e) OVER (PARTITION BY chrom, strand{more} ORDER BY s, e, transcript_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 1 ELSE 0 END AS o FROM {rows}),
cg AS (SELECT *, sum(o) OVER (PARTITION BY chrom, strand{more} ORDER BY s, e, transcript_id ROWS UNBOUNDED PRECEDING) AS k FROM ci),
cc AS (SELECT *, min(s) OVER (PARTITION BY chrom, strand{more}, k) AS cluster_start, max(e) OVER (PARTITION BY chrom, strand{more}, k) AS cluster_end FROM cg)"""


@query(f"WITH {_ISLANDS.format(more='', rows='exons')} SELECT transcript_id, s, e, cluster_start FROM cc")
def cluster_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _renamed(interval.cluster(ad.written_exons(spark, sf_dir)).select("transcript_id", "start", "end", "cluster_start"))


@query(f"WITH {_ISLANDS.format(more=', gene_id', rows='exons')} SELECT transcript_id, s, e, cluster_start FROM cc")
def cluster_by_gene(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _renamed(interval.cluster(ad.written_exons(spark, sf_dir), ["chrom", "strand", "gene_id"]).select("transcript_id", "start", "end", "cluster_start"))


@query(f"WITH {_ISLANDS.format(more='', rows='exons')} SELECT DISTINCT chrom, strand, cluster_start AS s, cluster_end AS e FROM cc")
def merge_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _renamed(interval.merge(ad.written_exons(spark, sf_dir)))


@query(f"""WITH {_ISLANDS.format(more='', rows='(SELECT * FROM ranked WHERE NOT novel AND num < cnt)')}, mask AS (SELECT DISTINCT chrom, strand, cluster_start AS ms, cluster_end AS me FROM cc),
cuts AS (SELECT n.transcript_id, n.s, n.e, m.ms, m.me FROM ends n JOIN mask m ON n.chrom = m.chrom AND n.strand = m.strand AND n.s < m.me AND m.ms < n.e),
points AS (SELECT transcript_id, s AS a FROM ends UNION ALL SELECT transcript_id, me FROM cuts),
stops AS (SELECT transcript_id, e AS z FROM ends UNION ALL SELECT transcript_id, ms FROM cuts),
gaps AS (SELECT p.transcript_id, p.a, q.z FROM (SELECT *, row_number() OVER (PARTITION BY transcript_id ORDER BY a) AS k FROM points) p JOIN (SELECT *, row_number() OVER (PARTITION BY transcript_id ORDER BY z) AS k FROM stops) q USING (transcript_id, k))
SELECT transcript_id, a AS s, z AS e FROM gaps WHERE z > a""")
def subtract_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = ad.tables(spark, sf_dir)
    last, mask = tables["last_exons"].select("transcript_id", "chrom", "strand", "start", "end"), tables["exons_before_last"].where("not novel")
    return _renamed(interval.subtract(last, mask.select("chrom", "strand", "start", "end"), "transcript_id").select("transcript_id", "start", "end"))


_ATLAS = "atlas AS (SELECT 'chr' || ((p_partkey // 4) % 5) AS chrom, CASE WHEN (p_partkey // 4) % 2 = 0 THEN '+' ELSE '-' END AS strand, (p_partkey // 4) * 10000 + ((p_partkey * 7) % 40) * 200 + 100 AS s, 'site' || p_partkey AS name FROM part)"


@query(f"""WITH {_EXONS}, {_ATLAS}, d AS (SELECT n.transcript_id, a.s AS site_start, CASE WHEN a.s = n.te THEN 0 WHEN a.s < n.te THEN n.te - a.s ELSE a.s - n.te END AS distance, CASE WHEN n.strand = '+' THEN -a.s ELSE a.s END AS toward FROM ends n JOIN atlas a USING (chrom, strand)),
r AS (SELECT *, row_number() OVER (PARTITION BY transcript_id ORDER BY distance, toward) AS rn FROM d)
SELECT transcript_id, site_start, distance, CASE WHEN distance <= 100 THEN 1 ELSE 0 END AS atlas_filter FROM r WHERE rn = 1""")
def nearest_atlas_site(spark: SparkSession, sf_dir: str) -> DataFrame:
    last = ad.tables(spark, sf_dir)["last_exons"].select("transcript_id", "chrom", "strand", "start", "end")
    found = three_ends.nearest_atlas_site(last, ad.atlas(spark, sf_dir))
    return found.where("nearest_atlas_distance is not null").select("transcript_id", F.col("atlas_start").alias("site_start"), F.col("nearest_atlas_distance").alias("distance"), "atlas_filter")


_REF_TYPES = _EXONS + """,
nle AS (SELECT * FROM ranked WHERE NOT novel AND (num = 1 OR num < cnt)),
nli AS (SELECT * FROM introns WHERE NOT novel AND (num = 1 OR num < cnt)),
rfree AS (SELECT * FROM ends n WHERE NOT novel AND NOT EXISTS (SELECT 1 FROM nle r WHERE r.chrom = n.chrom AND r.strand = n.strand AND r.s <= n.te AND r.e > n.te)),
rext0 AS (SELECT n.transcript_id, r.rnk, CASE WHEN n.strand = '+' THEN n.e - r.e ELSE r.s - n.s END AS ext, CASE WHEN n.strand = '+' THEN abs(n.s - r.s) ELSE abs(n.e - r.e) END AS five, r.transcript_id AS rt, r.s AS rs FROM rfree n JOIN nle r ON n.chrom = r.chrom AND n.strand = r.strand AND n.s < r.e AND r.s < n.e),
rext AS (SELECT transcript_id, rnk || '_exon_extension' AS event_type FROM (SELECT *, row_number() OVER (PARTITION BY transcript_id ORDER BY ext, five, rt, rs) AS rn FROM rext0) WHERE rn = 1 AND ext >= 1),
rli AS (SELECT * FROM introns WHERE NOT novel AND num = cnt AND transcript_id IN (SELECT transcript_id FROM rfree) AND transcript_id NOT IN (SELECT transcript_id FROM rext)),
rspl AS (SELECT i.transcript_id, array_to_string(list_sort(list(DISTINCT r.rnk || '_exon_spliced')), ',') AS event_type FROM rli i JOIN nli r ON r.chrom = i.chrom AND r.strand = i.strand AND CASE WHEN i.strand = '+' THEN i.s = r.s ELSE i.e = r.e END GROUP BY i.transcript_id),
ref_types AS (SELECT * FROM rext UNION ALL SELECT * FROM rspl UNION ALL SELECT transcript_id, 'last_exon_spliced' FROM rli WHERE transcript_id NOT IN (SELECT transcript_id FROM rspl))"""


@query(f"WITH {_REF_TYPES} SELECT * FROM ref_types")
def reference_event_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.reference_event_types(None, tables=ad.ref_tables(spark, sf_dir))


_LE = _REF_TYPES + """,
les AS (SELECT e.transcript_id, e.gene_id, e.gene_name, e.chrom, e.strand, e.s, e.e, t.event_type FROM ends e JOIN ref_types t USING (transcript_id)),
lo AS (SELECT *, CASE WHEN s > max(e) OVER (PARTITION BY gene_id ORDER BY s, e, transcript_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 1 ELSE 0 END AS o FROM les),
lk AS (SELECT *, sum(o) OVER (PARTITION BY gene_id ORDER BY s, e, transcript_id ROWS UNBOUNDED PRECEDING) AS k FROM lo),
ln AS (SELECT *, dense_rank() OVER (PARTITION BY gene_id ORDER BY CASE WHEN strand = '+' THEN k ELSE -k END) AS num, contains(event_type, 'last_exon_extension') AS isx FROM lk),
lx AS (SELECT gene_id, num, max(CASE WHEN isx THEN 1 ELSE 0 END) AS x FROM ln GROUP BY gene_id, num),
ls AS (SELECT gene_id, num, coalesce(sum(x) OVER (PARTITION BY gene_id ORDER BY num ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS sh FROM lx),
le AS (SELECT ln.*, CAST(ln.num + ls.sh + CASE WHEN isx THEN 1 ELSE 0 END AS BIGINT) AS le_number, gene_id || '_' || CAST(ln.num + ls.sh + CASE WHEN isx THEN 1 ELSE 0 END AS BIGINT) AS le_id FROM ln JOIN ls USING (gene_id, num))"""


def _ref_le(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = ad.ref_tables(spark, sf_dir)
    last = events.typed_last_exons(None, ("chrom", "strand", "start", "end", "gene_id", "gene_name"), tables=tables)
    return le.with_le_ids(last.withColumnsRenamed({"gene_id": "ref_gene_id", "gene_name": "ref_gene_name"}))


@query(f"WITH {_LE} SELECT transcript_id, event_type, le_number, le_id FROM le")
def last_exon_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ref_le(spark, sf_dir).select("transcript_id", "event_type", F.col("le_number").cast("long").alias("le_number"), "le_id")


@query(f"WITH {_LE}, many AS (SELECT * FROM le WHERE gene_id IN (SELECT gene_id FROM le GROUP BY gene_id HAVING count(*) > 1)) SELECT DISTINCT 'tx2le' AS map, transcript_id AS a, le_id AS b FROM many UNION ALL SELECT DISTINCT 'tx2gene', transcript_id, gene_id FROM many UNION ALL SELECT DISTINCT 'le2gene', le_id, gene_id FROM many UNION ALL SELECT DISTINCT 'le2genename', le_id, gene_name FROM many")
def id_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return le.id_map_rows(written(_ref_le(spark, sf_dir), "last-exon-ids"))


@query(f"""WITH {_LE}, many AS (SELECT * FROM le WHERE gene_id IN (SELECT gene_id FROM le GROUP BY gene_id HAVING count(*) > 1))
SELECT le_id, string_agg(transcript_id, ',' ORDER BY s, e, transcript_id) AS transcripts, count(*) AS n FROM many GROUP BY le_id""")
def collapse_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    info = le.info_table(written(_ref_le(spark, sf_dir), "last-exon-ids"))
    rows = collapse.collapse_metadata(info.withColumn("_one", F.lit(1)), "le_id", ["start", "end", "transcript_id"], all_values=["transcript_id"])
    return rows.select("le_id", F.col("transcript_id").alias("transcripts"), F.size(F.split("transcript_id", ",")).cast("long").alias("n"))


@query(f"""WITH {_EVENTS}, g AS (SELECT transcript_id, list_distinct(string_split(gene_id_ref, ',')) AS gs FROM novel_le) SELECT transcript_id, len(gs) AS n_genes FROM g""")
def metagene_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    new, ref = ad.side_tables(spark, sf_dir)
    novel = events.novel_last_exons(None, None, tables=(new, ref), **_OPTIONS).withColumn("ref_gene_id", F.col("gene_id_ref"))
    named, _ = le.metagenes(novel, ref["exons"].withColumn("ref_gene_id", F.col("gene_id")))
    return named.select("transcript_id", F.size(F.split("ref_gene_id", ",")).cast("long").alias("n_genes"))


@query("SELECT p_partkey, p_brand, p_size FROM part WHERE p_size <= 30 AND p_type IN ('ECONOMY', 'SMALL') AND p_brand <> 'Brand#3' AND regexp_matches(p_name, 'red|blue')")
def annotation_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = ad.table(spark, sf_dir, "part").withColumnsRenamed({"p_size": "transcript_support_level", "p_name": "tag"})
    out = jobs.filter_annotation(part, min_tsl=30, include={"p_type": ["ECONOMY", "SMALL"]}, exclude={"p_brand": "Brand#3"}, tag_include=["red", "blue"])
    return out.select("p_partkey", "p_brand", F.col("transcript_support_level").alias("p_size"))


@query("SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment = 'HOUSEHOLD' OR (c_mktsegment = 'MACHINERY' AND c_acctbal >= 1000 AND c_nationkey NOT IN (1, 2, 3))")
def group_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = {"MACHINERY": [("c_acctbal", "ge", 1000), ("c_nationkey", "not_in", [1, 2, 3])]}
    return ad.table(spark, sf_dir, "customer").where(filters.by_group("c_mktsegment", ["HOUSEHOLD", "MACHINERY"], rules)).select("c_custkey", "c_mktsegment")


_MOTIFS = ("the", "tion", "and", "quel")


@query("""WITH d AS (SELECT doc_id, lower(regexp_replace(text, '[^a-zA-Z]', '', 'g')) AS t FROM documents),
k AS (SELECT doc_id, t, unnest(range(1, greatest(length(t) - 1, 1)::BIGINT)) AS i FROM d),
h AS (SELECT doc_id, i, substr(t, i, 3) AS m FROM k WHERE substr(t, i, 3) IN ('the', 'and') UNION ALL SELECT doc_id, i, substr(t, i, 4) FROM k WHERE substr(t, i, 4) IN ('tion', 'quel'))
SELECT doc_id, count(*) AS n_hits, max(i + length(m) - 1 - 100) AS last_distance, min(abs(i + length(m) - 1 - 100 + 21)) AS least_deviation FROM h GROUP BY doc_id""")
def motif_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = ad.spread(ad.table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id").select("doc_id", F.lower(F.regexp_replace("text", "[^a-zA-Z]", "")).alias("t"))
    # explode, so that the filter does not work the hits out a second time
    found = docs.select("doc_id", F.explode(F.array(motif_string(motif_hits(F.col("t"), _MOTIFS, 100)))).alias("motifs")).where("motifs <> 'not_found'")
    at = parse_motif_string(F.col("motifs"))
    return found.select("doc_id", F.size(at).cast("long").alias("n_hits"), F.array_max(at).cast("long").alias("last_distance"), least_deviation(at, 21)["deviation"].cast("long").alias("least_deviation"))


@query(f"""WITH {_EXONS}, w AS (SELECT transcript_id, chrom, strand, CASE WHEN strand = '+' THEN greatest(e - 100, 0) ELSE s END AS ws, CASE WHEN strand = '+' THEN e ELSE s + 100 END AS we FROM ends),
b AS (SELECT w.*, unnest(range(ws, we)) AS i FROM w),
q AS (SELECT transcript_id, strand, string_agg(substr(translate(md5(chrom || ':' || (i // 32)), '0123456789abcdef', 'AATAACAATAAGTAAC'), CAST(i % 32 AS INT) + 1, 1), '' ORDER BY i) AS f FROM b GROUP BY transcript_id, strand)
SELECT transcript_id, CASE WHEN strand = '-' THEN reverse(translate(f, 'ACGT', 'TGCA')) ELSE f END AS sequence FROM q""")
def terminal_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    last = written(structure.exon_intron_tables(ad.exons(spark, sf_dir))["last_exons"], "last-exons")
    ends = terminal_window(last.select("transcript_id", "chrom", "strand", "start", "end"), 100)
    return three_ends.region_sequences(ends, ad.genome(ends), "transcript_id", ad.CHUNK).select("transcript_id", "sequence")


_QUANT = """q AS (SELECT 't' || l_partkey AS transcript_id, 'le' || (l_partkey % 600) AS le_id, 'g' || ((l_partkey % 600) % 200) AS gene_id, 's' || (l_suppkey % 6) AS sample, CASE WHEN l_suppkey % 6 < 3 THEN 'base' ELSE 'treated' END AS condition, sum(l_quantity) AS tpm, count(*) * 10.0 AS count, 1000.0 + l_partkey AS length FROM lineitem GROUP BY l_partkey, l_suppkey % 6)"""
_LES = _QUANT + """,
x AS (SELECT *, tpm * length AS raw FROM q), f AS (SELECT sample, sum(count) / sum(raw) AS k FROM x GROUP BY sample),
l AS (SELECT le_id, gene_id, sample, condition, sum(tpm) AS tpm, sum(raw * k) AS cnt, sum(tpm * length) / sum(tpm) AS len FROM x JOIN f USING (sample) GROUP BY le_id, gene_id, sample, condition),
m AS (SELECT le_id, avg(len) AS ml FROM l GROUP BY le_id), y AS (SELECT l.*, tpm * ml AS raw FROM l JOIN m USING (le_id)),
g AS (SELECT sample, sum(cnt) / sum(raw) AS k FROM y GROUP BY sample),
les AS (SELECT le_id, gene_id, sample, condition, tpm, len, raw * k AS count FROM y JOIN g USING (sample))"""


def _matrices(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return jobs.usage_matrices(ad.quant(spark, sf_dir), ad.tx2le(spark, sf_dir), ad.le2gene(spark, sf_dir), ad.samples(spark), "base", "treated")


def _rounded(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in cols})


@query(f"WITH {_LES} SELECT le_id, gene_id, sample, round(count, 4) AS count, round(tpm, 4) AS tpm FROM les")
def last_exon_abundance(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = _matrices(spark, sf_dir)
    return m["counts"].join(m["tpm"].drop("gene_id"), ["le_id", "sample"]).select("le_id", "gene_id", "sample", F.round("count", 4).alias("count"), F.round("tpm", 4).alias("tpm"))


@query(f"WITH {_LES} SELECT le_id, gene_id, sample, round(tpm / sum(tpm) OVER (PARTITION BY gene_id, sample), 6) AS ppau FROM les")
def usage_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_matrices(spark, sf_dir)["ppau"].drop("tpm"), "ppau")


@query(f"""WITH {_LES}, p AS (SELECT *, tpm / sum(tpm) OVER (PARTITION BY gene_id, sample) AS u FROM les)
SELECT le_id, gene_id, round(avg(u) FILTER (condition = 'base'), 6) AS mean_base, round(avg(u) FILTER (condition = 'treated'), 6) AS mean_treatment, round(avg(u) FILTER (condition = 'treated') - avg(u) FILTER (condition = 'base'), 6) AS delta FROM p GROUP BY le_id, gene_id""")
def condition_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_matrices(spark, sf_dir)["means"], "mean_base", "mean_treatment", "delta")


@query(f"WITH {_LES}, t AS (SELECT gene_id, sample, condition, sum(tpm) AS tpm FROM les GROUP BY gene_id, sample, condition) SELECT gene_id, condition, round(avg(tpm), 4) AS mean_tpm, round(median(tpm), 4) AS median_tpm FROM t GROUP BY gene_id, condition")
def gene_tpm_by_condition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _matrices(spark, sf_dir)["gene_tpm_by_condition"].select("gene_id", "condition", F.round("mean_tpm", 4).alias("mean_tpm"), F.round("median_tpm", 4).alias("median_tpm"))


_COUNTS = _QUANT + ", c AS (SELECT le_id, gene_id, sample, condition, sum(count) AS count FROM q GROUP BY le_id, gene_id, sample, condition)"
_FACTORS = _COUNTS + ", gm AS (SELECT le_id, avg(ln(count)) AS g FROM c GROUP BY le_id HAVING count(*) = (SELECT count(DISTINCT sample) FROM c)), sf AS (SELECT sample, median(count / exp(g)) AS k FROM c JOIN gm USING (le_id) GROUP BY sample)"


def _counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ad.quant(spark, sf_dir).join(ad.tx2le(spark, sf_dir), "transcript_id").join(ad.le2gene(spark, sf_dir), "le_id")
    return rows.groupBy("le_id", "gene_id", "sample").agg(F.sum("count").alias("count"))


@query(f"WITH {_FACTORS} SELECT sample, round(k, 6) AS size_factor FROM sf")
def size_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(usage.size_factors(_counts(spark, sf_dir)), "size_factor")


@query(f"""WITH {_FACTORS}, k1 AS (SELECT le_id FROM (SELECT le_id, condition, avg(count / k) AS a FROM c JOIN sf USING (sample) GROUP BY le_id, condition) GROUP BY le_id HAVING max(a) > 25),
c1 AS (SELECT * FROM c WHERE le_id IN (SELECT le_id FROM k1)), u AS (SELECT *, count / sum(count) OVER (PARTITION BY gene_id, sample) AS s FROM c1),
k2 AS (SELECT le_id FROM (SELECT le_id, condition, avg(s) AS a FROM u GROUP BY le_id, condition) GROUP BY le_id HAVING max(a) > 0.3),
c2 AS (SELECT * FROM c1 WHERE le_id IN (SELECT le_id FROM k2))
SELECT le_id, gene_id, sample, count FROM c2 WHERE gene_id IN (SELECT gene_id FROM c2 GROUP BY gene_id HAVING count(DISTINCT le_id) > 1)""")
def differential_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.differential_input(_counts(spark, sf_dir), ad.samples(spark), 25, 0.3)


@query(f"WITH {_COUNTS} SELECT le_id, gene_id, {', '.join(f'coalesce(sum(count) FILTER (sample = {chr(39)}s{k}{chr(39)}), 0.0) AS s{k}' for k in range(6))} FROM c GROUP BY le_id, gene_id")
def counts_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = [f"s{k}" for k in range(6)]
    return usage.wide(_counts(spark, sf_dir), ["le_id", "gene_id"], names, "count").na.fill(0.0, names)


@query(f"WITH {_COUNTS} SELECT le_id, gene_id, sample, count FROM c")
def counts_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = [f"s{k}" for k in range(6)]
    return usage.long(usage.wide(_counts(spark, sf_dir), ["le_id", "gene_id"], names, "count"), ["le_id", "gene_id"], names, "count").where("count is not null")


_P = "p AS (SELECT o_orderkey AS le_id, 'g' || o_custkey AS gene_id, (o_orderkey * 7919 % 99991 + 1) / 99992.0 AS pvalue FROM orders)"


@query(f"WITH {_P}, r AS (SELECT *, rank() OVER (ORDER BY pvalue) + count(*) OVER (PARTITION BY pvalue) - 1 AS k, count(*) OVER () AS m FROM p) SELECT le_id, round(least(1.0, min(pvalue * m / k) OVER (ORDER BY pvalue DESC RANGE UNBOUNDED PRECEDING)), 9) AS padj FROM r")
def adjusted_pvalues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return benjamini_hochberg(ad.pvalues(spark, sf_dir)).select("le_id", F.round("padj", 9).alias("padj"))


@query(f"""WITH {_P}, g AS (SELECT gene_id, min(pvalue) AS t, count(*) AS n FROM p GROUP BY gene_id), s AS (SELECT n, count(*) AS m FROM g GROUP BY n),
t AS (SELECT DISTINCT t FROM g), q AS (SELECT t.t, sum(s.m * (1 - power(1 - t.t, s.n))) AS false_ones FROM t, s GROUP BY t.t), c AS (SELECT t, count(*) OVER (ORDER BY t RANGE UNBOUNDED PRECEDING) AS upto, gene_id FROM g)
SELECT gene_id, round(least(1.0, false_ones / upto), 9) AS gene_q FROM c JOIN q USING (t)""")
def gene_qvalues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gene_q_values(ad.pvalues(spark, sf_dir)).select("gene_id", F.round("gene_q", 9).alias("gene_q"))


_EXP = _EXONS + """, ev AS (SELECT e.transcript_id, e.chrom, e.strand, e.s, e.e, o.o_orderpriority AS experiment_id, o.o_orderstatus AS event_type FROM ends e JOIN orders o ON 'tx' || o.o_orderkey = e.transcript_id),
eo AS (SELECT *, CASE WHEN s > max(e) OVER (PARTITION BY chrom, strand ORDER BY s, e, transcript_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 1 ELSE 0 END AS o FROM ev),
ek AS (SELECT *, sum(o) OVER (PARTITION BY chrom, strand ORDER BY s, e, transcript_id ROWS UNBOUNDED PRECEDING) AS k FROM eo),
ec AS (SELECT *, chrom || ':' || strand || ':' || min(s) OVER (PARTITION BY chrom, strand, k) AS cluster FROM ek),
pc AS (SELECT cluster, count(DISTINCT experiment_id) AS n, array_to_string(list_sort(list(DISTINCT experiment_id)), ',') AS experiments FROM ec GROUP BY cluster)"""


def _experiments(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    last = structure.exon_intron_tables(ad.exons(spark, sf_dir))["last_exons"]
    orders = ad.table(spark, sf_dir, "orders").select(F.concat(F.lit("tx"), "o_orderkey").alias("transcript_id"), F.col("o_orderpriority").alias("experiment_id"), F.col("o_orderstatus").alias("event_type"), F.lit(0.5).alias("delta"))
    return jobs.merge_experiments(last.select("transcript_id", "chrom", "strand", "start", "end").join(orders, "transcript_id"))


@query(f"WITH {_EXP} SELECT cluster, chrom, strand, min(s) AS s, max(e) AS e, max(n) AS experiment_count FROM ec JOIN pc USING (cluster) GROUP BY cluster, chrom, strand")
def merged_experiments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _renamed(_experiments(spark, sf_dir)["merged"])


@query(f"WITH {_EXP} SELECT experiments, count(*) AS n FROM pc GROUP BY experiments")
def experiment_combinations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _experiments(spark, sf_dir)["combinations"]


@query(f"WITH {_EXP}, v AS (SELECT n > 1 AS multiple_datasets, event_type, count(*) AS n FROM ec JOIN pc USING (cluster) GROUP BY 1, 2) SELECT multiple_datasets, event_type, n, round(n / sum(n) OVER (PARTITION BY multiple_datasets), 6) AS share FROM v")
def event_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_experiments(spark, sf_dir)["event_shares"], "share")


@query(f"WITH {_EXP} SELECT count(n) AS count, round(avg(n), 6) AS mean, round(stddev(n), 6) AS std, min(n) AS min, {', '.join(f'round(quantile_cont(n, {k / 10}), 6) AS p{k}0' for k in range(1, 10))}, max(n) AS max FROM pc")
def describe_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_experiments(spark, sf_dir)["count_summary"], "mean", "std", *(f"p{k}0" for k in range(1, 10)))


@query(f"WITH {_EXONS} SELECT transcript_id, gene_id, chrom, strand, s, e FROM exons")
def gtf_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = genomic.gtf_lines(ad.exons(spark, sf_dir), ["gene_id", "transcript_id", "gene_name"])
    return _renamed(genomic.gtf_table(lines, ["transcript_id", "gene_id"]).select("transcript_id", "gene_id", "chrom", "strand", "start", "end"))


@query(f"WITH {_EXONS} SELECT transcript_id, s, coalesce('a' || (s % 3) || ',b', 'x') AS tag, gene_id FROM exons")
def gtf_repeated_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = ad.exons(spark, sf_dir)
    lines = genomic.gtf_lines(own.withColumn("tag", F.concat(F.lit("a"), F.col("start") % 3)), ["gene_id", "transcript_id", "tag"]).select(F.concat("value", F.lit(' tag "b";')).alias("value"))
    return _renamed(genomic.gtf_table(lines).select(F.col("attributes.transcript_id").alias("transcript_id"), "start", F.col("attributes.tag").alias("tag"), F.col("attributes.gene_id").alias("gene_id")))


@query(f"WITH {_ATLAS} SELECT 'chr' || chrom AS chrom, s + 1 AS coordinate, strand, 'CPAS' AS label FROM atlas")
def point_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return genomic.point_features(ad.atlas(spark, sf_dir), add_chr=True, standard_bed6=True)


@query("""WITH t AS (SELECT l_orderkey AS o, 's' || (l_suppkey % 4) AS sample, l_partkey AS p, sum(l_quantity) AS tpm FROM lineitem GROUP BY 1, 2, 3), m AS (SELECT o FROM t GROUP BY o HAVING sum(tpm) / (SELECT count(DISTINCT sample) FROM t) >= 20)
SELECT DISTINCT sample, 'tx' || p AS transcript_id FROM t WHERE o IN (SELECT o FROM m)""")
def keep_expressed(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = ad.table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("transcript_id"), F.concat(F.lit("s"), F.col("l_suppkey") % 4).alias("sample"), F.concat(F.lit("tx"), "l_partkey").alias("sample_tx"), F.col("l_quantity").alias("tpm"))
    gtf = line.select("sample", F.col("sample_tx").alias("transcript_id")).distinct()
    return usage.keep_expressed(gtf, line, 20.0)


@query("""WITH t AS (SELECT o_orderkey AS k, o_custkey AS c, o_totalprice AS v FROM orders), w AS (SELECT k, 's' || (c % 3) AS sample, c, v FROM t)
SELECT CAST(k AS VARCHAR) AS transcript_id, sample, 'x' || c AS sample_tx, round(v, 2) AS tpm FROM w""")
def tracking_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = ad.table(spark, sf_dir, "orders")
    packed = lambda k: F.when(F.col("o_custkey") % 3 == k, F.concat_ws("|", F.lit(f"q{k + 1}:g"), F.concat(F.lit("x"), "o_custkey"), F.lit("2"), F.lit("1.0"), F.col("o_totalprice").cast("string"), F.lit("900"))).otherwise("-")
    wide = o.select(F.col("o_orderkey").cast("string").alias("transcript_id"), F.lit("g").alias("gene_id"), F.lit("r").alias("ref_gene_id"), F.lit("=").alias("overlap_class_code"), *(packed(k).alias(f"s{k}") for k in range(3)))
    return sheets.tracking_table(wide, ["s0", "s1", "s2"]).where("sample_tx is not null").select("transcript_id", "sample", "sample_tx", F.round("tpm", 2).alias("tpm"))


@query(f"""WITH {_EXONS}, ic AS (SELECT transcript_id, string_agg(s || '-' || e, ',' ORDER BY s) AS c FROM introns GROUP BY transcript_id), tx AS (SELECT transcript_id, chrom, strand, min(s) AS s, max(e) AS e FROM exons GROUP BY 1, 2, 3),
one AS (SELECT * FROM tx WHERE transcript_id NOT IN (SELECT transcript_id FROM ic)),
oo AS (SELECT *, CASE WHEN s > max(e) OVER (PARTITION BY chrom, strand ORDER BY s, e, transcript_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 1 ELSE 0 END AS o FROM one),
ok AS (SELECT *, sum(o) OVER (PARTITION BY chrom, strand ORDER BY s, e, transcript_id ROWS UNBOUNDED PRECEDING) AS k FROM oo)
, merged AS (SELECT transcript_id, chrom || ':' || strand || ':' || c AS merged_id FROM tx JOIN ic USING (transcript_id) UNION ALL SELECT transcript_id, chrom || ':' || strand || ':' || min(s) OVER (PARTITION BY chrom, strand, k) FROM ok),
kinds AS (SELECT DISTINCT transcript_id, novel FROM exons)
SELECT CASE WHEN novel THEN 'a' ELSE 'b' END AS sample, transcript_id, merged_id FROM merged JOIN kinds USING (transcript_id) UNION ALL SELECT 'c', transcript_id, merged_id FROM merged JOIN kinds USING (transcript_id) WHERE novel""")
def match_across_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = ad.written_exons(spark, sf_dir)
    again = own.where("novel").withColumn("sample", F.lit("c"))
    return jobs.match_across_samples(own.withColumn("sample", F.when(F.col("novel"), "a").otherwise("b")).unionByName(again))


def _three_ends(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    last = written(structure.exon_intron_tables(ad.exons(spark, sf_dir))["last_exons"].select("transcript_id", "chrom", "strand", "start", "end", "gene_id"), "last-exons")
    named = jobs.combine_last_exons([last])
    return jobs.filter_three_ends(named, ad.atlas(spark, sf_dir), ad.genome(terminal_window(last, 100)), ad.CHUNK, motifs=GRUBER_MOTIFS)


_MOTIF_LIST = ", ".join(f"'{m}'" for m in GRUBER_MOTIFS)
#: Evidence for the 3' ends of all last exons; the sequences are those of terminal_sequences.
_EVIDENCE = _ISLANDS.format(more="", rows="ends") + f""",
{_ATLAS},
d AS (SELECT n.transcript_id, a.s AS site, abs(a.s - n.te) AS distance, CASE WHEN n.strand = '+' THEN -a.s ELSE a.s END AS toward FROM ends n JOIN atlas a USING (chrom, strand)),
near AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY transcript_id ORDER BY distance, toward) AS rn FROM d) WHERE rn = 1),
w AS (SELECT transcript_id, chrom, strand, CASE WHEN strand = '+' THEN greatest(e - 100, 0) ELSE s END AS ws, CASE WHEN strand = '+' THEN e ELSE s + 100 END AS we FROM ends),
bases AS (SELECT w.*, unnest(range(ws, we)) AS i FROM w),
fwd AS (SELECT transcript_id, strand, string_agg(substr(translate(md5(chrom || ':' || (i // 32)), '0123456789abcdef', 'AATAACAATAAGTAAC'), CAST(i % 32 AS INT) + 1, 1), '' ORDER BY i) AS f FROM bases GROUP BY transcript_id, strand),
sq AS (SELECT transcript_id, CASE WHEN strand = '-' THEN reverse(translate(f, 'ACGT', 'TGCA')) ELSE f END AS q FROM fwd),
spots AS (SELECT transcript_id, q, unnest(range(1, greatest(length(q) - 4, 1)::BIGINT)) AS i FROM sq),
hits AS (SELECT transcript_id, i + 5 - 100 AS pos, substr(q, i, 6) AS m FROM spots WHERE substr(q, i, 6) IN ({_MOTIF_LIST})),
found AS (SELECT transcript_id, string_agg(pos || '_' || m, ',' ORDER BY pos) AS motifs, min(abs(pos + 21)) AS dev, arg_min(pos, abs(pos + 21) * 1000 + pos) AS best FROM hits GROUP BY transcript_id),
stats AS (SELECT c.transcript_id, c.chrom, c.strand, c.s, c.e, c.chrom || ':' || c.strand || ':' || c.cluster_start AS last_exon_id, n.site, n.distance, n.toward, CASE WHEN n.distance <= 100 THEN 1 ELSE 0 END AS atlas_filter, coalesce(f.motifs, 'not_found') AS motifs, CASE WHEN f.motifs IS NULL THEN 0 ELSE 1 END AS motif_filter, f.dev, f.best
  FROM cc c LEFT JOIN near n USING (transcript_id) LEFT JOIN found f USING (transcript_id))"""


@query(f"""WITH {_EVIDENCE}, a AS (SELECT *, row_number() OVER (PARTITION BY last_exon_id ORDER BY distance, toward, transcript_id) AS rn FROM stats WHERE atlas_filter = 1),
m AS (SELECT *, row_number() OVER (PARTITION BY last_exon_id ORDER BY dev, transcript_id) AS rn FROM stats WHERE atlas_filter = 0 AND motif_filter = 1)
SELECT transcript_id, last_exon_id, 'atlas' AS evidence, CASE WHEN strand = '-' THEN site ELSE s END AS s, CASE WHEN strand = '+' THEN site + 1 ELSE e END AS e, motifs, CAST(1 AS INT) AS motif_distance FROM a WHERE rn = 1
UNION ALL SELECT transcript_id, last_exon_id, 'motif', s, e, motifs, CAST(best AS INT) FROM m WHERE rn = 1""")
def three_end_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _renamed(_three_ends(spark, sf_dir)["passed"].select("transcript_id", "last_exon_id", "evidence", "start", "end", "motifs", F.coalesce("min_motif_distance", F.lit(1)).alias("motif_distance")))


@query(f"WITH {_EVIDENCE} SELECT CASE WHEN atlas_filter = 1 OR motif_filter = 1 THEN 'valid' ELSE 'not_valid' END AS match_class, atlas_filter, motif_filter, count(DISTINCT transcript_id) AS n FROM stats GROUP BY 1, 2, 3")
def three_end_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _three_ends(spark, sf_dir)["classes"]


@query(f"WITH {_EVIDENCE} SELECT transcript_id, motifs, motif_filter, distance, atlas_filter FROM stats")
def three_end_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _three_ends(spark, sf_dir)["match_stats"].select("transcript_id", "motifs", "motif_filter", F.col("nearest_atlas_distance").alias("distance"), "atlas_filter")


def _once(items: str) -> str:
    """SQL for a list's values in order, each once."""
    return f"list_filter({items}, lambda x, i: list_position({items}, x) = i)"


#: Genes of novel last exons, each once, and the combination that each gene of several takes.
_METAGENES = _EVENTS + _REF_TYPES[len(_EXONS) :] + f""",
nn AS (SELECT transcript_id, chrom, strand, s, e, event_type, array_to_string({_once("l")}, ',') AS gid FROM (SELECT *, string_split(gene_id_ref, ',') AS l FROM novel_le)),
parts AS (SELECT *, unnest(string_split(gid, ',')) AS g FROM nn WHERE contains(gid, ',')),
combo AS (SELECT g, last(gid ORDER BY chrom, strand, s, e, transcript_id) AS combo FROM parts GROUP BY g)"""


def _annotation_sql(rows: str) -> str:
    """Numbered last exons less the bases of first and internal reference exons, from (transcript_id, chrom, strand, s, e, event_type, gid)."""
    mask = _ISLANDS.format(more="", rows="(SELECT * FROM ranked WHERE NOT novel AND (num = 1 OR num < cnt))")[len(_EXONS) :]
    return f"""{rows},
lo AS (SELECT *, CASE WHEN s > max(e) OVER (PARTITION BY chrom, strand, gid ORDER BY s, e, transcript_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 1 ELSE 0 END AS o FROM al),
lk AS (SELECT *, sum(o) OVER (PARTITION BY chrom, strand, gid ORDER BY s, e, transcript_id ROWS UNBOUNDED PRECEDING) AS k FROM lo),
ln AS (SELECT *, dense_rank() OVER (PARTITION BY chrom, strand, gid ORDER BY CASE WHEN strand = '+' THEN k ELSE -k END) AS num, contains(event_type, 'last_exon_extension') AS isx FROM lk),
lx AS (SELECT chrom, strand, gid, num, max(CASE WHEN isx THEN 1 ELSE 0 END) AS x FROM ln GROUP BY chrom, strand, gid, num),
ls AS (SELECT chrom, strand, gid, num, coalesce(sum(x) OVER (PARTITION BY chrom, strand, gid ORDER BY num ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS sh FROM lx),
le AS (SELECT ln.*, gid || '_' || CAST(ln.num + ls.sh + CASE WHEN isx THEN 1 ELSE 0 END AS BIGINT) AS le_id FROM ln JOIN ls USING (chrom, strand, gid, num)){mask},
mask AS (SELECT DISTINCT chrom, strand, cluster_start AS ms, cluster_end AS me FROM cc),
cuts AS (SELECT n.transcript_id, m.ms, m.me FROM le n JOIN mask m ON n.chrom = m.chrom AND n.strand = m.strand AND n.s < m.me AND m.ms < n.e),
points AS (SELECT transcript_id, s AS a FROM le UNION ALL SELECT transcript_id, me FROM cuts),
stops AS (SELECT transcript_id, e AS z FROM le UNION ALL SELECT transcript_id, ms FROM cuts),
gaps AS (SELECT p.transcript_id, p.a, q.z FROM (SELECT *, row_number() OVER (PARTITION BY transcript_id ORDER BY a) AS k FROM points) p JOIN (SELECT *, row_number() OVER (PARTITION BY transcript_id ORDER BY z) AS k FROM stops) q USING (transcript_id, k))
SELECT le.transcript_id, le_id, event_type, chrom, strand, a AS s, z AS e FROM gaps JOIN le USING (transcript_id) WHERE z > a"""


_ANNOTATION = ["transcript_id", "le_id", "event_type", "chrom", "strand", "start", "end"]


@query("WITH " + _annotation_sql(_METAGENES + """,
al AS (SELECT * FROM nn UNION ALL SELECT e.transcript_id, e.chrom, e.strand, e.s, e.e, t.event_type, coalesce(c.combo, e.gene_id) FROM ends e JOIN ref_types t USING (transcript_id) LEFT JOIN combo c ON c.g = e.gene_id)"""))
def combined_annotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    new, ref = ad.side_tables(spark, sf_dir)
    novel = events.novel_last_exons(None, None, tables=(new, ref), **_OPTIONS)
    return _renamed(jobs.combined_annotation(novel, None, tables=ref)["unique"].select(*_ANNOTATION))


@query("WITH " + _annotation_sql(_REF_TYPES + ", al AS (SELECT e.transcript_id, e.chrom, e.strand, e.s, e.e, t.event_type, e.gene_id AS gid FROM ends e JOIN ref_types t USING (transcript_id))"))
def reference_annotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _renamed(jobs.reference_annotation(None, tables=ad.ref_tables(spark, sf_dir))["unique"].select(*_ANNOTATION))


@query(f"WITH {_METAGENES} SELECT 'novel' AS side, transcript_id, gid AS gene FROM nn UNION ALL SELECT DISTINCT 'reference', transcript_id, coalesce(combo, gene_id) FROM exons LEFT JOIN combo ON g = gene_id WHERE NOT novel")
def metagenes(spark: SparkSession, sf_dir: str) -> DataFrame:
    new, ref = ad.side_tables(spark, sf_dir)
    novel = events.novel_last_exons(None, None, tables=(new, ref), **_OPTIONS).withColumn("ref_gene_id", F.col("gene_id_ref"))
    both = zip(("novel", "reference"), le.metagenes(novel, ref["exons"].select("transcript_id", F.col("gene_id").alias("ref_gene_id")).distinct()), strict=True)
    new, old = (df.select(F.lit(side).alias("side"), "transcript_id", F.col("ref_gene_id").alias("gene")) for side, df in both)
    return new.unionByName(old)


_INFO_COLS = ("gene_name", "event_type", "annot_status", "transcript_id", "chrom", "strand", "s", "e")


@query(f"""WITH {_LE}, many AS (SELECT * FROM le WHERE gene_id IN (SELECT gene_id FROM le GROUP BY gene_id HAVING count(*) > 1)),
info AS (SELECT DISTINCT transcript_id, le_id, gene_id, gene_name, event_type, 'annotated' AS annot_status, chrom, strand, s, e FROM many),
lists AS (SELECT le_id, gene_id, {', '.join(f'list(CAST({c} AS VARCHAR) ORDER BY s, e, gene_id, gene_name, event_type, transcript_id) AS l_{c}' for c in _INFO_COLS)}, (min(s) * 7919 % 9973 + 1) / 9974.0 AS pvalue FROM info GROUP BY le_id, gene_id),
r AS (SELECT le_id, gene_id, pvalue, rank() OVER (ORDER BY pvalue) + count(*) OVER (PARTITION BY pvalue) - 1 AS k, count(*) OVER () AS m FROM lists),
bh AS (SELECT le_id, least(1.0, min(pvalue * m / k) OVER (ORDER BY pvalue DESC RANGE UNBOUNDED PRECEDING)) AS padj FROM r),
g AS (SELECT gene_id, min(pvalue) AS t, count(*) AS n FROM lists GROUP BY gene_id), sz AS (SELECT n, count(*) AS m FROM g GROUP BY n), tt AS (SELECT DISTINCT t FROM g),
gq AS (SELECT tt.t, sum(sz.m * (1 - power(1 - tt.t, sz.n))) AS false_ones FROM tt, sz GROUP BY tt.t), gc AS (SELECT t, count(*) OVER (ORDER BY t RANGE UNBOUNDED PRECEDING) AS upto, gene_id FROM g),
qv AS (SELECT gene_id, least(1.0, false_ones / upto) AS gene_q FROM gc JOIN gq USING (t))
SELECT gene_id, le_id, round(pvalue, 9) AS pvalue, round(padj, 9) AS padj, round(gene_q, 9) AS gene_q, {', '.join(f"array_to_string({_once(f'l_{c}')}, ',') AS {c}" for c in _INFO_COLS)}, CAST(0.25 AS DOUBLE) AS mean_base, CAST(0.5 AS DOUBLE) AS mean_treatment, CAST(0.25 AS DOUBLE) AS delta
FROM lists JOIN bh USING (le_id) JOIN qv USING (gene_id)""")
def annotated_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    info = le.info_table(written(_ref_le(spark, sf_dir), "last-exon-ids"))
    p = info.groupBy("le_id", "gene_id").agg(((F.min("start") * 7919 % 9973 + 1) / 9974.0).alias("pvalue"))
    means = p.select("le_id", "gene_id", F.lit(0.25).alias("mean_base"), F.lit(0.5).alias("mean_treatment"), F.lit(0.25).alias("delta"))
    rows = jobs.annotated_results(jobs.adjusted_results(p), info, means)
    return _renamed(rows.withColumns({c: F.round(c, 9) for c in ("pvalue", "padj", "gene_q")}))


@query("SELECT doc_id, reverse(translate(text, 'ACGTacgt', 'TGCAtgca')) AS rc FROM documents")
def reverse_complements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ad.table(spark, sf_dir, "documents").select("doc_id", reverse_complement(F.col("text")).alias("rc"))


#: A contig for every part, of 32 bases a digest.
_CONTIGS = "g AS (SELECT p_partkey AS p, p_size, 'p' || p_partkey AS chrom, string_agg(translate(md5(p_partkey || ':' || k), '0123456789abcdef', 'AATAACAATAAGTAAC'), '' ORDER BY k) AS seq FROM part, unnest(range(0, p_size % 7 + 1)) AS u(k) GROUP BY p_partkey, p_size)"
_CONTIG_CHUNK = 50


def _contigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The parts' contigs, written as FASTA files and read back by their index."""
    digest = lambda k: F.translate(F.md5(F.concat_ws(":", "p_partkey", k)), "0123456789abcdef", "AATAACAATAAGTAAC")
    seq = F.array_join(F.transform(F.sequence(F.lit(0), F.col("p_size") % 7), digest), "")
    path = fresh_path(spark, "contigs")
    fasta_source.write_fasta(ad.table(spark, sf_dir, "part").select(F.concat(F.lit("p"), "p_partkey").alias("name"), seq.alias("sequence")), path)
    return fasta_source.read_fasta(spark, path, _CONTIG_CHUNK)


@query(f"WITH {_CONTIGS} SELECT chrom, chunk, substr(seq, chunk * {_CONTIG_CHUNK} + 1, {_CONTIG_CHUNK}) AS seq FROM g, unnest(range(0, (length(seq) + {_CONTIG_CHUNK - 1}) // {_CONTIG_CHUNK})) AS u(chunk)")
def fasta_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _contigs(spark, sf_dir)


@query(f"""WITH {_CONTIGS}, r AS (SELECT p, seq, p_size % 20 AS s, least(p_size % 20 + 10 + p % 90, length(seq)) AS e FROM g), q AS (SELECT p, substr(seq, s + 1, e - s) AS f FROM r)
SELECT p AS region, CASE WHEN p % 3 = 0 THEN reverse(translate(f, 'ACGT', 'TGCA')) ELSE f END AS sequence FROM q""")
def fasta_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = ad.table(spark, sf_dir, "part")
    start = (F.col("p_size") % 20).cast("long")
    end = F.least(start + 10 + F.col("p_partkey") % 90, ((F.col("p_size") % 7 + 1) * 32).cast("long"))
    regions = part.select(F.col("p_partkey").alias("region"), F.concat(F.lit("p"), "p_partkey").alias("chrom"), F.when(F.col("p_partkey") % 3 == 0, "-").otherwise("+").alias("strand"), start.alias("start"), end.alias("end"))
    return three_ends.region_sequences(regions, _contigs(spark, sf_dir), "region", _CONTIG_CHUNK).select("region", "sequence")


@query(f"""WITH {_CONTIGS}, q AS (SELECT p, substr(seq, 3, 10) || substr(seq, 16, p % 10 + 1) || CASE WHEN length(seq) > 64 THEN substr(seq, 41, 20 + p % 5) ELSE '' END AS f FROM g)
SELECT 'p' || p AS transcript_id, CASE WHEN p % 3 = 0 THEN reverse(translate(f, 'ACGT', 'TGCA')) ELSE f END AS sequence FROM q""")
def spliced_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    part, p = ad.table(spark, sf_dir, "part"), F.col("p_partkey")
    exon = lambda low, high: F.struct(F.lit(low).cast("long").alias("start"), high.cast("long").alias("end"))
    spans = F.array(exon(2, F.lit(12)), exon(15, 16 + p % 10), F.when(F.col("p_size") % 7 >= 2, exon(40, 60 + p % 5)))
    rows = part.select(F.concat(F.lit("p"), p).alias("transcript_id"), F.concat(F.lit("p"), p).alias("chrom"), F.when(p % 3 == 0, "-").otherwise("+").alias("strand"), F.explode(F.filter(spans, lambda x: x.isNotNull())).alias("x"))
    return fasta.transcript_sequences(rows.select("transcript_id", "chrom", "strand", "x.start", "x.end"), _contigs(spark, sf_dir), _CONTIG_CHUNK)


@query(f"""WITH {_EXONS}, r AS (SELECT chrom, strand, gene_id, gene_name, max(e) AS e FROM exons WHERE chrom <> 'chr3' AND NOT novel AND e - s >= 140 GROUP BY 1, 2, 3, 4)
SELECT n.transcript_id, n.gene_id, n.e, r.e AS e_ref, r.gene_name AS gene_name_ref FROM ends n LEFT JOIN r ON n.chrom = r.chrom AND n.strand = r.strand AND n.gene_id = r.gene_id
WHERE n.novel AND (r.gene_id IS NOT NULL OR NOT EXISTS (SELECT 1 FROM r AS k WHERE k.chrom = n.chrom AND k.strand = n.strand))""")
def merged_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    novel, ref = ad.sides(spark, sf_dir)
    last = structure.exon_intron_tables(novel)["last_exons"].select("transcript_id", "chrom", "strand", "gene_id", "gene_name", "end")
    genes = ref.where("chrom <> 'chr3' and end - start >= 140").groupBy("chrom", "strand", "gene_id", "gene_name").agg(F.max("end").alias("end"))
    out = merge_columns(last, genes, "gene_id", ["end", "gene_name"], "inner", suffixes=("", "_ref"))
    return out.select("transcript_id", "gene_id", F.col("end").alias("e"), F.col("end_ref").alias("e_ref"), "gene_name_ref")


@query(f"WITH {_ISLANDS.format(more='', rows='ends')} SELECT CASE WHEN novel THEN 'novel' ELSE 'reference' END AS origin, transcript_id, chrom || ':' || strand || ':' || cluster_start AS last_exon_id FROM cc")
def combined_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    novel, ref = ad.sides(spark, sf_dir)
    last = lambda df, origin: structure.exon_intron_tables(df)["last_exons"].withColumn("origin", F.lit(origin))
    both = jobs.combine_last_exons([last(novel, "novel").drop("gene_name"), last(ref, "reference")])
    return both.select("origin", "transcript_id", "last_exon_id")


@query(f"WITH {_QUANT} SELECT transcript_id, sample, length, round(tpm, 3) AS tpm, count FROM q")
def quant_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    quant, folder, names = written(ad.quant(spark, sf_dir), "quant"), fresh_path(spark, "quant"), [f"s{k}" for k in range(6)]
    rows = quant.select("sample", F.col("transcript_id").alias("Name"), F.lit(0.0).alias("Length"), F.col("length").alias("EffectiveLength"), F.col("tpm").alias("TPM"), F.col("count").alias("NumReads"))
    for name in names:  # one folder a sample, as quantification leaves them
        rows.where(F.col("sample") == name).drop("sample").write.csv(f"{folder}/{name}/quant.sf", sep="\t", header=True)
    return sheets.read_quant(spark, folder, names).withColumn("tpm", F.round("tpm", 3))


@query("SELECT CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE p_name END AS name, p_partkey AS id, p_retailprice AS price FROM part")
def tables_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ad.table(spark, sf_dir, "part").select(F.when(F.col("p_partkey") % 4 != 0, F.col("p_name")).alias("name"), F.col("p_partkey").alias("id"), F.col("p_retailprice").alias("price"))
    path = fresh_path(spark, "tables")
    genomic.write_table(rows, path)
    return genomic.read_table(spark, path, "name string, id long, price double")


@query("SELECT 'e' || o_custkey % 5 AS experiment_id, o_orderkey AS le_id, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_totalprice END AS delta FROM orders")
def experiments_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ad.table(spark, sf_dir, "orders").select((F.col("o_custkey") % 5).alias("k"), F.col("o_orderkey").alias("le_id"), F.when(F.col("o_orderkey") % 3 != 0, F.col("o_totalprice")).alias("delta"))
    folder = fresh_path(spark, "experiments")
    for k in range(5):
        genomic.write_table(rows.where(F.col("k") == k).drop("k"), f"{folder}/e{k}/results.tsv")
    return genomic.read_experiments(spark, folder, "results.tsv", "le_id long, delta double").select("experiment_id", "le_id", "delta")


@query(f"WITH {_ATLAS} SELECT chrom, strand, s, s + 1 AS e, name FROM atlas")
def bed_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "bed")
    ad.atlas(spark, sf_dir).select(F.concat_ws("\t", "chrom", "start", "end", "name", F.lit("."), "strand").alias("value")).write.text(path)
    return _renamed(genomic.read_bed(spark, path).select("chrom", "strand", "start", "end", "name"))


@query(f"WITH {_EXONS} SELECT transcript_id, gene_id, chrom, strand, s, e FROM exons WHERE s % 3 = 0")
def gtf_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    own, path = ad.exons(spark, sf_dir), fresh_path(spark, "gtf")
    genomic.write_gtf(own.withColumn("feature", F.when(F.col("start") % 3 == 0, "CDS").otherwise("exon")), path, ["gene_id", "transcript_id"])
    return _renamed(genomic.read_gtf(spark, path, ["transcript_id", "gene_id"], feature="CDS").select("transcript_id", "gene_id", "chrom", "strand", "start", "end"))


@query(f"WITH {_REF_TYPES} SELECT transcript_id, CASE WHEN contains(transcript_id, '9') THEN 'last_exon_extension' ELSE event_type END AS event_type FROM ref_types")
def forced_extension_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.reference_event_types(None, "9", tables=ad.ref_tables(spark, sf_dir))


_LINES = "l AS (SELECT l_orderkey % 5000 AS id, l_returnflag AS a, l_linestatus AS b, l_suppkey % 3 AS c, l_partkey AS k, l_linenumber AS n FROM lineitem)"


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ad.table(spark, sf_dir, "lineitem").select((F.col("l_orderkey") % 5000).alias("id"), F.col("l_returnflag").alias("a"), F.col("l_linestatus").alias("b"), (F.col("l_suppkey") % 3).alias("c"), F.col("l_partkey").alias("k"), F.col("l_linenumber").alias("n"))


@query(f"WITH {_LINES} SELECT id FROM l GROUP BY id HAVING len(list_distinct([count(DISTINCT a), count(DISTINCT b), count(DISTINCT c)])) > 2")
def inconsistent_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collapse.inconsistent_ids(_lines(spark, sf_dir), "id", ["a", "b", "c"])


@query(f"WITH {_LINES}, r AS (SELECT *, row_number() OVER (PARTITION BY id, a ORDER BY k, n, b, c) AS rn FROM l) SELECT id, a, b, c, k, n FROM r WHERE rn = 1")
def first_of_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collapse.first_of_duplicates(_lines(spark, sf_dir), ["id", "a"], ["k", "n", "b", "c"])


@query(f"WITH {_LINES} SELECT CAST(count(DISTINCT id) AS BIGINT) AS n FROM l")
def distinct_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collapse.count_ids(_lines(spark, sf_dir), "id")


@query("SELECT o_orderkey AS id, coalesce(CASE WHEN o_orderkey % 3 > 0 THEN CAST(o_custkey AS VARCHAR) END, 'NULL') AS customer FROM orders")
def null_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ad.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.when(F.col("o_orderkey") % 3 > 0, F.col("o_custkey")).alias("customer"))
    return collapse.fill_nulls(rows, ["customer"])


@query(f"WITH {_EVENTS} SELECT transcript_id, gene_id_ref AS ref_gene_id, gene_name_ref AS ref_gene_name FROM novel_le UNION ALL SELECT DISTINCT transcript_id, gene_id, gene_name FROM exons WHERE NOT novel")
def common_genes(spark: SparkSession, sf_dir: str) -> DataFrame:
    new, ref = ad.side_tables(spark, sf_dir)
    novel = events.novel_last_exons(None, None, tables=(new, ref), **_OPTIONS).withColumns({"gene_id": F.concat(F.lit("novel_"), "transcript_id"), "gene_name": F.lit(None).cast("string")})
    cols = ["transcript_id", "gene_id", "gene_name", "gene_id_ref", "gene_name_ref"]
    old = ref["exons"].select("transcript_id", "gene_id", "gene_name").distinct().withColumns({c: F.lit(None).cast("string") for c in cols[3:]})
    return le.common_gene(novel.select(*cols).unionByName(old)).select("transcript_id", "ref_gene_id", "ref_gene_name")


@query(f"WITH {_EXONS} SELECT transcript_id, s, e, strand FROM exons WHERE s % 7 > 0")
def known_strands(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = ad.exons(spark, sf_dir).withColumn("strand", F.when(F.col("start") % 7 > 0, F.col("strand")).when(F.col("start") % 2 == 0, "."))
    return _renamed(stranded(own).select("transcript_id", "start", "end", "strand"))
