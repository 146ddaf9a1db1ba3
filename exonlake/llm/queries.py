"""The queries of this subpackage, each over its whole tables, and SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import best_fit_packing, decontamination, html_extraction, jaccard_join, kneser_ney, periodic_runs, pii, prefix_trie, quality_rules, suffix_dedup, token_rollups, url_filters, warc_revisits
from .store import fresh_path, small_batches


TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc_revisits.resolve_revisits(warc_revisits.page_captures(_read(spark, sf_dir, "pages")))
    return found.select("capture_id", "url_key", F.coalesce("response_id", F.lit(-1)).alias("response_id"), "reason", warc_revisits.header_string(F.col("headers")).alias("headers"))


OP1_SQL = r"""
WITH captures AS (
  SELECT url, page_id * 10 + k AS capture_id, page_id * 1000 + shift AS ts, kind, CASE WHEN changed THEN md5(html || 'v2') ELSE md5(html) END AS digest
  FROM pages, (VALUES (0, 100, 'revisit', false, 5), (1, 600, 'response', false, 1), (2, 1200, 'revisit', false, 1), (3, 9000, 'response', true, 4), (4, 9600, 'revisit', false, 12)) AS v(k, shift, kind, changed, every)
  WHERE page_id % every = 0
), cut AS (
  SELECT *, regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS rest FROM captures
), parts AS (
  SELECT *, regexp_replace(regexp_replace(lower(regexp_extract(rest, '^[^/?]*', 0)), '^www\.', ''), ':(80|443)$', '') AS host,
    regexp_replace(regexp_extract(rest, '^[^/?]*([^?]*)', 1), '/+$', '') AS path,
    list_sort(list_filter(string_split(regexp_extract(rest, '\?(.*)$', 1), '&'), lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_[a-z]+|ref|fbclid|gclid)(=|$)'))) AS query
  FROM cut
), keyed AS (
  SELECT *, host || path || CASE WHEN len(query) > 0 THEN '?' || array_to_string(query, '&') ELSE '' END AS url_key FROM parts
), found AS (
  SELECT *, last_value(CASE WHEN kind = 'response' THEN {'id': capture_id, 'digest': digest} END IGNORE NULLS) OVER (PARTITION BY url_key ORDER BY ts, capture_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS f
  FROM keyed
)
SELECT capture_id, url_key, CASE WHEN f.digest = digest THEN f.id ELSE -1 END AS response_id,
  CASE WHEN f IS NULL THEN 'no-response' WHEN f.digest = digest THEN 'resolved' ELSE 'mismatch' END AS reason,
  CASE WHEN f.digest = digest THEN 'content-type=text/html;date=d2;etag=' || substr(digest, 1, 16) || ';expires=e2' END AS headers
FROM found WHERE kind = 'revisit'
"""


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(_read(spark, sf_dir, "documents")).drop("kept")


def op3_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kneser_ney.classify(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules.quality_rules(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.leaks(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark")).where("leaked").drop("leaked", "cosine")


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit_packing.pack(_read(spark, sf_dir, "documents"), TOKENIZER)


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _read(spark, sf_dir, "pages")
    return html_extraction.main_text(pages, html_extraction.fit_labeller(pages))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    return pii.find_pii(docs, pii.fit_field(docs))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_classes(_read(spark, sf_dir, "documents"))


def op10_token_rollups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents are inserted, every seventh is revised to half its words, every eleventh is deleted, and one batch is sent again."""
    docs = _read(spark, sf_dir, "documents")
    rollup = token_rollups.Rollup(spark, fresh_path(spark, "op10-store"))
    words, revise, delete = "words-1", F.col("doc_id") % 7 == 3, F.col("doc_id") % 11 == 5
    half = F.floor(F.col("old") / 2)
    some = docs.where(revise).select("source", "lang", F.lit(words).alias("version"), token_rollups.token_count(F.col("text"), words).alias("old")).withColumn("new", half)
    gone = docs.where(delete)
    now = gone.select("source", "lang", F.lit(words).alias("version"), token_rollups.token_count(F.col("text"), words).alias("old"), revise.alias("_r"))
    now = now.select("source", "lang", "version", F.when(F.col("_r"), half).otherwise(F.col("old")).alias("tokens"))
    rollup.commit("1", token_rollups.signed(token_rollups.counted(docs), 1))
    rollup.commit("2", token_rollups.revised(some))
    rollup.commit("3", token_rollups.signed(now.unionByName(token_rollups.counted(gone, ("pieces-2",))), -1))
    rollup.commit("2", token_rollups.revised(some))
    return rollup.totals()


OP10_SQL = r"""
WITH counts AS (
  SELECT doc_id, source, lang, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS words, coalesce(len(regexp_extract_all(text, '[\p{L}\p{N}]+|[^\p{L}\p{N}\x20\x09-\x0D]')), 0) AS pieces
  FROM documents WHERE doc_id % 11 <> 5 OR doc_id IS NULL
)
SELECT source, lang, 'words-1' AS version, count(*) AS docs, sum(CASE WHEN doc_id % 7 = 3 THEN words // 2 ELSE words END)::BIGINT AS tokens FROM counts GROUP BY source, lang
UNION ALL
SELECT source, lang, 'pieces-2', count(*), sum(pieces)::BIGINT FROM counts GROUP BY source, lang
"""


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(_read(spark, sf_dir, "conversations"))


OP11_SQL = r"""
WITH turns AS (
  SELECT conv_id, list({'role': coalesce(role, ''), 'text': coalesce(text, '')} ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS t FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), crc AS (
  SELECT conv_id, t, xor(list_reduce(list_transform(string_split(conv_id::VARCHAR, ''), lambda ch: ord(ch)::UBIGINT),
    lambda acc, ch: list_reduce([xor(acc, ch), 0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[], lambda v, z: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384::UBIGINT) ELSE v >> 1 END), 4294967295::UBIGINT), 4294967295::UBIGINT) % 4 AS h
  FROM turns
), rebuilt AS (
  SELECT c.conv_id, list_concat(coalesce(b.t[1:c.h], []), c.t[c.h + 1:]) AS t FROM crc AS c LEFT JOIN turns AS b ON b.conv_id = c.conv_id - c.conv_id % 20
), pre AS (
  SELECT conv_id, d, t[1:d] AS node, CASE WHEN d > 0 THEN t[1:d - 1] END AS parent, len(t) = d AS ends, CASE WHEN d > 0 THEN len(regexp_extract_all(t[d].text, '[^\x20\x09-\x0D]+')) ELSE 0 END AS words
  FROM rebuilt, unnest(range(0, len(t) + 1)) AS u(d)
), nodes AS (
  SELECT node, any_value(d)::BIGINT AS depth, any_value(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words)::BIGINT AS words,
    sha256(coalesce(string_agg(CASE WHEN ends THEN conv_id::VARCHAR END, ',' ORDER BY conv_id), '')) AS ends_sha256 FROM pre GROUP BY node
), kids AS (SELECT parent, count(*) AS n_children FROM nodes WHERE parent IS NOT NULL GROUP BY parent
), own AS (
  SELECT n.*, coalesce(k.n_children, 0) AS n_children, (n_convs - 1) * words AS saved FROM nodes AS n LEFT JOIN kids AS k ON k.parent = n.node
), subtree AS (
  SELECT p.node, sum((o.n_children = 0)::BIGINT)::BIGINT AS n_leaves, sum(o.saved)::BIGINT AS saved_tokens FROM own AS o JOIN pre AS p ON p.conv_id = o.conv_id AND p.d <= o.depth GROUP BY p.node
)
SELECT o.conv_id, o.depth, q.conv_id AS parent_conv_id, o.n_convs, o.n_children, s.n_leaves, s.saved_tokens, o.ends_sha256
FROM own AS o JOIN subtree AS s ON s.node = o.node LEFT JOIN nodes AS q ON q.node = o.parent
"""


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.periodic_runs(_read(spark, sf_dir, "documents"))


def op13_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _read(spark, sf_dir, "pages")
    return url_filters.judge(pages, url_filters.weak_outcomes(pages))


OP13_SQL = r"""
WITH cut AS (
  SELECT page_id, html, url, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), own AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
    (coalesce(regexp_matches(lower(url), '(^|[^a-z])(ads|adult|bet|bets|betting|casino|escort|pills|poker|porn|spam|viagra|xxx)([^a-z]|$)'), false) OR coalesce(regexp_matches(lower(html), '(^|[^a-z])(casino|escort|porn|viagra)([^a-z]|$)'), false))::INT AS bad
  FROM cut
), counted AS (
  SELECT host, count(*) AS n, sum(bad) AS k, regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', '') AS name FROM own GROUP BY host
), hosts AS (
  SELECT host, n, k, CASE WHEN regexp_matches(name, '^[0-9.]*$|[\[\]]') THEN name ELSE array_to_string(string_split(name, '.')[-(CASE WHEN length(string_split(name, '.')[-1]) = 2 AND coalesce(string_split(name, '.')[-2], string_split(name, '.')[-1]) IN ('ac', 'co', 'com', 'edu', 'gov', 'net', 'org') THEN least(3, len(string_split(name, '.'))) ELSE least(2, len(string_split(name, '.'))) END):], '.') END AS domain FROM counted
), h AS (
  SELECT *, CASE WHEN regexp_matches(domain, '^[0-9.]*$|[\[\]]') THEN '' WHEN instr(domain, '.') > 0 THEN regexp_replace(domain, '^[^.]*\.', '') ELSE domain END AS suffix FROM hosts
), d AS (SELECT domain, suffix, sum(n) AS n, sum(k) AS k FROM h GROUP BY domain, suffix
), s AS (SELECT suffix, sum(n) AS n, sum(k) AS k FROM d GROUP BY suffix
), sm AS (SELECT s.*, (t.k - s.k + 0.5) / (t.n - s.n + 1.0) AS m FROM s, (SELECT sum(n) AS n, sum(k) AS k FROM s) AS t
), s1 AS (SELECT sum((k - n * m) * (k - n * m) - n * m * (1 - m)) AS spare, sum(n * m * (1 - m) * (n - 1)) AS room FROM sm
), z1 AS (SELECT CASE WHEN coalesce(room, 0) = 0 OR spare <= 0 THEN 1000.0 ELSE round(least(greatest(room / spare - 1, 2.0), 1000.0), 6) END AS z FROM s1
), dm AS (SELECT d.*, (sm.k - d.k + z * sm.m) / (sm.n - d.n + z) AS m FROM d JOIN sm USING (suffix), z1
), s2 AS (SELECT sum((k - n * m) * (k - n * m) - n * m * (1 - m)) AS spare, sum(n * m * (1 - m) * (n - 1)) AS room FROM dm
), z2 AS (SELECT CASE WHEN coalesce(room, 0) = 0 OR spare <= 0 THEN 1000.0 ELSE round(least(greatest(room / spare - 1, 2.0), 1000.0), 6) END AS z FROM s2
), hm AS (SELECT h.*, (dm.k - h.k + z * dm.m) / (dm.n - h.n + z) AS m FROM h JOIN dm USING (domain), z2
), s3 AS (SELECT sum((k - n * m) * (k - n * m) - n * m * (1 - m)) AS spare, sum(n * m * (1 - m) * (n - 1)) AS room FROM hm
), z3 AS (SELECT CASE WHEN coalesce(room, 0) = 0 OR spare <= 0 THEN 1000.0 ELSE round(least(greatest(room / spare - 1, 2.0), 1000.0), 6) END AS z FROM s3
), post AS (SELECT host, k + z * m AS a, n - k + z * (1 - m) AS b FROM hm, z3
), rep AS (SELECT host, a / (a + b) - 1.645 * sqrt(a / (a + b) * (1 - a / (a + b)) / (a + b + 1)) > 0.5 AS blocked FROM post
), rules AS (SELECT * FROM (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')) AS v(kind, of_host, begins)
), fit AS (
  SELECT page_id, host, path, max_by(of_host || begins, length(of_host || begins)) AS rule, max_by(kind, length(of_host || begins)) AS kind
  FROM (SELECT DISTINCT page_id, host, path FROM own) LEFT JOIN rules ON (host = of_host OR ends_with(host, '.' || of_host)) AND starts_with(path, begins) GROUP BY page_id, host, path
)
SELECT own.page_id, own.host, own.path, fit.rule, coalesce(fit.kind, CASE WHEN rep.blocked THEN 'block' ELSE 'allow' END) AS verdict
FROM own JOIN fit ON own.page_id IS NOT DISTINCT FROM fit.page_id AND own.host = fit.host AND own.path = fit.path LEFT JOIN rep ON own.host = rep.host
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_warc_revisits, op2_suffix_dedup, op3_kneser_ney, op4_quality_rules, op5_decontamination, op6_best_fit_packing, op7_html_extraction, op8_pii, op9_jaccard_join, op10_token_rollups, op11_prefix_trie, op12_periodic_runs, op13_url_filters)}


def oracle_sql() -> dict[str, str]:
    return {"op1_warc_revisits": OP1_SQL, "op10_token_rollups": OP10_SQL, "op11_prefix_trie": OP11_SQL, "op13_url_filters": OP13_SQL}
