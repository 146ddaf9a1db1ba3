"""Not-modified revisits of web captures, resolved to the latest earlier full response.

Captures are (capture_id, url, ts, kind, status, digest, etag, headers).  A revisit takes
the latest ``response`` of its canonical URL with an earlier ts (of equal ts, the smaller
capture_id is earlier).  Its validators are checked: the entity tags must be equal where
both have one, else the payload digests where both have one; the merged headers are the
response's, replaced or joined by those of the revisit that a 304 may update.

The as-of search has two levels, so that a URL with a third of all captures is not one
task: within (URL, time bucket) by a window, and across buckets by a window over the last
response of each bucket only, which is grouped beforehand.

Defined cases: a null or empty url has no canonical form and resolves to nothing (reason
``no-url``); a null ts is earlier than all others; null headers are empty; repeated
captures are each resolved; without an earlier response the reason is ``no-response``; a
validator that differs, or none to compare, gives ``mismatch`` or ``unverified`` and no
merge; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

#: Header fields that a not-modified answer may update.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")
#: Query parameters that name no other page.
TRACKING = "utm_[a-z]+|ref|fbclid|gclid"
BUCKET_SECONDS = 3600


def canonical_url(url: Column) -> Column:
    """Scheme and fragment dropped, host lower-cased without www. and port 80 or 443, no tracking parameters, the rest sorted, no last slash."""
    rest = F.regexp_replace(F.regexp_replace(F.trim(url), "#.*$", ""), "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.regexp_replace(F.regexp_replace(F.lower(F.regexp_extract(rest, "^[^/?]*", 0)), "^www\\.", ""), ":(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(rest, "^[^/?]*([^?]*)", 1), "/+$", "")
    query = F.array_sort(F.filter(F.split(F.regexp_extract(rest, "\\?(.*)$", 1), "&"), lambda p: (p != "") & ~p.rlike(f"^({TRACKING})(=|$)")))
    whole = F.concat(host, path, F.when(F.size(query) > 0, F.concat(F.lit("?"), F.array_join(query, "&"))).otherwise(""))
    return F.when(F.length(whole) > 0, whole)


def resolve_revisits(captures: DataFrame, bucket_seconds: int = BUCKET_SECONDS) -> DataFrame:
    """capture_id, url_key, response_id, reason, headers of every revisit; headers is null unless reason is ``resolved``."""
    own = captures.select("capture_id", canonical_url(F.col("url")).alias("url_key"), F.coalesce(F.col("ts").cast("long"), F.lit(-(1 << 62))).alias("ts"), "kind", "digest", "etag", F.coalesce("headers", F.create_map().cast("map<string,string>")).alias("headers"))
    own = own.withColumn("bucket", F.floor(F.col("ts") / bucket_seconds))
    response = F.when(F.col("kind") == "response", F.struct("ts", "capture_id", "digest", "etag", "headers"))
    keyed = own.where("url_key is not null").withColumn("_r", response)
    before = Window.partitionBy("url_key", "bucket").orderBy("ts", "capture_id").rowsBetween(Window.unboundedPreceding, -1)
    near = keyed.withColumn("_near", F.last("_r", ignorenulls=True).over(before)).where("kind = 'revisit'")
    # max_by and not max: structs with maps have no order
    lasts = keyed.where("_r is not null").groupBy("url_key", "bucket").agg(F.max_by("_r", F.struct("ts", "capture_id")).alias("_last"))
    spots = keyed.where("kind = 'revisit'").select("url_key", "bucket").distinct().join(lasts, ["url_key", "bucket"], "full")
    upto = Window.partitionBy("url_key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    far = spots.withColumn("_far", F.last("_last", ignorenulls=True).over(upto)).select("url_key", "bucket", "_far")
    found = near.join(far, ["url_key", "bucket"], "left").withColumn("_f", F.coalesce("_near", "_far")).drop("_near", "_far", "_r")
    lost = own.where("url_key is null and kind = 'revisit'").withColumn("_f", F.lit(None).cast(found.schema["_f"].dataType))
    found = found.unionByName(lost.select(*found.columns))
    same = F.when(F.col("etag").isNotNull() & F.col("_f.etag").isNotNull(), F.col("etag") == F.col("_f.etag")).when(F.col("digest").isNotNull() & F.col("_f.digest").isNotNull(), F.col("digest") == F.col("_f.digest"))
    reason = F.when(F.col("url_key").isNull(), "no-url").when(F.col("_f").isNull(), "no-response").when(same, "resolved").when(~same, "mismatch").otherwise("unverified")
    allowed = F.array(*map(F.lit, PERMITTED))
    update = F.map_filter("headers", lambda k, v: F.array_contains(allowed, F.lower(k)) & v.isNotNull())
    names = F.transform(F.map_keys(update), F.lower)
    merged = F.map_concat(F.map_filter("_f.headers", lambda k, v: ~F.array_contains(names, F.lower(k))), update)
    return found.select("capture_id", "url_key", F.when(reason == "resolved", F.col("_f.capture_id")).alias("response_id"), reason.alias("reason"), F.when(reason == "resolved", merged).alias("headers"))


def header_string(headers: Column) -> Column:
    """Headers as name=value by name, joined by semicolons."""
    return F.array_join(F.array_sort(F.transform(F.map_entries(headers), lambda e: F.concat(F.lower(e["key"]), F.lit("="), e["value"]))), ";")


def page_captures(pages: DataFrame) -> DataFrame:
    """A capture log of the pages table: every page is a response at minute 10 of a time of its own, and is visited again.

    Every page is revisited ten minutes later, unchanged; every fifth was visited before its
    response already; every fourth is then changed, and every third of those is revisited with
    its old validators.
    """
    base = F.col("page_id") * 1000
    old, new = F.md5("html"), F.md5(F.concat("html", F.lit("v2")))
    full = lambda tag: F.create_map(F.lit("content-type"), F.lit("text/html"), F.lit("etag"), tag, F.lit("date"), F.lit("d1"))
    brief = lambda tag: F.create_map(F.lit("content-type"), F.lit("none"), F.lit("etag"), tag, F.lit("date"), F.lit("d2"), F.lit("expires"), F.lit("e2"))
    one = lambda k, shift, kind, tag, when, headers: F.when(when, F.struct((F.col("page_id") * 10 + k).alias("capture_id"), (base + shift).alias("ts"), F.lit(kind).alias("kind"), tag.alias("digest"), F.substring(tag, 1, 16).alias("etag"), headers.alias("headers")))
    log = F.array(
        one(0, 100, "revisit", old, F.col("page_id") % 5 == 0, brief(F.substring(old, 1, 16))),
        one(1, 600, "response", old, F.lit(True), full(F.substring(old, 1, 16))),
        one(2, 1200, "revisit", old, F.lit(True), brief(F.substring(old, 1, 16))),
        one(3, 9000, "response", new, F.col("page_id") % 4 == 0, full(F.substring(new, 1, 16))),
        one(4, 9600, "revisit", old, (F.col("page_id") % 12) == 0, brief(F.substring(old, 1, 16))),
    )
    return pages.select("url", F.explode(F.filter(log, lambda c: c.isNotNull())).alias("c")).select("url", "c.*")
