"""URL filters: rules for hosts and paths, and beyond them an empirical-Bayes reputation of hosts.

A page's url is judged by the longest rule that fits; without one, by its host.  A host's
share of bad pages has a beta prior from the other hosts of its registered domain, whose
share has one from the other domains of its suffix, and that one from the other suffixes, so
that no host, domain or suffix counts in its own prior.  The strengths of the three priors
are fitted to all outcomes by the moments of the beta-binomial.  A host is blocked if the
lower bound of its posterior share is above a threshold: few outcomes block nothing, and a
new host of a bad domain needs less evidence than one of a good domain.

All of it is DataFrame functions.  Outcomes are counted per host before anything else, so a
host with a third of all pages is a row; pages meet the verdicts of their hosts by
join_counted, which deals hot hosts out.

Defined cases: a null url, or one without ``://``, has an empty host and path, and the empty
host is judged like any other; repeated pages count and are judged each; a page without an
outcome is judged by its host's; a null page_id or outcome is no outcome; a host without
outcomes has its prior only; empty tables give an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .hotjoin import join_counted
from .store import written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: (verdict, host, path).
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/"))
#: Rules are one expression; more than these are an error.
MAX_RULES = 1000
#: Second-level names under which countries register domains.
SECOND_LEVEL = ("ac", "co", "com", "edu", "gov", "net", "org")
#: Words of a url, and of a page's markup, that make its outcome bad.
URL_WORDS = ("ads", "adult", "bet", "bets", "betting", "casino", "escort", "pills", "poker", "porn", "spam", "viagra", "xxx")
PAGE_WORDS = ("casino", "escort", "porn", "viagra")
#: The bound is so many standard deviations below the mean, and blocks above this share.
BOUND_Z = 1.645
BLOCK_SHARE = 0.5
#: Range of the strengths of priors, in outcomes.
MIN_STRENGTH, MAX_STRENGTH = 2.0, 1000.0


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    return F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def registered_domain(host: Column) -> Column:
    """The last two labels, or three under a second-level name of a country; port and user dropped, numeric addresses whole."""
    name = F.regexp_replace(F.regexp_replace(host, "^.*@", ""), ":[0-9]*$", "")
    labels = F.split(name, "\\.")
    country = (F.length(F.element_at(labels, -1)) == 2) & F.element_at(labels, F.when(F.size(labels) > 1, -2).otherwise(-1)).isin(*SECOND_LEVEL)
    keep = F.when(country, 3).otherwise(2)
    return F.when(name.rlike("^[0-9.]*$|[\\[\\]]"), name).otherwise(F.array_join(F.slice(labels, -F.least(keep, F.size(labels)), keep), "."))


def suffix(domain: Column) -> Column:
    """The domain without its first label; a domain of one label is its own."""
    return F.when(domain.rlike("^[0-9.]*$|[\\[\\]]"), "").when(F.instr(domain, ".") > 0, F.regexp_replace(domain, "^[^.]*\\.", "")).otherwise(domain)


def fitting_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits; of equal ones the first listed."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules, at most {MAX_RULES}")
    text = verdict = F.lit(None).cast("string")
    for kind, of, begin in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == of) | host.endswith(f".{of}")) & path.startswith(begin)
        text, verdict = F.when(fits, of + begin).otherwise(text), F.when(fits, kind).otherwise(verdict)
    return text, verdict


def weak_outcomes(pages: DataFrame) -> DataFrame:
    """(url, bad) of every page: bad is 1 if the url has one of URL_WORDS as a word, or the whole markup one of PAGE_WORDS."""
    has = lambda c, words: F.coalesce(F.lower(c).rlike(f"(^|[^a-z])({'|'.join(words)})([^a-z]|$)"), F.lit(False))
    return pages.select("url", (has("url", URL_WORDS) | has("html", PAGE_WORDS)).cast("int").alias("bad"))


def _strength(children: DataFrame) -> float:
    """Strength of the prior of a level's rows (n, k, m), by moments: the more the rows differ beyond chance, the weaker."""
    n, k, m = F.col("n"), F.col("k"), F.col("m")
    chance = n * m * (1 - m)
    spare, room = children.agg(F.sum((k - n * m) * (k - n * m) - chance), F.sum(chance * (n - 1))).first()
    if not room or spare <= 0:
        return MAX_STRENGTH
    return round(min(max(room / spare - 1, MIN_STRENGTH), MAX_STRENGTH), 6)


def host_reputation(outcomes: DataFrame, z: float = BOUND_Z, block_share: float = BLOCK_SHARE) -> DataFrame:
    """host, n and bad outcomes, the mean of its posterior share, its lower bound, and whether that blocks it; one row a host."""
    host, _ = host_and_path(F.col("url"))
    hosts = outcomes.where("bad is not null").groupBy(host.alias("host")).agg(F.count("*").alias("n"), F.sum(F.col("bad").cast("long")).alias("k"))
    hosts = written(hosts.withColumn("domain", registered_domain(F.col("host"))).withColumn("suffix", suffix(F.col("domain"))), "op13-hosts")
    up = lambda df, key, *more: df.groupBy(key, *more).agg(F.sum("n").alias("n"), F.sum("k").alias("k"), F.count("*").alias("_rows"))
    domains = written(up(hosts, "domain", "suffix"), "op13-domains")
    suffixes = written(up(domains, "suffix"), "op13-suffixes")
    n, k, n_domains = suffixes.agg(*(F.coalesce(F.sum(c), F.lit(0)) for c in ("n", "k", "_rows"))).first()
    n_hosts = domains.agg(F.coalesce(F.sum("_rows"), F.lit(0))).first()[0]
    level = suffixes.withColumn("m", (k - F.col("k") + 0.5) / (n - F.col("n") + 1.0))
    for children, key, total, name in ((domains, "suffix", n_domains, "domain"), (hosts, "domain", n_hosts, "host")):
        strength = _strength(level)
        above = level.select(key, F.col("n").alias("_n"), F.col("k").alias("_k"), F.col("m").alias("_m"), F.col("_rows").alias("_of"))
        own = join_counted(children, above, key, "_of", total, name)
        level = written(own.withColumn("m", (F.col("_k") - F.col("k") + strength * F.col("_m")) / (F.col("_n") - F.col("n") + strength)).drop("_n", "_k", "_m", "_of"), f"op13-{name}-priors")
    strength = _strength(level)
    a, b = F.col("k") + strength * F.col("m"), F.col("n") - F.col("k") + strength * (1 - F.col("m"))
    out = level.withColumns({"_a": a, "_b": b})
    mean = F.col("_a") / (F.col("_a") + F.col("_b"))
    bound = mean - z * F.sqrt(mean * (1 - mean) / (F.col("_a") + F.col("_b") + 1))
    return out.select("host", "n", F.col("k").alias("bad"), mean.alias("mean"), bound.alias("bound"), (bound > block_share).alias("blocked"))


def judge(pages: DataFrame, outcomes: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, **options) -> DataFrame:
    """page_id, host, path, the rule that fits or null, and verdict, of every page."""
    host, path = host_and_path(F.col("url"))
    own = pages.select("page_id", "url").select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = fitting_rule(F.col("host"), F.col("path"), rules)
    own = own.withColumns({"rule": rule, "_verdict": verdict})
    sizes = own.where("rule is null").groupBy("host").agg(F.count("*").alias("_pages"))
    known = host_reputation(outcomes, **options).select("host", "blocked")
    known = written(sizes.join(known, "host", "left").withColumnRenamed("host", "_host"), "op13-verdicts")
    open_rows = own.withColumn("_host", F.when(F.col("rule").isNull(), F.col("host")))
    total = known.agg(F.coalesce(F.sum("_pages"), F.lit(0))).first()[0]
    found = join_counted(open_rows, known, "_host", "_pages", total, "page_id")
    return found.select("page_id", "host", "path", "rule", F.coalesce("_verdict", F.when(F.col("blocked"), "block").otherwise("allow")).alias("verdict"))
