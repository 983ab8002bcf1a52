"""URL filter: fixed rules first, then the reputation of the host.

A host's rate of bad pages is estimated by empirical Bayes. Labelled pages are
counted per host, registered domain and suffix; each level's estimate is
shrunk towards the level above it through a beta prior with that mean, whose
strength is fitted to the spread of the level's rates (method of moments). A
page is blocked when the lower bound of its host's posterior bad rate is above
the limit; a host without labelled pages has its domain's or suffix's
posterior, a url without host the overall one.

Defined cases: null urls, and urls without ``://``, have empty host and path;
of contradicting labels for one page the worse counts; repeated pages are
judged each but lend one outcome per row; with no labels all hosts are
allowed; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

# Bounds of the fitted prior strengths, in pages.
WEAKEST, STRONGEST = 1.0, 1000.0
# Second-level names under which country domains register.
SECOND_LEVEL = ("ac", "co", "com", "edu", "gov", "net", "org")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_verdict(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, nulls if none does.

    ``rules`` are (verdict, ``host/path``). Few and fixed, so one expression.
    """
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, text in sorted(rules, key=lambda r: len(r[1])):  # the longest last, on top
        name, _, rest = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + rest)
        rule = F.when(fits, F.lit(text)).otherwise(rule)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def _labels_of(host: Column) -> Column:
    bare = F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r":[0-9]*$", "")
    return F.split(bare, r"\.")


def levels(host: Column) -> tuple[Column, Column]:
    """(registered domain, suffix) of a host: the suffix is the last label, or the
    last two under a country domain such as ``co.uk``."""
    parts = _labels_of(host)
    n = F.size(parts)
    two = (n >= 3) & (F.length(F.element_at(parts, -1)) == 2) & F.try_element_at(parts, F.lit(-2)).isin(*SECOND_LEVEL)
    size = F.when(two, 2).otherwise(1)
    tail = lambda k: F.array_join(F.slice(parts, F.greatest(n - k + 1, F.lit(1)), k), ".")
    return tail(size + 1), tail(size)


def _strength(groups: DataFrame) -> float:
    """Prior strength by the method of moments: how far the labelled groups'
    rates spread around their prior means, beyond binomial noise. One row."""
    p, n = F.col("prior"), F.col("n")
    r = groups.where("n > 0").agg(
        F.sum(n * p * (1 - p)).alias("noise"), F.sum(n * F.pow(F.col("bad") / n - p, 2)).alias("spread"),
        F.sum(n).alias("total"), F.count("*").alias("groups")).first()
    if not r.groups or r.total == r.groups or not r.noise:
        return WEAKEST
    rho = (r.spread * r.total / r.noise - r.groups) / (r.total - r.groups)
    return round(1 / min(max(rho, 1 / (STRONGEST + 1)), 1 / (WEAKEST + 1)) - 1, 6)


def _shrunk(groups: DataFrame, k: float) -> DataFrame:
    """Adds the mean of the beta posterior of ``n, bad`` under prior mean ``prior``."""
    return groups.withColumn("mean", (F.col("bad") + k * F.col("prior")) / (F.col("n") + k))


def reputation(pages: DataFrame, z: float = 1.645) -> DataFrame:
    """``host, n, bad, mean, low`` of every host, from ``host, bad`` rows (bad 1, 0 or null: no label).

    Counts are summed before any shuffle, so a host with a third of all pages
    is one row per task. The overall rate and the three strengths are one-row
    aggregates.
    """
    domain, suffix = levels(F.col("host"))
    hosts = materialize(pages.groupBy("host").agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
                        .withColumns({"domain": domain, "suffix": suffix}), "hosts")
    total = hosts.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).first()
    overall = ((total.bad or 0) + 0.5) / ((total.n or 0) + 1)
    counts = (F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    suffixes = hosts.groupBy("suffix").agg(*counts).withColumn("prior", F.lit(overall))
    suffixes = _shrunk(suffixes, _strength(suffixes))
    domains = hosts.groupBy("domain", "suffix").agg(*counts).join(
        suffixes.select("suffix", F.col("mean").alias("prior")), "suffix")
    domains = _shrunk(domains, _strength(domains))
    hosts = hosts.join(domains.select("domain", F.col("mean").alias("prior")), "domain")
    k = _strength(hosts)
    a, b = F.col("bad") + k * F.col("prior"), F.col("n") - F.col("bad") + k * (1 - F.col("prior"))
    deviation = F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))
    return _shrunk(hosts, k).withColumn("low", F.col("mean") - z * deviation).select("host", "n", "bad", "mean", "low")


def judge(pages: DataFrame, outcomes: DataFrame, rules: list[tuple[str, str]], limit: float = 0.3) -> DataFrame:
    """``page_id, host, path, rule, verdict, bad_rate`` of every page.

    ``outcomes`` has ``page_id, bad``. The join that brings a host's estimate to
    its pages may be split by Spark where one host has a large share of them.
    """
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    urls = pages.select("page_id", F.col("url").cast("string").alias("url")) \
        .select("page_id", host.alias("host"), path.alias("path"))
    worst = outcomes.groupBy("page_id").agg(F.max("bad").alias("bad"))
    hosts = reputation(urls.select("page_id", "host").join(worst, "page_id", "left").select("host", "bad"))
    rule, verdict = rule_verdict(F.col("host"), F.col("path"), rules)
    by_host = F.when(F.col("low") > limit, F.lit("block")).otherwise(F.lit("allow"))
    return urls.join(hosts, "host", "left").select(
        "page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, by_host).alias("verdict"),
        F.round("mean", 6).alias("bad_rate"))
