"""URL filter: explicit rules first, then empirical-Bayes host reputation.

Labelled page outcomes are counted per host, registered domain and suffix.
Each level's rate is shrunk towards its parent's through a beta-binomial
prior: suffix towards the global rate, domain towards its suffix, host towards
its domain.  A level's prior strength is estimated from all its groups by the
method of moments (one number per level), so well observed hosts speak for
themselves and unseen hosts inherit their domain's reputation.  A page is
allowed when the lower posterior bound of its host (mean - z standard
deviations) reaches ``threshold``.

Everything is DataFrame aggregates and equi-joins.  Counts are pre-aggregated
per host before any level is formed, so a host with a third of all pages is
one row afterwards.

Null or scheme-less urls have empty host and path and are judged by the
method (host, domain and suffix ''), never by a rule.  Null outcomes do not
count; repeated ids with different outcomes count as their largest.  Without
any outcome the global rate is 0.5.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# (verdict, host, path prefix): a rule fits its host and all subdomains
RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def with_parts(df: DataFrame, url: str = "url") -> DataFrame:
    """Add host, path, domain (last two labels) and suffix (last label)."""
    u = F.col(url)
    at = F.instr(u, "://")
    rest = F.when(at > 0, F.expr(f"substring(`{url}`, instr(`{url}`, '://') + 3)")).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return (df.withColumn("host", F.coalesce(host, F.lit(""))).withColumn("path", F.coalesce(path, F.lit("")))
            .withColumn("domain", F.substring_index("host", ".", -2)).withColumn("suffix", F.substring_index("host", ".", -1)))


def rule_columns(rules=RULES):
    """(rule, verdict) of the longest fitting rule as columns, null if none fits."""
    rule = verdict = None
    for v, host, path in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        rule = F.when(fits, host + path) if rule is None else rule.when(fits, host + path)
        verdict = F.when(fits, v) if verdict is None else verdict.when(fits, v)
    return rule, verdict


def _strength(groups: DataFrame, p: float) -> float:
    """Beta-binomial prior strength of one level by the method of moments, in [2, 200]."""
    r = groups.agg(F.count("*").alias("g"), F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("n2"),
                   F.sum((F.col("y") - F.col("n") * p) * (F.col("y") - F.col("n") * p) / F.col("n")).alias("s")).first()
    if not r["g"] or r["g"] < 2:
        return 20.0
    free = r["g"] - 1
    room = r["n"] - r["n2"] / r["n"] - free
    if room <= 0 or not 0 < p < 1:
        return 20.0
    rho = (r["s"] / (p * (1 - p)) - free) / room
    return 1 / min(max(rho, 1 / 201), 1 / 3) - 1


def reputation(outcomes: DataFrame, z: float = 1.645):
    """Fit on (host, domain, suffix, y): returns a function adding ``bound`` to frames with those columns."""
    hosts = outcomes.groupBy("host", "domain", "suffix").agg(F.count("*").alias("n"), F.sum("y").alias("y"))
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("y").alias("y"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("y").alias("y"))
    total = suffixes.agg(F.sum("n").alias("n"), F.sum("y").alias("y")).first()
    p = total["y"] / total["n"] if total["n"] else 0.5
    ks, kd, kh = _strength(suffixes, p), _strength(domains, p), _strength(hosts, p)

    def rename(df, tag):
        return df.withColumnRenamed("n", f"n_{tag}").withColumnRenamed("y", f"y_{tag}")

    def level(tag, k, prior):
        n, y = F.coalesce(f"n_{tag}", F.lit(0)), F.coalesce(f"y_{tag}", F.lit(0))
        return (y + k * prior) / (n + k)

    def apply(df: DataFrame) -> DataFrame:
        j = (df.join(rename(hosts.drop("domain", "suffix"), "h"), "host", "left")
             .join(rename(domains.drop("suffix"), "d"), "domain", "left")
             .join(rename(suffixes, "s"), "suffix", "left"))
        mean = level("h", kh, level("d", kd, level("s", ks, F.lit(p))))
        j = j.withColumn("mean", mean)
        weight = F.coalesce("n_h", F.lit(0)) + kh
        bound = F.col("mean") - z * F.sqrt(F.col("mean") * (1 - F.col("mean")) / (weight + 1))
        return j.withColumn("bound", bound)
    return apply


def judge(pages: DataFrame, labels: DataFrame, threshold: float = 0.7, z: float = 1.645, rules=RULES) -> DataFrame:
    """page_id, host, path, rule, verdict (and the posterior mean and bound) of every page."""
    urls = with_parts(pages.select("page_id", F.col("url").cast("string")))
    y = (labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
         .groupBy("doc_id").agg(F.max("quality").cast("long").alias("y")))
    outcomes = urls.join(y, urls["page_id"] == y["doc_id"]).select("host", "domain", "suffix", "y")
    scored = reputation(outcomes, z)(urls)
    rule, verdict = rule_columns(rules)
    by_method = F.when(F.col("bound") >= threshold, "allow").otherwise("block")
    return scored.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, by_method).alias("verdict"),
                         F.round("mean", 6).alias("mean"), F.round("bound", 6).alias("bound"))
