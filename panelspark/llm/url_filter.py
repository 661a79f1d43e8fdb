"""URL filters by empirical-Bayes host reputation (native).

Labelled page outcomes (bad or not) are counted per host, registered domain and
suffix.  Counts are shrunk through beta-binomial priors: the suffix towards the
overall rate, the registered domain towards its suffix, the host towards its
domain.  A page's method verdict is ``block`` when the lower bound of the host's
posterior badness lies above ``threshold``; list rules (host and path prefix)
come first, the longest wins.

Defined cases: a null url or one without ``://`` has empty host and path and no
rule; hosts without labels take their domain's (or suffix's, or the overall)
rate as the mean of a weak posterior; an empty table gives an empty result;
repeated rows stay; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.llm.common import staged

# fixed values: the list rules as (host, path prefix, verdict)
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"),
         ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
# fixed values: second-level labels that belong to the suffix under a two-letter country domain
SECOND_LEVEL = ("ac", "co", "com", "edu", "gov", "net", "org")
STRENGTH = 20.0             # pseudo-counts every level takes from the level above
Z = 1.645                   # one-sided 95 % bound
THRESHOLD = 0.5
MAX_HOSTS = 50_000          # size up to which the reputation table is broadcast
SALTS = 32


def host_of(url: Column) -> Column:
    after = F.substring(url, F.instr(url, "://") + 3, F.length(url))
    host = F.regexp_extract(after, r"^([^/?#]*)", 1)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.when(F.instr(url, "://") > 0, lower).otherwise(F.lit(""))


def path_of(url: Column) -> Column:
    after = F.substring(url, F.instr(url, "://") + 3, F.length(url))
    path = F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1)
    return F.when(F.instr(url, "://") > 0, path).otherwise(F.lit(""))


def suffix_of(host: Column) -> Column:
    parts = F.split(host, r"\.")
    n = F.size(parts)
    two = ((n >= 3) & (F.length(F.element_at(parts, -1)) == 2)
           & F.try_element_at(parts, F.lit(-2)).isin(*SECOND_LEVEL))
    return F.when(two, F.substring_index(host, ".", -2)).otherwise(F.substring_index(host, ".", -1))


def domain_of(host: Column) -> Column:
    """Registered domain: one label more than the suffix."""
    n = F.size(F.split(suffix_of(host), r"\."))
    return F.when(n == 2, F.substring_index(host, ".", -3)).otherwise(F.substring_index(host, ".", -2))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule text, verdict) of the longest list rule that fits, else nulls."""
    name = verdict = F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: len(r[0]) + len(r[1])):       # longer ones end up outermost
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name = F.when(fits, F.lit(h + p)).otherwise(name)
        verdict = F.when(fits, F.lit(v)).otherwise(verdict)
    return name, verdict


def host_reputation(pages: DataFrame, outcomes: DataFrame, strength: float = STRENGTH, z: float = Z) -> DataFrame:
    """One row per host: host, n_labelled, n_bad, mean, lower (posterior bound).

    pages: page_id, host; outcomes: page_id, bad (0 or 1).  Everything is
    counted per host first, so the levels above are sums over hosts."""
    per_page = outcomes.groupBy("page_id").agg(F.count("bad").alias("n"), F.sum("bad").alias("b"))
    h = (pages.join(per_page, "page_id", "left").groupBy("host")
         .agg(F.coalesce(F.sum("n"), F.lit(0)).cast("double").alias("n"),
              F.coalesce(F.sum("b"), F.lit(0)).cast("double").alias("b"))
         .withColumn("domain", domain_of(F.col("host"))).withColumn("suffix", suffix_of(F.col("host"))))
    k = F.lit(float(strength))
    domains = h.groupBy("domain", "suffix").agg(F.sum("n").alias("dn"), F.sum("b").alias("db"))
    suffixes = domains.groupBy("suffix").agg(F.sum("dn").alias("sn"), F.sum("db").alias("sb"))
    whole = suffixes.agg(F.sum("sn").alias("tn"), F.sum("sb").alias("tb"))
    rate = (F.coalesce(F.col("tb"), F.lit(0.0)) + 1) / (F.coalesce(F.col("tn"), F.lit(0.0)) + 2)
    suffixes = suffixes.withColumn("rate", whole.select(rate).scalar())
    suffixes = suffixes.select("suffix", ((F.col("sb") + k * F.col("rate")) / (F.col("sn") + k)).alias("s_mean"))
    domains = domains.join(suffixes, "suffix").select(
        "domain", ((F.col("db") + k * F.col("s_mean")) / (F.col("dn") + k)).alias("d_mean"))
    a = F.col("b") + k * F.col("d_mean")
    c = F.col("n") - F.col("b") + k * (1 - F.col("d_mean"))
    mean = a / (a + c)
    lower = mean - F.lit(float(z)) * F.sqrt(a * c / ((a + c) * (a + c) * (a + c + 1)))
    return h.join(domains, "domain").select("host", F.col("n").cast("long").alias("n_labelled"),
                                            F.col("b").cast("long").alias("n_bad"),
                                            mean.alias("mean"), lower.alias("lower"))


def judge_urls(pages: DataFrame, outcomes: DataFrame, rules=RULES, threshold: float = THRESHOLD, **kw) -> DataFrame:
    """page_id, host, path, rule, verdict, mean, lower for every row of ``pages``."""
    p = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    p = p.fillna("", ["host", "path"])
    rep = staged(host_reputation(p.select("page_id", "host"), outcomes, **kw), "reputation")
    rep = rep.select("host", "mean", "lower")
    if rep.count() <= MAX_HOSTS:
        joined = p.join(F.broadcast(rep), "host")
    else:
        salt = F.pmod(F.xxhash64("page_id", "path"), F.lit(SALTS)).cast("int")
        every = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
        joined = p.withColumn("salt", salt).join(rep.withColumn("salt", every), ["host", "salt"])
    name, verdict = rule_of(F.col("host"), F.col("path"), rules)
    method = F.when(F.col("lower") > threshold, F.lit("block")).otherwise(F.lit("allow"))
    return joined.select("page_id", "host", "path", name.alias("rule"),
                         F.coalesce(verdict, method).alias("verdict"), "mean", "lower")
