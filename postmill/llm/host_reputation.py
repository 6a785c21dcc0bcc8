"""URL verdicts: fixed host rules first, then empirical-Bayes host reputation.

Labelled page outcomes (good or bad) are counted by host. Hosts group into registered
domains, domains into suffixes. At every level a beta prior is centred on the posterior
mean of the level above, and its strength is estimated from how much the rates of the
level's members vary beyond binomial noise (method of moments). A host's posterior is
its own counts on top of its domain's prior, so a host with few or no labels takes its
domain's rate and one with many its own. A page is blocked if the lower bound of its
host's bad rate, mean less Z posterior standard deviations, is above LIMIT.

Counts are combined by host before anything is joined, and pages meet one row per host.
All of it is DataFrame operations on built-in functions.

Defined cases: null url and a url without "://" have empty host and path, and are judged
by the prior alone. Pages without a label take part in nothing but the verdict. A page
counts once per outcome row it has. Without any outcome the overall rate is 1/2 with
the weight of two pages, so nothing is blocked by the method.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postmill.session import written

# Rule, verdict: fixed by the contract of the query.
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
# Suffixes of two labels; any other suffix is the last label.
TWO_LABEL_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "com.au", "co.jp", "com.br", "co.in", "co.nz", "co.za", "com.cn")
Z = 1.645
LIMIT = 0.5
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first "://" up to "/", "?", "#" or the end, A-Z lower-cased; else empty."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to "?", "#" or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_for(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits, null if none does."""
    result = None
    for rule, _ in sorted(rules, key=lambda r: (-len(r[0]), r[0])):
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        result = F.when(fits, F.lit(rule)) if result is None else result.when(fits, F.lit(rule))
    return result


def suffix_of(host: Column) -> Column:
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(*TWO_LABEL_SUFFIXES), two).otherwise(F.substring_index(host, ".", -1))


def domain_of(host: Column, suffix: Column) -> Column:
    """The suffix and one label more; a host that is a suffix is its own domain."""
    labels = F.size(F.split(suffix, r"\.")) + 1
    return F.when(labels == 2, F.substring_index(host, ".", -2)).otherwise(F.substring_index(host, ".", -3))


def _prior_strength(groups: DataFrame, by: list[str], mean: Column) -> DataFrame:
    """Beta strength of each parent from its members' counts (bad, total) by the method of moments.

    Between-member variance is what the weighted spread of rates leaves after binomial
    noise; strength is mean (1 - mean) / variance - 1, held between 1 and 1000.
    """
    spread = groups.where("total > 0").withColumn("m", mean).groupBy(*by).agg(
        F.count("*").alias("k"),
        F.sum("total").alias("n"),
        F.sum(F.col("total") * F.pow(F.col("bad") / F.col("total") - F.col("m"), 2)).alias("ss"),
        F.sum(F.col("total") * F.col("total")).alias("nn"),
        F.first("m").alias("m"),
    )
    noise = F.col("m") * (1 - F.col("m"))
    between = (F.col("ss") - F.col("k") * noise) / F.nullif(F.col("n") - F.col("k"), F.lit(0))
    strength = noise / F.nullif(F.greatest(between, F.lit(0.0)), F.lit(0.0)) - 1
    return spread.select(*by, F.least(F.lit(1000.0), F.greatest(F.lit(1.0), F.coalesce(strength, F.lit(1000.0)))).alias("strength"))


def _shrunk(groups: DataFrame, parents: DataFrame, by: list[str]) -> DataFrame:
    """groups with their parent's prior and their own posterior mean."""
    strengths = _prior_strength(groups.join(parents, by), by, F.col("parent_mean"))
    joined = groups.join(parents, by).join(strengths, by, "left").withColumn("strength", F.coalesce("strength", F.lit(1000.0)))
    return joined.withColumn("mean", (F.col("bad") + F.col("strength") * F.col("parent_mean")) / (F.col("total") + F.col("strength")))


def reputations(pages: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Per host: mean and bound of its bad rate. pages: page_id, host; outcomes: page_id, bad (0 or 1)."""
    known = outcomes.where("page_id is not null and bad is not null").groupBy("page_id").agg(F.sum("bad").alias("bad"), F.count("*").alias("total"))
    counted = pages.join(known, "page_id", "left").groupBy("host").agg(F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"), F.coalesce(F.sum("total"), F.lit(0)).alias("total"))
    suffix = suffix_of(F.col("host"))
    hosts = written(counted.select("host", domain_of(F.col("host"), suffix).alias("domain"), suffix.alias("suffix"), "bad", "total"), "hosts")
    sums = [F.sum("bad").alias("bad"), F.sum("total").alias("total")]
    domains = hosts.groupBy("suffix", "domain").agg(*sums)
    suffixes = hosts.groupBy("suffix").agg(*sums).withColumn("all", F.lit(1))
    overall = hosts.agg(((F.coalesce(F.sum("bad"), F.lit(0)) + 1) / (F.coalesce(F.sum("total"), F.lit(0)) + 2)).alias("parent_mean")).withColumn("all", F.lit(1))
    suffixes = written(_shrunk(suffixes, overall, ["all"]).select("suffix", F.col("mean").alias("parent_mean")), "suffixes")
    domains = written(_shrunk(domains, suffixes, ["suffix"]).select("domain", F.col("mean").alias("parent_mean")), "domains")
    judged = _shrunk(hosts, domains, ["domain"])
    weight = F.col("total") + F.col("strength")
    deviation = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (weight + 1))
    return judged.select("host", "bad", "total", "mean", (F.col("mean") - Z * deviation).alias("bound"))


def verdicts(pages: DataFrame, outcomes: DataFrame, rules=RULES, limit: float = LIMIT) -> DataFrame:
    """Per page: page_id, host, path, rule, verdict, and the host's bad_rate and bound."""
    url = F.col("url")
    split = pages.select(F.col("page_id").cast("long").alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"))
    rated = written(reputations(split, outcomes).select("host", F.col("mean").alias("bad_rate"), "bound"), "reputations")
    decided = F.lit(None).cast("string")
    for rule, verdict in rules:
        decided = F.when(F.col("rule") == rule, F.lit(verdict)).otherwise(decided)
    own = F.when(F.col("bound") > limit, "block").otherwise("allow")
    return (
        split.withColumn("rule", rule_for(F.col("host"), F.col("path"), rules))
        .join(rated, "host")
        .select("page_id", "host", "path", "rule", F.coalesce(decided, own).alias("verdict"), "bad_rate", "bound")
    )


def label_outcomes(labels: DataFrame) -> DataFrame:
    """Outcomes of pages from the labels of the same number: bad if low in quality or toxic."""
    bad = (F.coalesce(F.col("quality"), F.lit(1)) == 0) | (F.coalesce(F.col("toxic"), F.lit(0)) == 1)
    return labels.select(F.col("doc_id").cast("long").alias("page_id"), bad.cast("int").alias("bad"))
