"""URL filters: list rules and an empirical-Bayes reputation of hosts.

A rule is a host and a path prefix; it fits the host and its subdomains where the url's
path starts with the prefix, and the longest rule that fits wins. A port is part of the host,
so that a rule without it does not fit. Other urls are judged
by the reputation of their host: bad outcomes among its labelled pages under a
beta-binomial model, shrunk from host to registered domain to suffix to all pages. Each
level's prior has its parent's posterior mean; its strength is estimated from all members
of the level by the method of moments. A host is blocked when the lower bound of its
posterior bad rate (mean minus ``z`` standard deviations) is above ``max_bad_rate``.

Scale: outcomes are counted per (host, outcome) before anything is shuffled; every level
is one narrow aggregate over hosts. Pages meet the host table by host with page id, host
and path only; a hot host's partition is split by Spark's skew join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from laminar.llm.common import let, lower_ascii, pinned

MAX_BAD_RATE = 0.5
Z = 1.645
# Bounds of the estimated prior strength (pseudo-pages).
MIN_STRENGTH, MAX_STRENGTH = 1.0, 1000.0
# Suffixes of two labels under which names are registered; a parameter, not a full list.
TWO_PART_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "com.au", "co.jp", "com.br", "co.nz", "co.in")


def host_of(url: Column) -> Column:
    """After the first :// up to / ? # or the end, A-Z lower-cased; empty without ://."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return lower_ascii(rest)


def path_of(url: Column) -> Column:
    """After the host up to ? # or the end; empty without ://."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def registered_domain(host: Column, two_part=TWO_PART_SUFFIXES) -> Column:
    """Suffix and one label before it, ports left out; the host itself if it has no such part."""
    name = F.regexp_replace(host, r":\d*$", "")
    two = F.regexp_extract(name, r"([^.]+\.[^.]+)$", 1)
    three = F.regexp_extract(name, r"([^.]+\.[^.]+\.[^.]+)$", 1)
    found = F.when(two.isin(*two_part) & (three != ""), three).otherwise(two)
    is_address = name.rlike(r"^[0-9.]+$|^\[")
    return F.when(is_address | (found == ""), name).otherwise(found)


def suffix_of(domain: Column) -> Column:
    return F.when(domain.rlike(r"^[0-9.]+$|^\["), domain).otherwise(
        F.regexp_replace(domain, r"^[^.]*\.", "")
    )


def rules_frame(spark: SparkSession, rules) -> DataFrame:
    """rules: (verdict, 'host/path') pairs -> rule_host, rule_path, rule, rule_verdict."""
    rows = []
    for verdict, rule in dict.fromkeys(rules):
        host, slash, path = rule.partition("/")
        rows.append(
            F.struct(
                F.lit(host.lower()).alias("rule_host"),
                F.lit(slash + path).alias("rule_path"),
                F.lit(rule).alias("rule"),
                F.lit(verdict).alias("rule_verdict"),
            )
        )
    if not rows:
        return spark.range(0).select(
            *[F.lit("").alias(c) for c in ("rule_host", "rule_path", "rule", "rule_verdict")]
        )
    return spark.range(1, numPartitions=1).select(F.inline(F.array(*rows)))


def _shrink(level: DataFrame, n: str, bad: str, prior: str) -> Column:
    """Posterior mean of each member given its parent's mean; the level's strength by the
    method of moments over all members (four sums come to the driver)."""
    m, size, k = F.col(prior), F.col(n), F.col(bad)
    row = level.agg(
        F.sum(F.pow(k - size * m, F.lit(2)) - size * m * (1 - m)).alias("over"),
        F.sum(size * (size - 1) * m * (1 - m)).alias("base"),
    ).first()
    rho = (row["over"] / row["base"]) if row["base"] else 0.0
    strength = MAX_STRENGTH if rho <= 0 else min(MAX_STRENGTH, max(MIN_STRENGTH, 1 / rho - 1))
    return F.lit(float(strength))


def reputations(hosts: DataFrame, z: float = Z) -> DataFrame:
    """(host, n, bad: labelled pages and bad ones among them) -> host, n, bad, mean, lower:
    posterior mean and lower bound of the bad rate. Hosts without labels: n = 0."""
    h = pinned(
        hosts.withColumn("domain", registered_domain(F.col("host"))).withColumn(
            "suffix", suffix_of(F.col("domain"))
        )
    )
    total = h.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).first()
    overall = ((total["bad"] or 0) + 0.5) / ((total["n"] or 0) + 1.0)

    suffixes = h.groupBy("suffix").agg(F.sum("n").alias("sn"), F.sum("bad").alias("sb"))
    suffixes = suffixes.withColumn("m", F.lit(float(overall)))
    s = _shrink(suffixes, "sn", "sb", "m")
    suffixes = suffixes.select("suffix", ((F.col("sb") + s * F.col("m")) / (F.col("sn") + s)).alias("sm"))

    domains = h.groupBy("suffix", "domain").agg(F.sum("n").alias("dn"), F.sum("bad").alias("db"))
    domains = pinned(domains.join(suffixes, "suffix"))
    s = _shrink(domains, "dn", "db", "sm")
    domains = domains.select(
        "domain", ((F.col("db") + s * F.col("sm")) / (F.col("dn") + s)).alias("dm")
    )

    h = h.join(domains, "domain")
    s = _shrink(h, "n", "bad", "dm")
    a = F.col("bad") + s * F.col("dm")
    b = F.col("n") - F.col("bad") + s * (1 - F.col("dm"))
    h = h.withColumn("mean", a / (a + b)).withColumn("mass", a + b)
    spread = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("mass") + 1))
    return h.select("host", "n", "bad", "mean", (F.col("mean") - z * spread).alias("lower"))


def judge(
    pages: DataFrame,
    outcomes: DataFrame,
    rules=(),
    max_bad_rate: float = MAX_BAD_RATE,
    z: float = Z,
) -> DataFrame:
    """Verdict per row of ``pages`` (page_id, url, anything else).

    ``outcomes``: (url, bad 0/1), a row per labelled page. Returns page_id, host, path, rule,
    verdict, posterior_mean, posterior_lower. Null urls and urls without ``://`` have an
    empty host and path and are judged as members of the empty host; null outcomes don't
    count; repeated rows are judged alike. Without any label nothing is blocked but by rule.
    """
    seen = outcomes.where(F.col("bad").isNotNull()).select(
        host_of(F.col("url")).alias("host"), F.col("bad").cast("double").alias("bad")
    )
    labelled = seen.groupBy("host").agg(
        F.count("*").cast("double").alias("n"), F.sum("bad").alias("bad")
    )
    parts = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    every = parts.select("host").distinct().join(labelled, "host", "full_outer")
    hosts = every.select("host", *[F.coalesce(c, F.lit(0.0)).alias(c) for c in ("n", "bad")])
    known = reputations(hosts, z)

    list_ = rules_frame(pages.sparkSession, rules)
    longest = max((r.split("/")[0].count(".") + 1 for _, r in rules), default=1)
    labels = F.split("host", r"\.")
    ends = let(
        labels,
        lambda ls: F.transform(
            F.sequence(F.lit(1), F.least(F.size(ls), F.lit(longest))),
            lambda i: F.array_join(F.slice(ls, F.size(ls) - i + 1, i), "."),
        ),
    )
    fits = (
        known.select("host", F.explode(ends).alias("rule_host"))
        .join(list_, "rule_host")
        .groupBy("host")
        .agg(F.collect_list(F.struct(F.length("rule").alias("size"), "rule", "rule_path", "rule_verdict")).alias("rules"))
    )
    table = pinned(known.join(fits, "host", "left"))
    best = F.array_max(F.filter("rules", lambda r: F.col("path").startswith(r["rule_path"])))
    by_method = F.when(F.col("lower") > max_bad_rate, F.lit("block")).otherwise(F.lit("allow"))
    return (
        parts.join(table, "host", "left")
        .withColumn("best", best)
        .select(
            "page_id",
            "host",
            "path",
            F.col("best.rule").alias("rule"),
            F.coalesce(F.col("best.rule_verdict"), by_method).alias("verdict"),
            F.col("mean").alias("posterior_mean"),
            F.col("lower").alias("posterior_lower"),
        )
    )


def document_outcomes(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(url, bad): the label of the document that a url's path names by its last number
    (``/en/17``, ``/en/17.html``, ``/en/17/``); bad is toxic or of low quality. Labels of one
    document count once, a bad one first; pages are counted before they meet the labels."""
    bad = (F.coalesce(F.col("toxic"), F.lit(0)) == 1) | (F.coalesce(F.col("quality"), F.lit(1)) == 0)
    per_doc = labels.where("doc_id is not null").groupBy("doc_id").agg(F.max(bad.cast("int")).alias("bad"))
    number = F.regexp_extract(path_of(F.col("url")), r"/(\d{1,18})(?:\.[A-Za-z]+)?/?$", 1)
    named = pages.select("url", F.when(number != "", number).cast("long").alias("doc_id"))
    return named.where("doc_id is not null").join(per_doc, "doc_id").select("url", "bad")
