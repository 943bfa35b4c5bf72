"""URL filter: fixed rules first, else the empirical-Bayes reputation of the host."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from skyloom.llm.common import Store, ascii_lower

# (verdict, host, path)
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
LEVELS = ("suffix", "domain", "host")


def host_of(url: Column) -> Column:
    """Text after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, "://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """Text after the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def last_labels(host: Column, labels: int) -> Column:
    """The last ``labels`` dot-separated parts of a host."""
    return F.regexp_extract(host, f"([^.]*[.]){{0,{labels - 1}}}[^.]*\\z", 0)


def rule_for(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """Struct (rule, verdict) of the longest rule that fits; null when none does.

    A rule fits its host and all subdomains when the path starts with the rule's path. Among
    rules of one length the earlier wins.
    """
    found = F.lit(None)
    for verdict, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith(f".{rule_host}")) & path.startswith(rule_path)
        found = F.when(fits, F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def _strength(children: DataFrame, parent: str, low: float, high: float) -> float:
    """Prior strength of one level by the moments of the beta-binomial, pooled over its parents.

    Children of a parent vary more than binomial draws from the parent's rate would; the ratio of
    extra to possible variance is the intra-class correlation rho, and the strength is (1 - rho) / rho.
    """
    parents = children.groupBy(parent).agg(
        F.sum("n").alias("n"), F.sum("k").alias("k"), F.count(F.lit(1)).alias("c"), F.sum(F.col("n") * F.col("n") * 1.0).alias("nn"),
        # sum of n (k/n - p)^2 = sum k^2/n - n p^2
        F.sum(F.col("k") * F.col("k") / F.col("n")).alias("kk"),
    )
    p = F.col("k") / F.col("n")
    row = parents.agg(
        F.sum(F.col("kk") - F.col("n") * p * p).alias("spread"), F.sum(p * (1 - p) * (F.col("c") - 1)).alias("expected"),
        F.sum(p * (1 - p) * (F.col("n") - F.col("nn") / F.col("n") - (F.col("c") - 1))).alias("room"),
    ).first()
    if not row["room"] or row["room"] <= 0:
        return low  # no parent with two children: the spread cannot be told, so the prior is weak
    rho = max((row["spread"] - row["expected"]) / row["room"], 0.0)
    return high if rho * high <= 1 - rho else max((1 - rho) / rho, low)


def carried(strength: float, weight: Column, low: float) -> Column:
    """Prior strength of a child: the beta matching the level's spread (strength s) plus the variance of the
    parent's estimate (weight w), 1 / (1 / (s + 1) + 1 / (w + 1)) - 1, which is below both; at least ``low``."""
    return F.greatest(1 / (1 / F.lit(strength + 1.0) + 1 / (weight + 1)) - 1, F.lit(low))


def host_bounds(outcomes: DataFrame, hosts: DataFrame, z: float = 1.645, low: float = 1.0, high: float = 1000.0) -> DataFrame:
    """(host, bound): lower bound of the rate of bad pages of every host in ``hosts``.

    ``outcomes`` (host, bad 0/1) are labelled pages; null values are ignored. The rate of a suffix is shrunk
    to the overall rate, that of a registered domain to its suffix, that of a host to its domain. Each prior
    leaves out the pages of the child it serves (the domain's prior for a host is the domain's estimate from its
    other hosts), so no page counts twice, and a parent's own uncertainty is carried down (``carried``): a prior
    never weighs more than the evidence behind it, except for the ``low`` pseudo-pages every level keeps (and
    the half page each way of the overall rate). A level whose spread cannot be told (no parent with two labelled
    children) has the weak strength ``low``. The bound is the mean of the host's beta posterior less ``z``
    standard deviations. With no outcome at all the bound is 0. Only four numbers reach the driver: the overall
    counts and the strength of each level.
    """
    store = Store(hosts.sparkSession)
    named = {"domain": last_labels(F.col("host"), 2), "suffix": last_labels(F.col("host"), 1)}
    counts = (F.count(F.lit(1)).alias("n"), F.sum(F.col("bad").cast("long")).alias("k"))
    counted = outcomes.where("host is not null and bad is not null").groupBy("host").agg(*counts)
    levels = {"host": store.keep(counted.withColumns(named | {"everything": F.lit(0)}))}
    for level, below in (("domain", "host"), ("suffix", "domain")):
        up = LEVELS[: LEVELS.index(level) + 1]
        levels[level] = levels[below].groupBy(*up, "everything").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    total = levels["suffix"].agg(F.sum("n").alias("n"), F.sum("k").alias("k")).first()
    if not total["n"]:
        return hosts.select("host").distinct().withColumn("bound", F.lit(0.0))
    strengths = {level: _strength(levels[level], parent, low, high) for level, parent in zip(LEVELS, ("everything", "suffix", "domain"))}
    result = hosts.select("host").distinct().withColumns(named)
    for level in LEVELS:
        own = levels[level].select(level, F.col("n").alias(f"n_{level}"), F.col("k").alias(f"k_{level}"))
        result = result.join(own, level, "left").fillna(0, [f"n_{level}", f"k_{level}"])
    n, k = (lambda level: F.col(f"n_{level}")), (lambda level: F.col(f"k_{level}"))
    weight = F.lit(float(total["n"] + 1)) - n("suffix")
    mean = (F.lit(float(total["k"]) + 0.5) - k("suffix")) / weight
    for level, child in (("suffix", "domain"), ("domain", "host")):
        prior = carried(strengths[level], weight, low)
        left_n, left_k = n(level) - n(child), k(level) - k(child)
        mean, weight = (left_k + prior * mean) / (left_n + prior), left_n + prior
        result = result.withColumns({f"mean_{level}": mean, f"weight_{level}": weight})
        mean, weight = F.col(f"mean_{level}"), F.col(f"weight_{level}")
    prior = carried(strengths["host"], weight, low)
    mean = (k("host") + prior * mean) / (n("host") + prior)
    result = result.withColumns({"mean": mean, "weight": n("host") + prior})
    return result.select("host", (F.col("mean") - z * F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("weight") + 1))).alias("bound"))


def judge(pages: DataFrame, outcomes: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, limit: float = 0.25, z: float = 1.645) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, and the host's lower bound of bad pages.

    ``outcomes`` (page_id, bad 0/1) label some pages; several labels of a page all count, null ones do not.
    A page that no rule fits is blocked when the lower bound of its host's rate of bad pages is above ``limit``.
    Null urls and urls without ``://`` have an empty host and path and share the reputation of the
    empty host. Repeated pages are judged alike, null page ids are judged but never labelled; empty tables give empty results. Counts per host
    are partial aggregates; the bounds are joined back by host, where Spark splits a hot host.
    """
    parsed = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    labelled = outcomes.select("page_id", "bad").join(parsed.select("page_id", "host").distinct(), "page_id")
    # Stored, so that the last join deals both sides out itself and can split a hot host.
    bounds = Store(pages.sparkSession).keep(host_bounds(labelled.select("host", "bad"), parsed))
    by_host = F.when(F.col("bound") > limit, "block").otherwise("allow")
    found = rule_for(F.col("host"), F.col("path"), rules)
    return parsed.join(bounds, "host", "left").withColumn("found", found).select(
        "page_id", "host", "path", F.col("found.rule").alias("rule"), F.coalesce("found.verdict", by_host).alias("verdict"), "bound",
    )
