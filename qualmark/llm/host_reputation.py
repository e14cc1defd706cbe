"""URL filter: allow and block rules, and empirical-Bayes host reputation.

Labelled page outcomes are counted per host, registered domain and suffix.
Each level's bad rate is shrunk towards its parent's through a beta-binomial
prior whose concentration is fitted by moments on the whole level; a host is
blocked when the lower bound of its posterior bad rate exceeds a limit.

Only DataFrame functions are used. Counts are combined before each shuffle, so
a host with a third of the pages is one row per task; the one join back to the
pages has a splittable skewed key. Three scalars per level come to the driver.

Cases: a null url or one without ``://`` has an empty host and path (an empty
host is a host like any other); a host without labels takes its parents'
rates; with no labels at all nothing is blocked; an address such as ``10.0.0.1`` is
its own domain and suffix; repeated rows (and repeated page ids) each count;
null outcomes are no labels; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MAX_BAD = 0.25        # block above this bad rate ...
Z = 1.645             # ... when the posterior mean less Z deviations still exceeds it
PRIOR_CORR = (0.001, 0.5)   # range of the fitted intra-class correlation
SECOND_LEVEL = ("ac", "co", "com", "edu", "go", "gov", "ne", "net", "or", "org")   # registries' labels below a two-letter country code


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


def url_host(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, UPPER, LOWER)


def url_path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _levels(host: Column, second_level: tuple[str, ...]) -> tuple[Column, Column]:
    """Registered domain and suffix of a host, without a port. An address is one unit, both
    domain and suffix. Below a country code, a ``second_level`` label belongs to the suffix."""
    h = F.regexp_replace(host, r":[0-9]*$", "")
    two, last = F.substring_index(h, ".", -2), F.substring_index(h, ".", -1)
    address = h.rlike(r"^[0-9]+(\.[0-9]+){3}$|^\[")
    multi = last.rlike("^[a-z]{2}$") & (two != last) & F.substring_index(two, ".", 1).isin(*second_level)
    domain = F.when(address, h).when(multi, F.substring_index(h, ".", -3)).otherwise(two)
    return domain, F.when(address, h).when(multi, two).otherwise(last)


def registered_domain(host: Column, second_level: tuple[str, ...] = SECOND_LEVEL) -> Column:
    """The label below the suffix and the suffix (the host itself if it has no more)."""
    return _levels(host, second_level)[0]


def public_suffix(host: Column, second_level: tuple[str, ...] = SECOND_LEVEL) -> Column:
    return _levels(host, second_level)[1]


def longest_rule(rules: list[Rule], host: Column, path: Column) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, else null."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for r in sorted(rules, key=lambda r: (len(r.text), r.text)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        out = F.when(fits, F.struct(F.lit(r.text).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(out)
    return out


def _correlation(rows: DataFrame, prior: Column) -> float:
    """Moment estimate of a beta-binomial's intra-class correlation around ``prior``:
    E[n (k/n - p)^2] = p (1 - p) (1 + (n - 1) rho), summed over the level."""
    v = prior * (1 - prior)
    s = rows.where("n > 0").agg(F.sum(F.pow(F.col("k") / F.col("n") - prior, 2) * F.col("n")).alias("s"),
                                F.sum(v).alias("v"), F.sum(v * (F.col("n") - 1)).alias("w")).first()
    rho = (s.s - s.v) / s.w if s.w else PRIOR_CORR[1]      # nothing to fit it on: the weakest prior
    return min(max(rho, PRIOR_CORR[0]), PRIOR_CORR[1])


def host_reputation(outcomes: DataFrame, hosts: DataFrame, second_level: tuple[str, ...] = SECOND_LEVEL) -> DataFrame:
    """Posterior of every host: ``host, n, k, mean, bound``.

    ``outcomes``: ``host, bad`` (0/1) per labelled page; ``hosts``: ``host`` of
    every page to be judged; ``second_level``: labels that belong to a country's suffixes.
    """
    seen = outcomes.where(F.col("bad").isNotNull()).groupBy("host") \
        .agg(F.count("*").alias("n"), F.sum(F.col("bad").cast("long")).alias("k"))
    every = hosts.select("host", F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("k")).distinct()
    h = materialize(seen.unionByName(every).groupBy("host").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
                    .withColumn("domain", registered_domain(F.col("host"), second_level))
                    .withColumn("suffix", public_suffix(F.col("host"), second_level)), "hosts")
    total = h.agg(F.sum("n").alias("n"), F.sum("k").alias("k")).first()
    base = ((total.k or 0) + 1) / ((total.n or 0) + 2)

    def shrink(rows: DataFrame, prior: Column, corr: float) -> DataFrame:
        c = 1 / corr - 1
        return rows.withColumn("rate", (F.col("k") + prior * c) / (F.col("n") + c))

    suffix = h.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    suffix = shrink(suffix, F.lit(base), _correlation(suffix, F.lit(base)))
    domain = h.groupBy("suffix", "domain").agg(F.sum("n").alias("n"), F.sum("k").alias("k")) \
        .join(suffix.select("suffix", F.col("rate").alias("parent")), "suffix")
    domain = shrink(domain, F.col("parent"), _correlation(domain, F.col("parent")))
    rows = h.join(domain.select("domain", F.col("rate").alias("parent")), "domain")
    c = 1 / _correlation(rows, F.col("parent")) - 1
    a, b = F.col("k") + F.col("parent") * c, F.col("n") - F.col("k") + (1 - F.col("parent")) * c
    mean = a / (a + b)
    return rows.select("host", "n", "k", mean.alias("mean"),
                       (mean - Z * F.sqrt(mean * (1 - mean) / (a + b + 1))).alias("bound"))


def filter_urls(pages: DataFrame, outcomes: DataFrame, rules: list[Rule], max_bad: float = MAX_BAD) -> DataFrame:
    """``page_id, host, path, rule, verdict`` per page.

    ``pages``: ``page_id, url``; ``outcomes``: ``page_id, bad`` for labelled pages.
    """
    p = pages.select("page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    known = outcomes.select("page_id", "bad").join(p.select("page_id", "host"), "page_id")
    blocked = host_reputation(known, p.select("host")).where(F.col("bound") > max_bad) \
        .select("host", F.lit(True).alias("blocked"))
    rule = longest_rule(rules, F.col("host"), F.col("path"))
    return p.join(blocked, "host", "left").withColumn("r", rule).select(
        "page_id", "host", "path", F.col("r.rule").alias("rule"),
        F.coalesce(F.col("r.verdict"), F.when(F.col("blocked"), "block").otherwise("allow")).alias("verdict"))
