"""URL filter: fixed rules first, then the empirical-Bayes reputation of the host.

Labelled outcomes of pages are added up per host. A host's share of good pages has a beta prior around
the share of its registered domain, which is shrunk towards that of its suffix, and that towards all pages.
How strongly a level pulls is estimated from how much its children differ beyond chance (method of moments).
A host is blocked if the upper bound of its posterior is below ``least_good``, so one without outcomes
is judged by its domain, and few bad pages don't block it.

Outcomes are summed per host before anything is joined; a host with a third of all pages is one row per
task by then.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from .common import checkpointed, lower_ascii

#: Standard normal quantile of the one-sided bound, least good share, bounds of a prior's strength in pages.
Z, LEAST_GOOD, WEAKEST, STRONGEST = 1.645, 0.5, 2.0, 1000.0


@dataclass(frozen=True)
class Rule:
    """``pattern`` is a host, a slash and a path prefix; it also fits subdomains of the host."""

    verdict: str
    pattern: str


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path; both empty for a null url or one without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return lower_ascii(host), path


def rule_of(host: Column, path: Column, rules: list[Rule]) -> Column:
    """Pattern of the longest rule that fits, else null; of equal ones the first listed."""
    found = F.lit(None).cast("string")
    for rule in sorted(reversed(rules), key=lambda r: len(r.pattern)):
        rule_host, slash, rest = rule.pattern.partition("/")
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(slash + rest)
        found = F.when(fits, rule.pattern).otherwise(found)
    return found


def _strength(children: DataFrame, m: Column) -> float:
    """Pages that a prior is worth, from the spread of children's shares around ``m``, their parents' share."""
    p = F.col("s") / F.col("n")
    sums = children.filter("n > 0").agg(F.sum(F.col("n") * (p - m) * (p - m)), F.sum(F.col("n") * m * (1 - m)), F.sum("n"), F.count(F.lit(1)))
    spread, chance, pages, units = sums.first()
    if not units or pages <= units:
        return STRONGEST
    within = chance / pages
    share = (spread - units * within) / (pages - units) / within
    return min(max((1 - share) / share, WEAKEST), STRONGEST) if share > 0 else STRONGEST


def reputations(hosts: DataFrame) -> DataFrame:
    """``host``, ``bound``: upper bound of the posterior share of good pages.

    ``hosts`` has ``host``, ``n`` (labelled pages, may be 0) and ``s`` (good ones), a row for each host. Four figures of
    the whole corpus come to the driver: the share of good pages, and how strongly each level pulls.
    """
    labels = F.split("host", r"\.")
    domain = F.array_join(F.slice(labels, -F.least(F.size(labels), F.lit(2)), 2), ".")
    hosts = checkpointed(hosts.select("host", "n", "s", domain.alias("domain"), F.element_at(labels, -1).alias("suffix")))
    total = lambda df, *by: df.groupBy(*by).agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    domains = checkpointed(total(hosts, "domain", "suffix"))
    suffixes = checkpointed(total(domains, "suffix"))
    n, s = suffixes.agg(F.sum("n"), F.sum("s")).first()
    top = ((s or 0) + 1) / ((n or 0) + 2)
    raw = (F.col("s") + 1) / (F.col("n") + 2)
    under = lambda children, parents, by: children.join(parents.select(by, raw.alias("m")), by)
    ks = _strength(suffixes, F.lit(top))
    kd = _strength(under(domains, suffixes, "suffix"), F.col("m"))
    kh = _strength(under(hosts, domains, "domain"), F.col("m"))
    shrunk = lambda k, m: (F.col("s") + F.lit(k) * m) / (F.col("n") + F.lit(k))
    by_suffix = suffixes.select("suffix", shrunk(ks, F.lit(top)).alias("ms"))
    by_domain = domains.join(by_suffix, "suffix").select("domain", shrunk(kd, F.col("ms")).alias("md"))
    known = hosts.join(by_domain, "domain").select("host", "n", shrunk(kh, F.col("md")).alias("mean"))
    deviation = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("n") + F.lit(kh) + 1))
    return known.select("host", (F.col("mean") + Z * deviation).alias("bound"))


def judge_urls(pages: DataFrame, outcomes: DataFrame, rules: list[Rule], key: str = "page_id", url: str = "url",
               least_good: float = LEAST_GOOD) -> DataFrame:
    """``key``, ``host``, ``path``, ``rule``, ``verdict``, a row for each row of ``pages``.

    ``outcomes`` has ``host``, ``n``, ``s``: labelled pages and good ones, in any number of rows per host;
    a null host or null counts add nothing. A null url has an empty host, which is a host like any other.
    Other columns of ``pages`` are not carried.
    """
    host, path = url_parts(F.col(url))
    parts = pages.select(F.col(key).alias("key"), host.alias("host"), path.alias("path"))
    seen = parts.groupBy("host").agg(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("s"))
    told = outcomes.select("host", F.col("n").cast("long"), F.col("s").cast("long")).dropna()
    hosts = seen.union(told).groupBy("host").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    verdicts = dict_of(rules)
    judged = parts.join(reputations(hosts), "host", "left").withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    by_host = F.when(F.col("bound") < least_good, "block").otherwise("allow")
    verdict = F.coalesce(verdicts[F.col("rule")], by_host) if rules else by_host
    return judged.select(F.col("key").alias(key), "host", "path", "rule", verdict.alias("verdict"))


def dict_of(rules: list[Rule]) -> Column:
    return F.create_map(*(F.lit(x) for r in {r.pattern: r for r in reversed(rules)}.values() for x in (r.pattern, r.verdict)))
