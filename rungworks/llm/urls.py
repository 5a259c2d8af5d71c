"""URL filter: listed rules first, then an empirical-Bayes reputation of the host.

Pages with a known outcome (good or bad) are counted by host, and the counts summed to the
registered domain and the public suffix.  Each level's bad rate is shrunk to that of the
level above through a beta-binomial prior whose strength is estimated from how much the
groups of the level differ (moments of the beta-binomial).  A host is blocked when even
the lower bound of its bad rate is above a limit, so that few outcomes never block.
The beta posterior's bound is taken as mean less ``z`` standard deviations.

Outcomes are summed before they are shuffled; a crowded host is one row of a small table
that pages look up.  The three strengths, one row, go through the driver.

Everything is built-in column code.  Defined results: a null url or one without ``://`` has
an empty host and an empty path, fits no rule, and shares the reputation of the empty
host; every pair of a page row and an outcome row of its id counts, so repeated rows count
repeatedly; null outcomes and null ids count nowhere; empty tables give empty tables; other
columns pass through, and a column that has the name of a result is replaced by it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rungworks.llm.common import free_name


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


#: The rules in force.  They become one conditional expression, so this is for lists of up
#: to some hundreds.
RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)
#: Public suffixes of two labels; any other suffix is the last label.
LONG_SUFFIXES = ("co.uk", "org.uk", "com.au", "co.jp", "com.br", "co.in")
#: A host is blocked when its bad rate is above LIMIT with Z standard deviations to spare.
LIMIT = 0.5
Z = 1.645
#: Bounds of the prior's strength, in pages.
STRENGTH = (1.0, 1000.0)

RESULTS = ("host", "path", "rule", "verdict", "bad_rate_bound")


def host_of(url: Column) -> Column:
    raw = F.regexp_extract(F.coalesce(url, F.lit("")), "://([^/?#]*)", 1)
    return F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), "://[^/?#]*([^?#]*)", 1)


def _labels(host: Column) -> Column:
    """Labels of the bare host name: without a user's name and a port."""
    return F.split(F.regexp_replace(F.regexp_replace(host, "^.*@", ""), ":[0-9]*$", ""), r"\.")


def _last(labels: Column, n: Column) -> Column:
    n = F.least(n, F.size(labels))
    return F.array_join(F.slice(labels, F.size(labels) - n + 1, n), ".")


def _suffix_labels(labels: Column) -> Column:
    return F.when(_last(labels, F.lit(2)).isin(*LONG_SUFFIXES), 2).otherwise(1)


def _is_address(labels: Column) -> Column:
    return F.array_join(labels, ".").rlike(r"^[0-9]+(\.[0-9]+){3}$|^\[")


def suffix_of(host: Column) -> Column:
    labels = _labels(host)
    return F.when(_is_address(labels), F.lit("")).otherwise(_last(labels, _suffix_labels(labels)))


def domain_of(host: Column) -> Column:
    """The registered domain: the public suffix and one label more."""
    labels = _labels(host)
    return F.when(_is_address(labels), F.array_join(labels, ".")).otherwise(_last(labels, _suffix_labels(labels) + 1))


def fitting_rule(host: Column, path: Column, rules: Sequence[Rule] = RULES) -> Column:
    """Name and verdict of the longest rule that fits, as a struct; null if none does."""
    found = F.lit(None).cast("struct<name:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: len(r.name)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        found = F.when(fits, F.struct(F.lit(rule.name).alias("name"), F.lit(rule.verdict).alias("verdict"))).otherwise(found)
    return found


def _strength(groups: DataFrame, name: str) -> list[Column]:
    """Moments of the groups that have outcomes, for the intra-group correlation."""
    n, k = F.col("n"), F.col("k")
    return [F.sum(n).alias(f"{name}_n"), F.sum(k).alias(f"{name}_k"), F.sum(n * n).alias(f"{name}_nn"), F.sum(k * k / n).alias(f"{name}_pk"), F.count(F.when(n > 0, 1)).alias(f"{name}_g")]


def _fit(groups: DataFrame) -> float:
    """Strength of the beta prior that explains how much the groups' bad rates differ."""
    known = groups.where("n > 0")
    m = known.agg(*_strength(known, "x")).first()
    total, bad, squares, spread, count = m["x_n"], m["x_k"], m["x_nn"], m["x_pk"], m["x_g"]
    low, high = STRENGTH
    if not total or count < 2 or bad in (0, total):
        return high
    rate = bad / total
    pooled = rate * (1 - rate)
    room = total - squares / total - (count - 1)
    if room <= 0:
        return high
    rho = (spread - total * rate * rate - pooled * (count - 1)) / (pooled * room)
    return high if rho <= 0 else min(high, max(low, 1 / rho - 1))


def reputation(pages: DataFrame, outcomes: DataFrame, url: str = "url", page_id: str = "page_id", outcome_id: str = "doc_id", bad: Column | None = None, z: float = Z) -> DataFrame:
    """``host, outcomes, bad_rate, bad_rate_bound`` of every host of the pages."""
    bad = (F.lit(1) - F.col("quality")) if bad is None else bad
    seen = pages.select(F.col(page_id).alias("id"), host_of(F.col(url)).alias("host"))
    judged = outcomes.select(F.col(outcome_id).alias("id"), bad.cast("long").alias("bad")).where("bad IS NOT NULL AND id IS NOT NULL")
    counted = seen.join(judged, "id", "left").groupBy("host").agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("k"))
    hosts = counted.withColumns({"domain": domain_of(F.col("host")), "suffix": suffix_of(F.col("host"))})
    summed = lambda df, *by: df.groupBy(*by).agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    domains = summed(hosts, "domain", "suffix")
    suffixes = summed(domains, "suffix")
    per_host, per_domain, per_suffix = (_fit(x) for x in (hosts, domains, suffixes))
    total = suffixes.agg(F.sum("n").alias("n"), F.sum("k").alias("k")).first()
    overall = ((total["k"] or 0) + 0.5) / ((total["n"] or 0) + 1)

    shrunk = lambda prior, strength: (F.lit(strength) * prior + F.col("k")) / (F.lit(strength) + F.col("n"))
    by_suffix = suffixes.select("suffix", shrunk(F.lit(overall), per_suffix).alias("suffix_rate"))
    by_domain = domains.join(by_suffix, "suffix").select("domain", shrunk(F.col("suffix_rate"), per_domain).alias("domain_rate"))
    a = F.lit(per_host) * F.col("domain_rate") + F.col("k")
    b = F.lit(per_host) * (1 - F.col("domain_rate")) + F.col("n") - F.col("k")
    mean = a / (a + b)
    deviation = F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))
    return hosts.join(by_domain, "domain").select("host", F.col("n").alias("outcomes"), mean.alias("bad_rate"), (mean - z * deviation).alias("bad_rate_bound"))


def judge(pages: DataFrame, outcomes: DataFrame, rules: Sequence[Rule] = RULES, url: str = "url", limit: float = LIMIT, **options: object) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule``, ``verdict`` and ``bad_rate_bound``."""
    base = pages.drop(*RESULTS)
    fit, r_host = free_name(base, "_fit", "r_host")
    known = reputation(pages, outcomes, url=url, **options).select(F.col("host").alias(r_host), "bad_rate_bound")  # type: ignore[arg-type]
    split = base.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))})
    met = split.join(known, F.col("host") == F.col(r_host), "left").withColumn(fit, fitting_rule(F.col("host"), F.col("path"), rules))
    by_method = F.when(F.col("bad_rate_bound") > limit, "block").otherwise("allow")
    return met.select(*base.columns, "host", "path", F.col(f"{fit}.name").alias("rule"), F.coalesce(F.col(f"{fit}.verdict"), by_method).alias("verdict"), "bad_rate_bound")


def keep_allowed(pages: DataFrame, outcomes: DataFrame, **options: object) -> DataFrame:
    return judge(pages, outcomes, **options).where("verdict = 'allow'").select(pages.columns)  # type: ignore[arg-type]
