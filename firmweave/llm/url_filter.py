"""URL rules, and for the pages that no rule covers the reputation of their host.

A page that a rule decides is a labelled outcome of its host (blocked or allowed). Counts of outcomes are shrunk from the
host to its registered domain, from there to the public suffix and from there to all suffixes, by beta-binomial priors. Each
labelled suffix is one observation of the last prior, beside two at one half, so one suffix does not condemn the others. How
strongly each level is pulled to the one above is estimated from the counts themselves: the more the children of a parent
differ, beyond what chance explains, the less. A host is blocked if the lower bound of its posterior block rate is beyond
the threshold, so hosts on which little is known stay. Built-in column functions only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firmweave.llm.common import Stages

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Public suffixes of two labels; any other suffix is the last label.
SUFFIXES = ("ac.uk", "co.uk", "gov.uk", "org.uk", "com.au", "net.au", "org.au", "co.jp", "ne.jp", "or.jp", "com.br", "com.cn", "co.in", "co.kr", "co.nz", "co.za")

#: A host is blocked if its block rate lies above THRESHOLD by Z posterior standard deviations.
THRESHOLD = 0.5
Z = 1.645
#: Intraclass correlation that a level is taken to have before its counts speak, with the weight of PRIOR_WEIGHT pairs of outcomes.
PRIOR_CORRELATION = 0.5
PRIOR_WEIGHT = 1.0
#: Suffixes that count as seen with a block rate of one half.
PRIOR_SUFFIXES = 2.0
CORRELATION_BOUNDS = (0.001, 0.999)
#: A host with at least a HOT_SHARE-th of the rows is joined by broadcast: there are at most so many of them.
HOT_SHARE = 1000


@dataclass(frozen=True)
class Rule:
    """``verdict`` (allow or block) for ``host`` and its subdomains where the path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
)


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; empty without ``://``."""
    return F.translate(F.coalesce(F.regexp_extract(url, "://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def _fits(host: Column, path: Column, rule: Rule) -> Column:
    return ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)


def matched_rule(host: Column, path: Column, rules: tuple[Rule, ...]) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits (host and path together, then the longer host, then block first), else NULL."""
    name = verdict = None
    for rule in sorted(rules, key=lambda r: (-len(r.name), -len(r.host), r.verdict != "block", r.name)):
        fits = _fits(host, path, rule)
        name = F.when(fits, rule.name) if name is None else name.when(fits, rule.name)
        verdict = F.when(fits, rule.verdict) if verdict is None else verdict.when(fits, rule.verdict)
    nothing = F.lit(None).cast("string")
    return (nothing if name is None else name), (nothing if verdict is None else verdict)


def domain_and_suffix(host: Column) -> tuple[Column, Column]:
    """Registered domain (suffix and one label before it) and public suffix of a host without user and port.

    A numeric address is its own domain with an empty suffix."""
    name = F.regexp_replace(F.regexp_replace(host, "^.*@", ""), r"\.?(:[0-9]*)?$", "")
    labels = F.split(name, r"\.")
    two = F.concat_ws(".", F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), 2))
    long = two.isin(*SUFFIXES) & (F.size(labels) >= 2)
    address = name.rlike(r"^[0-9]+(\.[0-9]+){3}$") | name.startswith("[")
    suffix = F.when(address, "").when(long, two).otherwise(F.element_at(labels, -1))
    width = F.when(long, 3).otherwise(2)
    domain = F.concat_ws(".", F.slice(labels, F.greatest(F.size(labels) - width + 1, F.lit(1)), width))
    return F.when(address, name).otherwise(domain), suffix


def _correlation(children: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    """One row (rho): how much children (n, k) of a parent differ in their rate beyond chance, by moments of the beta-binomial."""
    own = children.where("n > 0").select(key, "n", "k")
    rate = parents.where("n > 0").select(key, (F.col("k") / F.col("n")).alias("m"))
    n, k, m = F.col("n").cast("double"), F.col("k").cast("double"), F.col("m")
    chance = m * (1 - m)
    beyond = F.coalesce(F.sum((k - n * m) * (k - n * m) - n * chance), F.lit(0.0))
    pairs = F.coalesce(F.sum(n * (n - 1) * chance), F.lit(0.0))
    rho = (beyond + PRIOR_WEIGHT * PRIOR_CORRELATION) / (pairs + PRIOR_WEIGHT)
    low, high = CORRELATION_BOUNDS
    return own.join(rate, key).agg(F.round(F.least(F.greatest(rho, F.lit(low)), F.lit(high)), 9).alias("rho"))


def _shrunk(children: DataFrame, parents: DataFrame, key: str, rho: DataFrame) -> DataFrame:
    """``children`` with ``mean``: their rate, pulled to the parent's ``mean`` with the weight of (1 - rho) / rho outcomes."""
    weight = (1 - F.col("rho")) / F.col("rho")
    above = parents.select(key, F.col("mean").alias("above")).crossJoin(F.broadcast(rho))  # rho is one row
    mean = (F.col("k") + weight * F.col("above")) / (F.col("n") + weight)
    return children.join(above, key).withColumn("mean", mean).withColumn("weight", weight)


def host_reputation(st: Stages, counts: DataFrame) -> DataFrame:
    """(host, pages, n labelled, k blocked) to (host, pages, n, k, block_rate, block_rate_low)."""
    domain, suffix = domain_and_suffix(F.col("host"))
    hosts = st.save(counts.withColumns({"domain": domain, "suffix": suffix, "every": F.lit(1)}), "hosts")
    sums = [F.sum(c).alias(c) for c in ("n", "k")]
    domains = st.save(hosts.groupBy("domain", "suffix", "every").agg(*sums), "domains")
    suffixes = st.save(domains.groupBy("suffix", "every").agg(*sums), "suffixes")
    rates = F.coalesce(F.sum(F.try_divide("k", "n")), F.lit(0.0))
    mean = (rates + PRIOR_SUFFIXES / 2) / (F.count_if(F.col("n") > 0) + PRIOR_SUFFIXES)
    every = st.save(suffixes.groupBy("every").agg(*sums, F.round(mean, 9).alias("mean")), "every")  # one row
    suffixes = _shrunk(suffixes, every, "every", _correlation(suffixes, every, "every"))
    suffixes = st.save(suffixes.drop("above", "weight"), "suffix-rates")
    domains = _shrunk(domains, suffixes, "suffix", _correlation(domains, suffixes, "suffix"))
    domains = st.save(domains.drop("above", "weight"), "domain-rates")
    hosts = _shrunk(hosts, domains, "domain", _correlation(hosts, domains, "domain"))
    deviation = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("n") + F.col("weight") + 1))
    low = F.greatest(F.col("mean") - Z * deviation, F.lit(0.0))
    return hosts.select("host", "pages", "n", "k", F.col("mean").alias("block_rate"), low.alias("block_rate_low"))


def judge_urls(pages: DataFrame, rules: tuple[Rule, ...] = RULES, threshold: float = THRESHOLD) -> DataFrame:
    """A row per page: page_id, host, path, rule, verdict, host_labelled, host_blocked (outcomes of the host), block_rate_low.

    A null url, or one without ``://``, has an empty host and path and fits no rule; such pages share the reputation of
    the empty host, which has no outcomes, as every host in a table where no rule fits: rate 0.5 with little weight, allowed. Repeated rows are judged each
    and count each as an outcome. Other columns are not carried."""
    with Stages(pages.sparkSession) as st:
        urls = pages.select("page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
        rule, verdict = matched_rule(F.col("host"), F.col("path"), rules)
        ruled = st.save(urls.withColumns({"rule": rule, "by_rule": verdict}), "ruled")
        counts = ruled.groupBy("host").agg(
            F.count("*").alias("pages"), F.count("by_rule").alias("n"), F.count_if(F.col("by_rule") == "block").alias("k")
        )
        hosts = st.save(host_reputation(st, counts), "reputations")
        hot_from = F.greatest(F.ceil(F.sum("pages") / HOT_SHARE), F.lit(1))
        known = hosts.select("host", F.col("n").alias("host_labelled"), F.col("k").alias("host_blocked"), "block_rate_low", "pages")
        marked = st.save(known.crossJoin(F.broadcast(hosts.agg(hot_from.alias("hot_from")))), "marked")  # one row to all
        hot = marked.where("pages >= hot_from").drop("pages", "hot_from")  # at most HOT_SHARE rows
        rest = marked.where("pages < hot_from").drop("pages", "hot_from")
        judged = ruled.join(F.broadcast(hot), "host").unionByName(ruled.join(F.broadcast(hot.select("host")), "host", "left_anti").join(rest, "host"))
        by_host = F.when(F.col("block_rate_low") > threshold, "block").otherwise("allow")
        return st.save(
            judged.select("page_id", "host", "path", "rule", F.coalesce("by_rule", by_host).alias("verdict"), "host_labelled", "host_blocked", F.round("block_rate_low", 6).alias("block_rate_low")),
            "judged",
            keep=True,
        )


def _sql_rules(rules: tuple[Rule, ...], value: str) -> str:
    cases = [
        f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') THEN '{r.name if value == 'rule' else r.verdict}'"
        for r in sorted(rules, key=lambda r: -len(r.name))
    ]
    return f"CASE {' '.join(cases)} END"


def _sql_level(children: str, parents: str, key: str) -> str:
    """Correlation and shrunken means of one level."""
    low, high = CORRELATION_BOUNDS
    return f"""
{children}_rho AS (
  SELECT round(least(greatest(({PRIOR_WEIGHT * PRIOR_CORRELATION} + coalesce(sum(pow(c.k - c.n * p.k / p.n, 2) - c.n * (p.k / p.n) * (1 - p.k / p.n)), 0))
    / ({PRIOR_WEIGHT} + coalesce(sum(c.n * (c.n - 1) * (p.k / p.n) * (1 - p.k / p.n)), 0)), {low}), {high}), 9) AS rho
  FROM {children} c JOIN {parents}_mean p USING ({key}) WHERE c.n > 0 AND p.n > 0
), {children}_mean AS (
  SELECT c.*, (1 - rho) / rho AS weight, (c.k + (1 - rho) / rho * p.mean) / (c.n + (1 - rho) / rho) AS mean
  FROM {children} c JOIN {parents}_mean p USING ({key}) CROSS JOIN {children}_rho
)"""


#: The same over DuckDB's ``pages``.
SQL = f"""
WITH urls AS (
  SELECT page_id, translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), '{UPPER}', '{LOWER}') AS host,
    coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages
), ruled AS (
  SELECT *, {_sql_rules(RULES, "rule")} AS rule, {_sql_rules(RULES, "verdict")} AS by_rule FROM urls
), counted AS (
  SELECT host, CAST(count(by_rule) AS DOUBLE) AS n, CAST(count(*) FILTER (by_rule = 'block') AS DOUBLE) AS k,
    regexp_replace(regexp_replace(host, '^.*@', ''), '\\.?(:[0-9]*)?$', '') AS name
  FROM ruled GROUP BY host
), split AS (
  SELECT *, string_split(name, '.') AS l, regexp_matches(name, '^[0-9]+(\\.[0-9]+){{3}}$') OR starts_with(name, '[') AS address FROM counted
), wide AS (
  SELECT *, array_to_string(l[-2:], '.') IN ({", ".join(f"'{s}'" for s in SUFFIXES)}) AND len(l) >= 2 AS long FROM split
), hosts AS (
  SELECT host, n, k, CASE WHEN address THEN '' WHEN long THEN array_to_string(l[-2:], '.') ELSE l[-1] END AS suffix,
    CASE WHEN address THEN name WHEN long THEN array_to_string(l[-3:], '.') ELSE array_to_string(l[-2:], '.') END AS domain
  FROM wide
), domains AS (
  SELECT domain, suffix, sum(n) AS n, sum(k) AS k FROM hosts GROUP BY domain, suffix
), suffixes AS (
  SELECT suffix, 1 AS every, sum(n) AS n, sum(k) AS k FROM domains GROUP BY suffix
), whole_mean AS (
  SELECT 1 AS every, sum(n) AS n, sum(k) AS k,
    round((coalesce(sum(k / n) FILTER (n > 0), 0) + {PRIOR_SUFFIXES / 2}) / (count(*) FILTER (n > 0) + {PRIOR_SUFFIXES}), 9) AS mean
  FROM suffixes
), {_sql_level("suffixes", "whole", "every")}, {_sql_level("domains", "suffixes", "suffix")}, {_sql_level("hosts", "domains", "domain")}, bounds AS (
  SELECT host, n, k, greatest(mean - {Z} * sqrt(mean * (1 - mean) / (n + weight + 1)), 0) AS low FROM hosts_mean
)
SELECT page_id, r.host, path, rule, coalesce(by_rule, CASE WHEN low > {THRESHOLD} THEN 'block' ELSE 'allow' END) AS verdict,
  CAST(n AS BIGINT) AS host_labelled, CAST(k AS BIGINT) AS host_blocked, round(low, 6) AS block_rate_low
FROM ruled r JOIN bounds b ON r.host = b.host
"""
