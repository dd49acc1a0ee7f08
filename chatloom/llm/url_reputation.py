"""URL rules and empirical-Bayes reputation of hosts.

Labelled page outcomes (bad or not) are counted by host. A host's rate of bad pages is shrunk to that of its registered
domain, which is shrunk to its suffix, which is shrunk to all pages. How strongly is estimated from the data at each level
by the moments of the beta-binomial: groups that differ more than chance are shrunk less. A host is blocked if the lower
bound of its posterior rate is above a limit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatloom.llm.common import stored

#: A prior is worth this many pages at least, so that one page alone decides nothing.
_LEAST_WEIGHT = 2.0

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column | str) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of *url*; both empty where it is NULL or holds no ``://``."""
    url = F.col(url) if isinstance(url, str) else url
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*).*$"
    at = [F.coalesce(F.regexp_extract(url, pattern, i), F.lit("")) for i in (1, 2)]
    return F.translate(at[0], _UPPER, _LOWER), at[1]


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """``(rule, verdict)`` of the longest of *rules* ``(verdict, "host/path")`` that fits, else NULL.

    A rule fits its host and all subdomains, if the path starts with the rule's. The list is a setting, not data.
    """
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, text in sorted(rules, key=lambda r: len(r[1])):
        rule_host, slash, rest = text.partition("/")
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(slash + rest)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, kind).otherwise(verdict)
    return rule, verdict


def _domain(host: Column) -> Column:
    return F.substring_index(host, ".", -2)


def _suffix(host: Column) -> Column:
    return F.substring_index(host, ".", -1)


def _shrunk(groups: DataFrame) -> tuple[DataFrame, float]:
    """Adds ``rate``, shrunk to ``parent`` (the rate expected), to groups of ``n`` and ``bad``; also the prior's weight in pages."""
    spread = F.col("parent") * (1 - F.col("parent"))
    seen, chance, scale = groups.agg(
        F.sum((F.col("bad") - F.col("n") * F.col("parent")) ** 2),
        F.sum(F.col("n") * spread),
        F.sum(F.col("n") * (F.col("n") - 1) * spread),
    ).first()
    alike = (seen - chance) / scale if scale else 0.0
    weight = 1 / min(max(alike, 0.001), 1 / (1 + _LEAST_WEIGHT)) - 1
    return groups.withColumn("rate", (F.col("bad") + weight * F.col("parent")) / (F.col("n") + weight)), weight


def host_reputation(outcomes: DataFrame, z: float = 1.645) -> DataFrame:
    """``(host, n, bad, rate, bound)`` for each host of *outcomes* ``(host, bad)``.

    *rate* is the posterior mean, *bound* the lower bound *z* standard deviations below it. NULL outcomes do not count; NULL
    and empty hosts are one host without name.
    """
    known = outcomes.where(F.col("bad").isNotNull())
    hosts = known.groupBy(F.coalesce("host", F.lit("")).alias("host")).agg(
        F.count("*").cast("double").alias("n"), F.sum(F.col("bad").cast("double")).alias("bad")
    )
    hosts = hosts.select("host", _domain(F.col("host")).alias("domain"), _suffix(F.col("host")).alias("suffix"), "n", "bad")
    hosts = stored(hosts, "hosts")
    sums = (F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    domains = hosts.groupBy("domain", "suffix").agg(*sums)
    suffixes = domains.groupBy("suffix").agg(*sums)
    n, bad = hosts.agg(*sums).first()
    overall = ((bad or 0) + 1) / ((n or 0) + 2)
    suffixes, _ = _shrunk(suffixes.withColumn("parent", F.lit(overall)))
    domains, _ = _shrunk(domains.join(suffixes.select("suffix", F.col("rate").alias("parent")), "suffix"))
    found, weight = _shrunk(hosts.join(domains.select("domain", F.col("rate").alias("parent")), "domain"))
    deviation = F.sqrt(F.col("rate") * (1 - F.col("rate")) / (F.col("n") + weight + 1))
    return found.select("host", "n", "bad", "rate", (F.col("rate") - z * deviation).alias("bound"))


def judge_urls(
    df: DataFrame,
    outcomes: DataFrame,
    rules: list[tuple[str, str]],
    id_column: str = "page_id",
    url_column: str = "url",
    max_bad: float = 0.5,
    z: float = 1.645,
) -> DataFrame:
    """``(id, host, path, rule, verdict, bound)`` for each row: the rule's verdict, else that of the host's reputation.

    A host without outcomes, so also a NULL, empty or broken url, is allowed; *bound* is NULL then. Repeated rows
    repeat, other columns are not read.
    """
    host, path = host_and_path(url_column)
    rows = df.select(F.col(id_column), host.alias("host"), path.alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    rows = rows.select("*", rule.alias("rule"), verdict.alias("by_rule"))
    judged = rows.join(host_reputation(outcomes, z).select("host", "bound"), "host", "left")
    by_host = F.when(F.col("bound") > max_bad, "block").otherwise("allow")
    return judged.select(
        id_column, "host", "path", "rule", F.coalesce("by_rule", by_host).alias("verdict"), "bound"
    )
