"""URL filter: explicit rules first, then empirical-Bayes host reputation.

Every page has a labelled outcome (bad or not). Outcomes are counted per
host and shrunk through a chain of beta-binomial priors: the corpus rate is
the prior of a suffix (``net``), the suffix of a registered domain
(``example.net``), the domain of a host. The concentration of each level's
prior is the moment estimate from that level's counts. A host is blocked
when the lower bound of its posterior bad rate passes ``max_bad_rate``; few
bad pages on a small host are therefore not enough.

DataFrame functions only. Counting combines map-side, so a host with a
third of all pages is one row per task after that; the host table is written
once, and its join back to the pages is a join of two scanned tables, which
AQE splits at a hot host.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aevia.llm.common import ascii_lower, saved


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (
    Rule("net", "/", "block"),
    Rule("example.net", "/en/", "allow"),
    Rule("example.com", "/de/", "block"),
    Rule("org", "/fr/", "allow"),
)

MAX_BAD_RATE = 0.25
Z = 1.645
CONCENTRATION = (2.0, 1000.0)
BAD_SYMBOL_SHARE = 0.03


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host_of(url: Column) -> Column:
    return F.coalesce(ascii_lower(F.regexp_extract(_after_scheme(url), "^[^/?#]*", 0)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_after_scheme(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_for(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits, or null."""
    name = verdict = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        name = F.when(fits, r.name).otherwise(name)
        verdict = F.when(fits, r.verdict).otherwise(verdict)
    return name, verdict


def bad_outcome(html: Column) -> Column:
    """1 for a page whose visible characters hold more than a share of
    ``BAD_SYMBOL_SHARE`` junk symbols, else 0 (null or blank pages too)."""
    seen = F.regexp_replace(F.coalesce(html, F.lit("")), "<[^>]*>", "")
    junk = F.length(seen) - F.length(F.regexp_replace(seen, "[#*$%|!]", ""))
    return (junk > BAD_SYMBOL_SHARE * F.length(seen)).cast("long")


def _concentration(groups: DataFrame) -> tuple[float, float]:
    """Corpus rate and prior concentration of a level, by moments: one row."""
    r = groups.agg(F.count("*").alias("g"), F.sum("n").alias("n"), F.sum("k").alias("k"),
                   F.sum(F.col("k") * F.col("k") / F.col("n")).alias("q")).first()
    if not r["n"]:
        return 0.5, CONCENTRATION[0]
    m = (r["k"] + 1.0) / (r["n"] + 2.0)
    between = (r["q"] - 2 * m * r["k"] + m * m * r["n"]) / r["n"] - m * (1 - m) * r["g"] / r["n"]
    s = m * (1 - m) / between - 1 if between > 0 else CONCENTRATION[1]
    return m, min(max(s, CONCENTRATION[0]), CONCENTRATION[1])


def host_reputation(outcomes: DataFrame) -> DataFrame:
    """``(host, n, k, bad_rate, bad_bound)`` from ``(host, bad)`` rows:
    pages, bad pages, posterior mean and lower bound of the bad rate."""
    hosts = saved(outcomes.groupBy("host").agg(F.count("*").alias("n"), F.sum("bad").alias("k")), "op9-hosts")
    hosts = hosts.withColumn("domain", F.substring_index("host", ".", -2))
    domains = saved(hosts.groupBy("domain").agg(F.sum("n").alias("n"), F.sum("k").alias("k")), "op9-domains")
    domains = domains.withColumn("suffix", F.substring_index("domain", ".", -1))
    suffixes = saved(domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k")), "op9-suffixes")
    m0, s0 = _concentration(suffixes)
    _, s1 = _concentration(domains)
    _, s2 = _concentration(hosts)

    def shrunk(prior: Column, s: float) -> Column:
        return (F.col("k") + s * prior) / (F.col("n") + s)

    up = suffixes.select("suffix", shrunk(F.lit(m0), s0).alias("prior"))
    mid = domains.join(up, "suffix").select("domain", shrunk(F.col("prior"), s1).alias("prior"))
    total = F.col("n") + s2 + 1
    return (
        hosts.join(mid, "domain")
        .withColumn("bad_rate", shrunk(F.col("prior"), s2))
        .withColumn("bad_bound", F.col("bad_rate") - Z * F.sqrt(F.col("bad_rate") * (1 - F.col("bad_rate")) / total))
        .select("host", "n", "k", "bad_rate", "bad_bound")
    )


def filter_urls(pages: DataFrame, rules=RULES, max_bad_rate: float = MAX_BAD_RATE) -> DataFrame:
    """One row per page of ``pages(page_id, url, html)``: page_id, host,
    path, rule, verdict, bad_bound.

    A null url or one without ``://`` has empty host and path and is judged
    by the reputation of the empty host. A null page counts as not bad.
    Repeated rows stay, each with its verdict; an empty table gives an empty
    result; further columns of ``pages`` are not read.
    """
    urls = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    outcomes = pages.select(host_of(F.col("url")).alias("host"), bad_outcome(F.col("html")).alias("bad"))
    hosts = saved(host_reputation(outcomes).select("host", "bad_bound"), "op9-reputation")
    name, verdict = rule_for(F.col("host"), F.col("path"), rules)
    learned = F.when(F.col("bad_bound") > max_bad_rate, "block").otherwise("allow")
    return urls.join(hosts, "host").select(
        "page_id", "host", "path", name.alias("rule"), F.coalesce(verdict, learned).alias("verdict"), "bad_bound")
