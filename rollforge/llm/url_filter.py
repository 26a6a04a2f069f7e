"""URL filtering by empirical-Bayes host reputation, in DataFrame functions only.

Labelled pages give each host a count of bad outcomes. Rates are shrunk down
the levels all pages, suffix, registered domain, host: each level's prior is a
beta with the parent's posterior mean, and with the variance of that mean plus
the children's own spread, which is fitted to their rates. A host is blocked when the lower posterior
bound of its bad rate is over the limit.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollforge.llm.common import attach, table
from rollforge.plans.storage import materialize

# Public suffixes of two labels that the registered domain is cut after.
LONG_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "net.au", "org.au", "co.jp", "or.jp", "co.nz",
                 "com.br", "com.cn", "co.in", "co.za", "com.mx", "com.tr")
LIMIT = 0.5
Z = 1.96


@dataclass(frozen=True)
class Rule:
    """``allow`` or block what lies under host (and its subdomains) and path."""

    host: str
    path: str
    allow: bool

    @property
    def name(self) -> str:
        return f"{self.host}{self.path}"


# The rules the query is given.
RULES = (
    Rule("com", "/", True),
    Rule("example.com", "/en/", False),
    Rule("www.example.com", "/en/", True),
    Rule("net", "/es/", False),
    Rule("net", "/fr/", False),
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(
        F.regexp_extract(rest, r"\A([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    )
    return host, F.regexp_extract(rest, r"\A[^/?#]*([^?#]*)", 1)


def longest_rule(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """Name and verdict of the longest fitting rule, null if none fits. Of two
    rules of one length the first in the order of their names wins."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (-len(r.name), r.name), reverse=True):
        fits = ((host == r.host) | host.endswith(f".{r.host}")) & path.startswith(r.path)
        name = F.when(fits, r.name).otherwise(name)
        verdict = F.when(fits, "allow" if r.allow else "block").otherwise(verdict)
    return name, verdict


def levels(host: Column) -> tuple[Column, Column]:
    """Registered domain and suffix of a host; an address is its own domain."""
    bare = F.regexp_replace(F.regexp_replace(host, r"\A.*@", ""), r":[0-9]*\z", "")
    parts = F.split(bare, r"\.")
    last = F.element_at(parts, -1)
    tail2 = F.concat_ws(".", F.slice(parts, F.greatest(F.lit(1), F.size(parts) - 1), F.lit(2)))
    tail3 = F.concat_ws(".", F.slice(parts, F.greatest(F.lit(1), F.size(parts) - 2), F.lit(3)))
    long = tail2.isin(*LONG_SUFFIXES)
    address = last.rlike(r"\A[0-9]+\z") | bare.contains("]")
    return (
        F.when(address, bare).when(long, tail3).otherwise(tail2),
        F.when(address, F.lit("")).when(long, tail2).otherwise(last),
    )


def strength(children: DataFrame) -> float:
    """Prior strength (pseudo-observations) of a level from its children's
    labelled counts n, bad and their parent's rate, by matching the moments of
    the beta-binomial; 1 to 1000."""
    labelled = children.where(F.col("n") > 0)
    p = F.col("parent_rate")
    row = labelled.agg(
        F.sum(F.col("n") * F.pow(F.col("bad") / F.col("n") - p, 2)).alias("spread"),
        F.sum(p * (1 - p)).alias("single"),
        F.sum(p * (1 - p) * (F.col("n") - 1)).alias("extra"),
    ).first()
    if not row["extra"] or row["extra"] <= 0:
        return 1.0
    correlation = min(1.0, max(0.0, (row["spread"] - row["single"]) / row["extra"]))
    return 1000.0 if correlation <= 0 else min(1000.0, max(1.0, 1 / correlation - 1))


def reputation(hosts: DataFrame, z: float = Z, limit: float = LIMIT) -> DataFrame:
    """``hosts`` (host, n labelled, bad) with the posterior ``rate``, its bounds
    ``low`` and ``high``, and ``blocked``. Hosts without labels get their
    domain's rate with wide bounds; without any label nothing is blocked."""
    domain, suffix = levels(F.col("host"))
    base = materialize(hosts.withColumn("domain", domain).withColumn("suffix", suffix), "hosts")
    count = [F.sum("n").alias("n"), F.sum("bad").alias("bad")]
    total, bad = base.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("bad"), F.lit(0))).first()
    root = (bad + 0.5) / (total + 1.0)

    def shrink(children: DataFrame) -> DataFrame:
        fitted = strength(children)
        m = F.col("parent_rate")
        # a beta(m, s) around an uncertain m: the variances add up
        variance = m * (1 - m) / (fitted + 1) + F.col("parent_variance") * (fitted / (fitted + 1))
        s = F.greatest(F.lit(0.5), m * (1 - m) / variance - 1)
        alpha = m * s + F.col("bad")
        beta = (1 - m) * s + F.col("n") - F.col("bad")
        return children.withColumn("rate", alpha / (alpha + beta)).withColumn(
            "sd", F.sqrt(alpha * beta / (F.pow(alpha + beta, 2) * (alpha + beta + 1)))
        )

    of_parent = [F.col("rate").alias("parent_rate"), F.pow("sd", F.lit(2.0)).alias("parent_variance")]
    by_suffix = base.groupBy("suffix").agg(*count, F.count(F.lit(1)).alias("hosts"))
    by_suffix = materialize(shrink(by_suffix.withColumn("parent_rate", F.lit(root)).withColumn(
        "parent_variance", F.lit(root * (1 - root) / (total + 2.0))
    )), "suffixes")
    by_domain = base.groupBy("suffix", "domain").agg(*count, F.count(F.lit(1)).alias("hosts"))
    parents = by_suffix.select("suffix", *of_parent, F.col("hosts").alias("of"))
    by_domain = materialize(shrink(attach(by_domain, parents, ["suffix"], "of").drop("of")), "domains")
    parents = by_domain.select("suffix", "domain", *of_parent, F.col("hosts").alias("of"))
    found = shrink(attach(base, parents, ["suffix", "domain"], "of").drop("of"))
    low, high = F.greatest(F.lit(0.0), F.col("rate") - z * F.col("sd")), F.least(F.lit(1.0), F.col("rate") + z * F.col("sd"))
    return found.withColumn("low", low).withColumn("high", high).withColumn(
        "blocked", (F.col("low") > limit) & F.lit(total > 0)
    )


def judge(
    pages: DataFrame, rules: Sequence[Rule] = RULES, outcome: str | None = None, z: float = Z, limit: float = LIMIT,
    id_col: str = "page_id", url: str = "url",
) -> DataFrame:
    """One row per row of ``pages``: page_id, host, path, rule, verdict, and the
    host's posterior rate and bound.

    ``outcome`` names a column with 1 (bad), 0 (good) or null (unlabelled);
    without it a page that a rule decides is labelled by that rule. A null url
    or one without ``://`` has an empty host and path. Repeated rows are rows
    like others; an empty table gives no rows; other columns are ignored.
    """
    host, path = host_and_path(F.col(url))
    cut = pages.select(
        F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"),
        (F.col(outcome).cast("double") if outcome else F.lit(None).cast("double")).alias("outcome"),
    )
    name, verdict = longest_rule(F.col("host"), F.col("path"), rules)
    ruled = cut.withColumn("rule", name).withColumn("by_rule", verdict)
    if outcome is None:
        ruled = ruled.withColumn("outcome", F.when(F.col("by_rule") == "block", 1.0).when(F.col("by_rule") == "allow", 0.0))
    ruled = materialize(ruled, "ruled")
    hosts = ruled.groupBy("host").agg(
        F.count("outcome").alias("n"), F.coalesce(F.sum("outcome"), F.lit(0.0)).alias("bad"),
        F.count(F.lit(1)).alias("pages"),
    )
    known = materialize(reputation(hosts, z, limit).select("host", "pages", "rate", "low", "blocked"), "reputation")
    return attach(ruled, known, ["host"], "pages").select(
        "page_id", "host", "path", "rule",
        F.coalesce(F.col("by_rule"), F.when(F.col("blocked"), "block").otherwise("allow")).alias("verdict"),
        F.col("rate").alias("host_rate"), F.col("low").alias("host_low"),
    )


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages")).drop("host_rate", "host_low")
