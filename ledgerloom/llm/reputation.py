"""Host reputation by empirical Bayes, with a list of fixed URL rules on top.

Labelled page outcomes (bad or not) are counted per host. Rates are shrunk from level to level: the
suffix towards the rate of all outcomes, the registered domain towards its suffix, the host towards its
domain. The weight of each level's prior is that of a beta-binomial fitted by moments to the rates one
level below. A host is blocked when the lower bound of its posterior bad share is above the limit.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.components import written

# Public suffixes of two labels under which names are registered. The list covers the commonest ones; under others
# the last label counts as the suffix.
PUBLIC_SUFFIXES = (
    "ac.in", "ac.jp", "ac.nz", "ac.uk", "ac.za", "co.id", "co.il", "co.in", "co.jp", "co.ke", "co.kr", "co.nz", "co.th", "co.uk",
    "co.za", "com.ar", "com.au", "com.br", "com.cn", "com.co", "com.hk", "com.mx", "com.my", "com.ng", "com.pe", "com.ph",
    "com.pk", "com.pl", "com.sg", "com.tr", "com.tw", "com.ua", "com.ve", "com.vn", "edu.au", "edu.cn", "go.jp", "gov.au",
    "gov.br", "gov.cn", "gov.in", "gov.uk", "ne.jp", "net.au", "net.br", "net.cn", "net.nz", "or.jp", "or.kr", "org.au", "org.br",
    "org.cn", "org.nz", "org.uk", "org.za", "sch.uk",
)

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """Fits the host and its subdomains where the path starts with ``path``."""
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class Limits:
    """z: width of the posterior bound in standard deviations; weight: bounds of a prior's weight in outcomes."""
    bad_share: float = 0.25
    z: float = 1.645
    least_weight: float = 1.0
    most_weight: float = 1000.0


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(rest, UPPER, LOWER)


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: tuple[Rule, ...]) -> tuple[Column, Column]:
    """(text, verdict) of the longest rule that fits, null if none does."""
    text = verdict = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        text = F.when(fits, rule.text).otherwise(text)
        verdict = F.when(fits, rule.verdict).otherwise(verdict)
    return text, verdict


def registered(host: Column, suffixes: tuple[str, ...] = PUBLIC_SUFFIXES) -> tuple[Column, Column]:
    """(registered domain, suffix) of a host, without its user, port and last dots.

    A suffix is one of ``suffixes`` or the last label; the domain has one label more. A host that is a suffix is its
    own domain. Addresses in numbers or brackets are their own domain, under the empty suffix.
    """
    bare = F.regexp_replace(F.regexp_replace(host, r"(?s)^.*@", ""), r"(:[0-9]*)?\.*$", "")
    number = bare.rlike(r"^[0-9]+(\.[0-9]+){3}$") | bare.startswith("[")
    two = F.substring_index(bare, ".", -2)
    listed = two.isin(*suffixes)
    domain = F.when(number, bare).when(listed, F.substring_index(bare, ".", -3)).otherwise(two)
    suffix = F.when(number, "").when(listed, two).otherwise(F.substring_index(bare, ".", -1))
    return domain, suffix


def _weight(rates: DataFrame, limits: Limits, name: str) -> DataFrame:
    """One row: the prior weight that fits the spread of ``n, bad`` over units around their parents' share ``mean``.

    The moments of a beta-binomial: the squared deviations of the units exceed what chance gives
    by the share 1 / (weight + 1) of mean (1 - mean).
    """
    chance = F.col("mean") * (1 - F.col("mean"))
    sums = rates.agg(
        F.sum(F.pow(F.col("bad") - F.col("n") * F.col("mean"), 2) - F.col("n") * chance).alias("over"),
        F.sum(F.col("n") * (F.col("n") - 1) * chance).alias("room"))
    rho = F.col("over") / F.col("room")
    weight = F.when((F.col("room") > 0) & (rho > 0), 1 / rho - 1).otherwise(limits.most_weight)
    return sums.select(F.greatest(F.lit(limits.least_weight), F.least(F.lit(limits.most_weight), weight)).alias(name))


def host_reputation(outcomes: DataFrame, limits: Limits = Limits(), suffixes: tuple[str, ...] = PUBLIC_SUFFIXES) -> DataFrame:
    """(host, n, bad, share, bound) of every host in ``outcomes (host, n, bad)``, one row per host.

    n and bad are counts of labelled pages; ``registered`` tells domain and suffix. Without outcomes there are no rows.
    """
    domain, suffix = registered(F.col("host"), suffixes)
    hosts = outcomes.groupBy("host").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).select(
        "host", domain.alias("domain"), suffix.alias("suffix"),
        F.col("n").cast("double").alias("n"), F.col("bad").cast("double").alias("bad"))

    def level(child: DataFrame, key: str, parent: DataFrame, parent_key: str | None, out: str) -> DataFrame:
        """``child (n, bad)`` with ``mean`` of the parent, and the own share shrunk towards it."""
        joined = child.join(parent, parent_key) if parent_key else child.crossJoin(parent)
        weighed = joined.crossJoin(_weight(joined, limits, "weight"))
        return weighed.withColumn(
            out, (F.col("bad") + F.col("weight") * F.col("mean")) / (F.col("n") + F.col("weight")))

    every = hosts.agg(F.sum("n").alias("all_n"), F.sum("bad").alias("all_bad")).select(
        (F.col("all_bad") / F.col("all_n")).alias("mean"))
    suffixes = hosts.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    suffixes = level(suffixes, "suffix", every, None, "share").select("suffix", F.col("share").alias("mean"))
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    domains = level(domains, "domain", suffixes, "suffix", "share").select("domain", F.col("share").alias("mean"))
    judged = level(hosts, "host", domains, "domain", "share")
    spread = F.sqrt(F.col("share") * (1 - F.col("share")) / (F.col("n") + F.col("weight") + 1))
    return judged.select("host", F.col("n").cast("bigint").alias("n"), F.col("bad").cast("bigint").alias("bad"),
                         "share", (F.col("share") - limits.z * spread).alias("bound"))


def judge_urls(pages: DataFrame, outcomes: DataFrame, rules: tuple[Rule, ...], folder: str,
               limits: Limits = Limits(), id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row (page_id, host, path, rule, verdict, n_labelled, bad_share, bad_bound) for every page.

    ``outcomes`` has (page_id, bad boolean), any number of rows per page; rows with a null in either
    column, or of unknown pages, count for nothing. Hosts without outcomes are allowed, as are null
    urls and urls without ``://`` (empty host and path). Repeated pages give repeated rows.

    Outcomes are counted per page, then per host, before either meets the pages. The counts of the hosts,
    which every level of the shrinkage reads, are written once below ``folder``, which all executors share.
    Pages meet the hosts' rows in a plain equi-join, so a host with a third of all pages is split like any
    skewed join.
    """
    parsed = pages.select(F.col(id_col).cast("bigint").alias("page_id"), host_of(F.col(url_col)).alias("host"),
                          path_of(F.col(url_col)).alias("path"))
    counted = (outcomes.where("page_id IS NOT NULL AND bad IS NOT NULL").groupBy("page_id")
               .agg(F.count("*").alias("n"), F.count_if("bad").alias("bad")))
    by_host = (parsed.select("page_id", "host").join(counted, "page_id").groupBy("host")
               .agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")))
    joined = parsed.join(host_reputation(written(by_host, folder, "hosts"), limits), "host", "left")
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("bound") > limits.bad_share, "block").otherwise("allow")
    return joined.select(
        "page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, own).alias("verdict"),
        F.coalesce("n", F.lit(0)).alias("n_labelled"), F.col("share").alias("bad_share"),
        F.col("bound").alias("bad_bound"))
