"""URL filter: rules first, then empirical-Bayes host reputation.

A page's host and path are cut from its url; the longest rule that fits
decides. What no rule fits is judged by the reputation of its host:

* outcomes of labelled pages (bad or not) are counted per host;
* hosts nest in registered domains, these in suffixes, these in all pages.
  On each step a beta prior has the parent's posterior mean, and a strength
  from the between-group variance of the step (moments of the beta-binomial:
  ``rho``, the correlation of two pages of a group; strength 1 / rho - 1);
* the posterior of a host is Beta(bad + s * m, good + s * (1 - m)). A host is
  blocked when the lower bound of its bad share is over ``LIMIT``: the score
  bound at ``Z`` standard deviations for the mean of that beta and its pages
  (labelled ones and the prior's strength), which also holds for few pages. A
  host without labelled pages has its domain's prior, a domain without any
  that of its suffix, and so on.

So a few bad pages do not block a host of a clean domain, and many do.

Everything is DataFrame functions. Pages are counted per host before they are
shuffled, so a host with a third of all pages is a row a task; the verdicts
(a row a host) are broadcast after a check of their number, and beyond it
joined by a shuffle whose skewed partitions Spark splits.

Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
lower-cased; path: then up to ``?``, ``#`` or the end. The name in a host is
what is left without ``user@`` and ``:port``. Its suffix is the longest of
``suffixes`` (such as ``co.uk``) that it ends with, else its last label; the
registered domain has one label more; an address of digits or a name of one
label is its own domain and suffix.

Defined cases: a null url or one without ``://`` has the empty host and path
and no rule, and counts as a host of its own; a page with several label rows
is bad if one says so; labels without a page, and null ids, count nothing;
repeated page rows are judged and counted one by one; without any labelled
page the bad share is one half with the weakest prior, and nothing is blocked.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.tables import checked_broadcast, written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LIMIT = 0.5  # bad share of a blocked host
Z = 1.645  # the bound holds with about 95 %
WEAKEST, STRONGEST = 2.0, 1e6  # strengths of a prior, in pages


class Rule(NamedTuple):
    """``verdict`` for the host and its subdomains, for paths that start with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


#: Fixed values.
RULES = (Rule("block", "net", "/"), Rule("allow", "example.net", "/en/"), Rule("block", "example.com", "/de/"), Rule("allow", "org", "/fr/"))


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """(text, verdict) of the longest rule that fits (of equal ones the first); nulls without any."""
    text = verdict = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: -len(r.text))[::-1]:  # the longest is asked first
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        text, verdict = F.when(fits, F.lit(r.text)).otherwise(text), F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return text, verdict


def groups_of(host: Column, suffixes: Sequence[str] = ()) -> tuple[Column, Column]:
    """(registered domain, suffix) of a host."""
    name = F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r":[0-9]*$", "")
    suffix = F.regexp_extract(name, r"([^.]*)$", 1)
    for s in sorted(suffixes, key=len):  # the longest is asked last and holds
        suffix = F.when((name == s) | name.endswith("." + s), F.lit(s)).otherwise(suffix)
    before = F.substring(name, F.lit(1), F.greatest(F.length(name) - F.length(suffix) - 1, F.lit(0)))
    domain = F.when(before == "", name).otherwise(F.concat_ws(".", F.regexp_extract(before, r"([^.]*)$", 1), suffix))
    address = name.rlike(r"^[0-9.]+$|^\[")
    return F.when(address, name).otherwise(domain), F.when(address, name).otherwise(suffix)


def _strength(children: DataFrame, *key: str) -> float:
    """Strength of the prior that groups (n, k) of a step have from the sums
    over ``key``, by moments: one row is collected."""
    sums = children.groupBy(*key).agg(
        F.sum("n").alias("pn"), F.sum("k").alias("pk"), F.sum(F.col("k") * F.col("k") / F.col("n")).alias("kk"), F.sum(F.col("n") * F.col("n")).alias("nn"), (F.count("*") - 1).alias("df")
    )
    p = F.col("pk") / F.col("pn")
    off = (F.col("kk") - F.col("pk") * p) / (p * (1 - p))  # sum of n * (k / n - p)^2 over p * (1 - p)
    r = sums.where("pk > 0 and pk < pn").agg(F.sum(off).alias("z"), F.sum("df").alias("df"), F.sum(F.col("pn") - F.col("nn") / F.col("pn")).alias("room")).first()
    if not r["df"] or r["room"] - r["df"] <= 0:
        return WEAKEST
    rho = (r["z"] - r["df"]) / (r["room"] - r["df"])
    return STRONGEST if rho <= 0 else min(max(1 / rho - 1, WEAKEST), STRONGEST)


def _shrunk(groups: DataFrame, prior: Column, strength: float) -> Column:
    """Posterior mean of the bad share."""
    return (F.coalesce("k", F.lit(0)) + strength * prior) / (F.coalesce("n", F.lit(0)) + strength)


def reputations(hosts: DataFrame, suffixes: Sequence[str] = (), z: float = Z) -> DataFrame:
    """(host, n, k, bad_share, bad_bound) of every row of ``hosts`` (host, n:
    labelled pages, k: bad ones; both may be 0): the posterior of its bad share."""
    domain, suffix = groups_of(F.col("host"), suffixes)
    hosts = written(hosts.select("host", "n", "k", domain.alias("domain"), suffix.alias("suffix")), "hosts")
    seen = hosts.where("n > 0")
    sums = lambda df, *keys: df.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    by_domain = sums(seen, "suffix", "domain")
    by_suffix = sums(by_domain, "suffix")
    every = sums(by_suffix).first()
    mean = ((every["k"] or 0) + 0.5) / ((every["n"] or 0) + 1)
    s_suffix, s_domain, s_host = _strength(by_suffix), _strength(by_domain, "suffix"), _strength(seen, "suffix", "domain")

    suffixes_ = hosts.select("suffix").distinct().join(by_suffix, "suffix", "left").select("suffix", _shrunk(by_suffix, F.lit(mean), s_suffix).alias("m_suffix"))
    domains = hosts.select("suffix", "domain").distinct().join(by_domain, ["suffix", "domain"], "left").join(suffixes_, "suffix")
    domains = domains.select("domain", "suffix", _shrunk(by_domain, F.col("m_suffix"), s_domain).alias("m_domain"))
    share = _shrunk(hosts, F.col("m_domain"), s_host)
    m, pages = F.col("bad_share"), F.col("n") + s_host
    bound = (m + z * z / (2 * pages) - z * F.sqrt(m * (1 - m) / pages + z * z / (4 * pages * pages))) / (1 + z * z / pages)
    return hosts.join(domains, ["suffix", "domain"]).withColumn("bad_share", share).select("host", "n", "k", "bad_share", bound.alias("bad_bound"))


def filter_urls(
    pages: DataFrame, outcomes: DataFrame, rules: Sequence[Rule] = RULES, suffixes: Sequence[str] = (), limit: float = LIMIT, z: float = Z
) -> DataFrame:
    """(page_id, host, path, rule, verdict, bad_share, bad_bound) for each row of
    ``pages`` (page_id, url); ``outcomes`` (page_id, bad boolean) are the labels."""
    rows = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    bad = outcomes.where("page_id is not null and bad is not null").groupBy("page_id").agg(F.max("bad").alias("bad"))
    counted = rows.select("page_id", "host").join(bad, "page_id", "left").groupBy("host")
    hosts = counted.agg(F.count("bad").alias("n"), F.count_if("bad").alias("k"))
    of_host = checked_broadcast(written(reputations(hosts, suffixes, z).select("host", "bad_share", "bad_bound"), "reputations"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    by_method = F.when(F.col("bad_bound") > limit, "block").otherwise("allow")
    return rows.join(of_host, "host").select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, by_method).alias("verdict"), "bad_share", "bad_bound")


def label_outcomes(labels: DataFrame) -> DataFrame:
    """Outcomes of pages from ``labels`` (doc_id, quality, toxic): the label rows
    of a page are those with its number; bad is toxic or of quality 0."""
    bad = F.coalesce(F.col("toxic") == 1, F.lit(False)) | F.coalesce(F.col("quality") == 0, F.lit(False))
    return labels.where("toxic is not null or quality is not null").select(F.col("doc_id").alias("page_id"), bad.alias("bad"))
