"""Operator 4: empirical-Bayes host reputation and path rules for urls. DataFrame functions only.

Labelled page outcomes are counted by host and shrunk through beta-binomial priors: the suffix towards all
pages, the registered domain towards its suffix, the host towards its domain. How strongly each level pulls
is estimated from the data (intra-class correlation by moments). A host is blocked when the lower posterior
bound of its share of bad pages lies above a limit.

Defined cases: a null url or one without "://" has an empty host and path and no rule; it is judged by the
pages that share the empty host. A null outcome isn't counted. Unknown hosts get their domain's prior. An
empty table gives an empty result. Repeated rows are judged each. Other columns of the input are not read.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

#: Suffixes of two labels that count as one; a parameter, as the full public list isn't needed here.
TWO_LABEL_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "com.au", "com.br", "co.jp", "co.nz", "co.za")


def host_of(url: Column) -> Column:
    got = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit(""))
    return F.translate(got, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def suffix_of(host: Column, two_label=TWO_LABEL_SUFFIXES) -> Column:
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(*two_label), two).otherwise(F.substring_index(host, ".", -1))


def domain_of(host: Column, two_label=TWO_LABEL_SUFFIXES) -> Column:
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(*two_label), F.substring_index(host, ".", -3)).otherwise(two)


def match_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits; rules are ("allow" or "block", "host/path") pairs."""
    rule = verdict = F.lit(None).cast("string")
    for action, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        at, slash, rest = text.partition("/")
        fits = ((host == at) | host.endswith("." + at)) & path.startswith(slash + rest)
        rule = F.when(fits, F.lit(text)).otherwise(rule)
        verdict = F.when(fits, F.lit(action)).otherwise(verdict)
    return rule, verdict


def _shrink(groups: DataFrame, key: str, parent: str, prior: DataFrame | None, mean: float) -> DataFrame:
    """Posterior of each group of one level: columns key, p_mean, alpha, beta, with n and bad kept."""
    if prior is None:
        with_prior = groups.withColumn("m", F.lit(mean))
    else:
        with_prior = groups.join(prior.select(F.col(parent), F.col("p_mean").alias("m")), parent, "left")
    m = F.greatest(F.least(F.col("m"), F.lit(1 - 1e-6)), F.lit(1e-6))
    with_prior = with_prior.withColumn("m", m)
    rate = F.col("bad") / F.col("n")
    got = with_prior.where("n > 0").agg(
        F.sum(F.col("n") * F.pow(rate - F.col("m"), 2) / (F.col("m") * (1 - F.col("m")))).alias("spread"),
        F.count("*").alias("g"),
        F.sum("n").alias("n"),
    ).first()
    free = (got["n"] or 0) - got["g"]
    rho = ((got["spread"] or 0.0) - got["g"]) / free if free > 0 else 0.0
    rho = round(min(max(rho, 1e-3), 0.9), 9)
    strength = 1 / rho - 1
    return (
        with_prior.withColumn("alpha", F.col("m") * strength + F.col("bad"))
        .withColumn("beta", (1 - F.col("m")) * strength + F.col("n") - F.col("bad"))
        .withColumn("p_mean", F.col("alpha") / (F.col("alpha") + F.col("beta")))
    )


def host_reputation(outcomes: DataFrame, z: float = 1.645) -> DataFrame:
    """One row for each host of outcomes (host string, bad int or null): n, bad, p_mean, p_low, p_high."""
    hosts = outcomes.groupBy("host").agg(
        F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")
    )
    hosts = materialize(hosts, "hosts")  # the pages are read and judged once
    hosts = hosts.withColumn("domain", domain_of(F.col("host"))).withColumn("suffix", suffix_of(F.col("host")))
    sums = [F.sum("n").alias("n"), F.sum("bad").alias("bad")]
    domains = hosts.groupBy("domain", "suffix").agg(*sums)
    suffixes = domains.groupBy("suffix").agg(*sums)
    total = hosts.agg(*sums).first()
    mean = ((total["bad"] or 0) + 1) / ((total["n"] or 0) + 2)
    by_suffix = _shrink(suffixes, "suffix", "", None, mean)
    by_domain = _shrink(domains, "domain", "suffix", by_suffix, mean)
    by_host = _shrink(hosts, "host", "domain", by_domain, mean)
    a, b = F.col("alpha"), F.col("beta")
    sd = F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))
    return by_host.select(
        "host", "n", "bad", "p_mean",
        F.greatest(F.col("p_mean") - z * sd, F.lit(0.0)).alias("p_low"),
        F.least(F.col("p_mean") + z * sd, F.lit(1.0)).alias("p_high"),
    )


def url_verdicts(
    pages: DataFrame, rules: list[tuple[str, str]], outcome: Column, limit: float = 0.1, z: float = 1.645,
    key: str = "page_id", url: str = "url",
) -> DataFrame:
    """One row for each page: key, host, path, rule, verdict, bad_rate, bad_low.

    outcome is 1 for a bad page, 0 for a good one, null if not labelled.
    """
    judged = pages.select(host_of(F.col(url)).alias("host"), outcome.cast("long").alias("bad"))
    known = host_reputation(judged, z)
    urls = pages.select(F.col(key), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    rule, verdict = match_rule(F.col("host"), F.col("path"), rules)
    by_bound = F.when(F.col("p_low") > limit, F.lit("block")).otherwise(F.lit("allow"))
    return urls.join(known, "host", "left").select(
        key, "host", "path", rule.alias("rule"), F.coalesce(verdict, by_bound).alias("verdict"),
        F.round("p_mean", 6).alias("bad_rate"), F.round("p_low", 6).alias("bad_low"),
    )


def page_outcome(html: Column, junk_share: float = 0.03) -> Column:
    """1 if over junk_share of a page's visible text is symbols, 0 if not; null without visible text."""
    seen = F.regexp_replace(html, r"(?s)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<[^>]*>|&[a-z]+;", " ")
    rest = F.length(F.translate(seen, "$%*#!|", ""))
    size = F.length(seen)
    return F.when(size > 0, F.when((size - rest) > junk_share * size, 1).otherwise(0))
