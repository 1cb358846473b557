"""URL filters: listed rules first, then the reputation of hosts learned from labelled pages.

A host's share of bad pages is shrunk towards that of its registered domain, the domain's towards that of its suffix, the
suffix's towards the share overall. Each level has a beta prior around its parent's estimate, with a concentration fitted to
the labelled counts by moments of the beta-binomial. A host is blocked if the lower bound of its posterior is above a limit.
Only built-in functions; one row per level comes to the driver.

Names are registered under the suffixes of the public suffix list (publicsuffix.org, under the Mozilla Public License 2.0), its
wildcards, exceptions and private domains included. The copy beside this module is the one of February 2023. An address in
numbers has no registered domain: its share is shrunk towards the share overall.
"""

from __future__ import annotations

from collections.abc import Sequence
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F



def _listed() -> frozenset[str]:
    """The rules of the public suffix list, names in other scripts as they are and in ASCII."""
    lines = Path(__file__).with_name("public_suffix_list.dat").read_text("utf-8").splitlines()
    rules = {x.split()[0] for x in lines if x.strip() and not x.startswith("//")}
    return frozenset(rules | {x.encode("idna").decode() for x in rules if not x.isascii()})


SUFFIX_RULES = _listed()
MOST_LABELS = max(x.count(".") for x in SUFFIX_RULES) + 1
#: Suffixes of several labels under which names are registered; others have one label.
LONG_SUFFIXES = frozenset(x for x in SUFFIX_RULES if "." in x and x[0] not in "*!")
ADDRESS = r"^(?:[0-9]{1,3}(?:\.[0-9]{1,3}){3}|\[.*\])$"
LIMIT = 0.5
DEVIATIONS = 1.645
CONCENTRATION = (1.0, 10_000.0)


def host_of(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z lower-cased; empty without ://."""
    found = F.regexp_extract(url, r"^(?s).*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ?, # or the end; empty without ://."""
    return F.coalesce(F.regexp_extract(url, r"^(?s).*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest of `rules` ((verdict, "host/path"), ...) that fits, null if none does.

    A rule fits its host and all subdomains if the path starts with its own; of two of one length the longer host wins.
    """
    rule = verdict = F.lit(None).cast("string")
    for what, name in sorted(rules, key=lambda r: (len(r[1]), r[1].index("/"))):
        own_host, own_path = name[:name.index("/")], name[name.index("/"):]
        fits = ((host == own_host) | host.endswith("." + own_host)) & path.startswith(own_path)
        rule, verdict = F.when(fits, name).otherwise(rule), F.when(fits, what).otherwise(verdict)
    return rule, verdict


def _levels(hosts: DataFrame) -> DataFrame:
    """`hosts` (host, n, bad), one row for each host, with the registered domain and the suffix; the port is left out.

    The suffix is that of the rule with the most labels, an exception before all others; without any it is the last label. A host
    that is a suffix is its own domain. An address is its own domain and has no suffix.
    """
    name = F.regexp_replace("host", r":[0-9]*$", "")
    labels = F.split(name, r"\.")
    last = lambda k: F.array_join(F.slice(labels, F.greatest(F.size(labels) - k + 1, F.lit(1)), k), ".")
    tails = F.transform(F.sequence(F.lit(1), F.least(F.size(labels), F.lit(MOST_LABELS))), lambda k: F.array(
        F.struct(last(k).alias("rule"), F.lit(False).alias("excepted"), k.alias("labels")),
        F.struct(F.concat(F.lit("*."), last(k - 1)).alias("rule"), F.lit(False).alias("excepted"), k.alias("labels")),
        F.struct(F.concat(F.lit("!"), last(k)).alias("rule"), F.lit(True).alias("excepted"), (k - 1).alias("labels"))))
    rules = hosts.sparkSession.createDataFrame(pa.table({"rule": sorted(SUFFIX_RULES)})).withColumn("listed", F.lit(True))
    tried = hosts.select("host", "n", "bad", F.explode(F.flatten(tails)).alias("t")).select("host", "n", "bad", "t.*")
    found = tried.join(F.broadcast(rules), "rule", "left").groupBy("host", "n", "bad").agg(
        F.max(F.when(F.col("listed"), F.struct("excepted", "labels"))).alias("best"))
    address = name.rlike(ADDRESS)
    found = found.withColumn("k", F.coalesce("best.labels", F.lit(1)))
    return found.select(
        "host", "n", "bad", F.when(address, name).otherwise(last(F.col("k") + 1)).alias("domain"),
        F.when(~address, last(F.col("k"))).alias("suffix"))


def _concentration(units: DataFrame) -> float:
    """Of a beta prior with mean `mean` over rows (n, bad, mean), by moments."""
    spread = F.sum((F.col("bad") - F.col("n") * F.col("mean")) ** 2 - F.col("n") * F.col("mean") * (1 - F.col("mean")))
    scale = F.sum(F.col("n") * (F.col("n") - 1) * F.col("mean") * (1 - F.col("mean")))
    over, under = units.agg(spread, scale).first()
    low, high = CONCENTRATION
    if not under or not over or over <= 0:
        return high
    return min(max(under / over - 1, low), high)


def reputations(outcomes: DataFrame, hosts: DataFrame) -> DataFrame:
    """(host, n, bad, mean, lower) for each of `hosts` (host), from `outcomes` (host, bad: boolean).

    `mean` is the posterior share of bad pages, `lower` its lower bound. A host without outcomes has its domain's share.
    Rows with a null outcome count for nothing; without any outcome the share is one half.
    """
    seen = outcomes.where(F.col("host").isNotNull() & F.col("bad").isNotNull()).groupBy("host").agg(
        F.count("*").alias("n"), F.sum(F.col("bad").cast("long")).alias("bad"))
    counts = _levels(hosts.select("host").distinct().join(seen, "host", "full").select(
        "host", F.coalesce("n", F.lit(0).cast("long")).alias("n"), F.coalesce("bad", F.lit(0).cast("long")).alias("bad")))
    n, bad = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("bad"), F.lit(0))).first()
    mean = F.lit((bad + 0.5) / (n + 1.0))

    domains = counts.where("suffix is not null").groupBy("suffix", "domain").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).withColumn("mean", mean)

    def posterior(units: DataFrame) -> tuple[DataFrame, float]:
        k = _concentration(units)
        return units.withColumn("mean", (k * F.col("mean") + F.col("bad")) / (k + F.col("n"))), k

    suffixes, _ = posterior(suffixes)
    domains, _ = posterior(domains.join(suffixes.select("suffix", "mean"), "suffix"))
    within = counts.join(domains.select("domain", F.col("mean").alias("own_mean")), "domain", "left")
    found, k = posterior(within.withColumn("mean", F.coalesce("own_mean", mean)))
    width = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (k + F.col("n") + 1))
    return found.select("host", "n", "bad", "mean", (F.col("mean") - DEVIATIONS * width).alias("lower"))


def judge(pages: DataFrame, outcomes: DataFrame, rules: Sequence[tuple[str, str]] = (), limit: float = LIMIT) -> DataFrame:
    """For each row of `pages` (page_id, url, anything else): page_id, host, path, rule, verdict, reputation.

    The verdict is the longest fitting rule's; else `block` if the lower bound of the host's share of bad pages is above
    `limit`, else `allow`. A null url, or one without ://, has an empty host and path and is judged as the host "".
    `outcomes` has host and bad. Repeated rows are judged alike; other columns are left out; an empty table gives an empty result.
    """
    rows = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    known = reputations(outcomes, rows.select("host")).select("host", "mean", "lower")
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    learned = F.when(F.col("lower") > limit, "block").otherwise("allow")
    return rows.join(known, "host", "left").select(
        "page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, learned).alias("verdict"), F.col("mean").alias("reputation"))
