"""URL filters: rules on a host with its subdomains and a path prefix.

Each distinct host and path is expanded into the rule expressions that could fit it: host suffixes of as many labels as rules
have, path prefixes of the lengths rules have.  Expressions and rules meet in an equi-join on a short prefix of their digest,
the full digests confirm, and the longest rule wins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name

# The letters that are lowered.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SHORT = 8


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host after the first ``://``, A-Z lowered, and path up to a query or fragment; both empty where there is none."""
    at = F.instr(url, "://")
    rest = F.coalesce(F.when(at > 0, F.substring(url, at + 3, F.length(url))), F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return F.translate(host, UPPER, LOWER), path


def digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)


def judge(pages: DataFrame, rules: DataFrame, url: str = "url", into: str = "judged", default: str = "allow") -> DataFrame:
    """`pages` with one more column, a struct: host, path, rule and verdict.

    `rules` has host, path and verdict (allow or block); rows with a null are left out.  A rule fits its host and all
    subdomains where the path starts with the rule's.  The longest rule (host and path together) wins, then the one with the
    longer host; of the same rule given both ways, block wins.  Where no rule fits, `rule` is null and the verdict is
    `default`.  Null URLs and those without ``://`` have an empty host and path, which only a rule of an empty host and path
    fits.  All columns and rows stay; if `into` is taken, underscores are added to it.
    """
    into = free_name(pages, into)
    rules = rules.select(F.translate(F.col("host"), UPPER, LOWER).alias("host"), "path", "verdict").dropna()
    shape = rules.agg(F.max(F.size(F.split("host", r"\."))).alias("labels"), F.sort_array(F.collect_set(F.length("path"))).alias("lengths")).first()
    labels, lengths = shape.labels or 0, shape.lengths or [0]
    host, path = host_and_path(pages[url])
    keyed = pages.withColumn(into, F.struct(host.alias("host"), path.alias("path")))
    places = keyed.select(F.col(into)["host"].alias("host"), F.col(into)["path"].alias("path")).distinct()
    parts = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.greatest(F.size(parts) - labels, F.lit(0)) + 1, F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))
    prefixes = F.transform(F.filter(F.array(*map(F.lit, lengths)), lambda n: n <= F.length("path")), lambda n: F.substring(F.col("path"), F.lit(1), n))
    asked = places.withColumn("s", F.explode(suffixes)).withColumn("p", F.explode(prefixes)).withColumn("d", digest(F.col("s"), F.col("p")))
    given = rules.select(
        digest(F.col("host"), F.col("path")).alias("e"),
        F.struct((F.length("host") + F.length("path")).alias("size"), F.length("host").alias("host"), (F.col("verdict") == "block").alias("block"),
                 F.concat("host", "path").alias("rule"), "verdict").alias("r"))
    fits = asked.withColumn("k", F.substring("d", 1, SHORT)).join(given.withColumn("k", F.substring("e", 1, SHORT)), "k").where("d = e")
    best = fits.groupBy("host", "path").agg(F.max("r").alias("r"))
    best = best.select(F.struct("host", "path").alias("place"), "r")
    joined = keyed.join(best, keyed[into] == best["place"], "left")
    found = F.struct(F.col(into)["host"].alias("host"), F.col(into)["path"].alias("path"), best["r"]["rule"].alias("rule"),
                     F.coalesce(best["r"]["verdict"], F.lit(default)).alias("verdict"))
    return joined.select(*(keyed[f"`{c}`"] for c in pages.columns), found.alias(into))


def allowed(pages: DataFrame, rules: DataFrame, **options) -> DataFrame:
    """The pages that are not blocked, same columns."""
    name = free_name(pages, "judged")
    return judge(pages, rules, into=name, **options).where(F.col(name)["verdict"] == "allow").select(*(F.col(f"`{c}`") for c in pages.columns))


def report(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """page_id, host, path, rule and verdict of every page."""
    return judge(pages.select("page_id", "url"), rules).select("page_id", "judged.host", "judged.path", "judged.rule", "judged.verdict")
