"""URL block and allow lists looked up by hashed host-suffix / path-prefix expressions.

Every URL is expanded into ``host suffix + path prefix`` strings.  Both the
expressions and the rules carry a SHA-256 digest; they meet in an equi-join on
the first eight hex digits and are confirmed on the whole digest.

Only shapes that occur among the rules are expanded: host suffixes with a number
of labels that some rule has, path prefixes ending at the n-th slash for rules
that end in a slash, and prefixes of a rule's length for those that do not.  So
the expansion is exact for any rule and does not grow with the length of a URL.

Defined cases: a null URL or one without ``://`` has empty host and path and gets
the default verdict; an empty path matches only rules with an empty path; rules
with a null part are ignored; of rules that fit, the longest wins, then the one
with the longer host, then block before allow.  Repeated rows are judged alike,
one output row each.  Empty tables give empty results.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SALTS, salted_join, scattered

URL_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
PREFIX_DIGITS = 8
MAIN_RULES = [
    ("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"),
]


def host_of(url: Column) -> Column:
    host = F.coalesce(F.regexp_extract(url, URL_PARTS, 1), F.lit(""))
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, URL_PARTS, 2), F.lit(""))


def _slashes(path: Column) -> Column:
    return F.length(path) - F.length(F.replace(path, F.lit("/"), F.lit("")))


def _prepared(rules: DataFrame) -> DataFrame:
    host = F.translate("host", string.ascii_uppercase, string.ascii_lowercase)
    rule = F.concat(host, F.col("path"))
    digest = F.sha2(rule, 256)
    return rules.where("host IS NOT NULL AND path IS NOT NULL AND action IS NOT NULL").select(
        F.substring(digest, 1, PREFIX_DIGITS).alias("prefix"), digest.alias("digest"), rule.alias("rule"),
        F.length(host).alias("host_length"), F.size(F.split(host, r"\.")).alias("labels"),
        F.when(F.col("path").endswith("/"), _slashes(F.col("path"))).alias("depth"),
        F.when(~F.col("path").endswith("/"), F.length("path")).alias("length"), F.col("action")).distinct()


def _expressions(urls: DataFrame, shapes) -> DataFrame:
    """One row per URL part and expression; ``shapes`` holds a few small numbers found in the rules."""
    def numbers(values):
        return F.array(*[F.lit(int(v)) for v in sorted(values)]).cast("array<int>")

    labels = F.split("host", r"\.")
    hosts = F.transform(F.filter(numbers(shapes["labels"]), lambda n: n <= F.size(labels)),
                        lambda n: F.array_join(F.slice(labels, -n, n), "."))
    by_slash = F.transform(F.filter(numbers(shapes["depths"]), lambda n: n <= _slashes(F.col("path"))),
                           lambda n: F.concat(F.array_join(F.slice(F.split("path", "/"), 1, n), "/"), F.lit("/")))
    by_length = F.transform(F.filter(numbers(shapes["lengths"]), lambda n: n <= F.length("path")),
                            lambda n: F.substring(F.col("path"), F.lit(1), n))
    paths = F.array_distinct(F.concat(by_slash, by_length))
    both = urls.withColumn("suffix", F.explode(hosts)).withColumn("start", F.explode(paths))
    digest = F.sha2(F.concat("suffix", "start"), 256)
    return both.select("url", "part", digest.alias("found")).withColumn("prefix", F.substring("found", 1, PREFIX_DIGITS))


def decide(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(url, part, rule, action) for the (url, part) rows that some rule fits; needs host and path beside them."""
    listed = _prepared(rules)
    shapes = listed.agg(
        F.collect_set("labels").alias("labels"), F.collect_set("depth").alias("depths"),
        F.collect_set("length").alias("lengths")).first()
    if not shapes["labels"]:
        return urls.where("false").select("url", "part", F.lit("").alias("rule"), F.lit("").alias("action"))
    hits = salted_join(_expressions(urls, shapes), listed, ["prefix"]).where("found = digest")
    best = F.max(F.struct(F.length("rule").alias("a"), "host_length", (F.col("action") == "block").alias("b"), "rule", "action"))
    return hits.groupBy("url", "part").agg(best.alias("best")).select("url", "part", "best.rule", "best.action")


def judge(pages: DataFrame, rules: DataFrame, key: str = "page_id", default: str = "allow") -> DataFrame:
    """One row per row of ``pages``: (key, host, path, rule, verdict); rule is null where the default holds.

    Equal URLs are judged once per part: a part is a sixteenth of the rows by
    hash of the key, so a URL that owns a third of all rows is still split.
    """
    rows = pages.select(F.col(key).alias("key"), "url", scattered(key, parts=SALTS).alias("part"))
    urls = rows.select("url", "part").where("url IS NOT NULL").distinct().withColumns(
        {"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    verdicts = decide(urls, rules)
    return rows.join(verdicts, ["url", "part"], "left").select(
        F.col("key").alias(key), host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"),
        "rule", F.coalesce("action", F.lit(default)).alias("verdict"))


def allowed(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """The rows of ``pages``, all columns as they were, whose URL is allowed."""
    rows = pages.select(F.struct(*[F.col(f"`{c}`") for c in pages.columns]).alias("row"), "url",
                        scattered("url", parts=1).alias("part"))
    urls = rows.select("url", "part").where("url IS NOT NULL").distinct().withColumns(
        {"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    verdicts = decide(urls, rules).select("url", "part", "action")
    kept = salted_join(rows, verdicts, ["url", "part"], "left")
    return kept.where(F.coalesce("action", F.lit(default)) == "allow").select("row.*")


def main_rules(spark) -> DataFrame:
    return spark.createDataFrame(MAIN_RULES, "host string, path string, action string")
