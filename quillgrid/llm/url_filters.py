"""URL block and allow lists, looked up by hash prefix.

Each URL is expanded into (host suffix, path prefix) expressions, as Safe Browsing clients do. Expressions meet
the rules in an equi-join on the first 4 bytes of their SHA-256; the full digest then confirms the match, and the longest
rule wins. Only suffixes with as many labels as some rule, and prefixes as long as some rule's path, are expanded: no
other expression can match, so nothing is lost and the expansion stays bounded for any URL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillgrid.llm.common import lower_ascii

#: (verdict, rule): host and path from the first slash on.
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
#: Up to so many rules (about 100 bytes each) the rule side is broadcast; beyond, both sides are shuffled and salted.
BROADCAST_RULES = 200_000
#: Copies of each rule in the shuffled form, so that an expression that most URLs share (a top-level domain) goes to so many tasks.
SALT = 64
HASH_PREFIX_HEX = 8


def host_of(url: Column) -> Column:
    return lower_ascii(F.regexp_extract(F.coalesce(url, F.lit("")), "://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), "://[^/?#]*([^?#]*)", 1)


def rules_frame(spark, rules: Sequence[tuple[str, str]] = RULES) -> DataFrame:
    return spark.createDataFrame([(v, r) for v, r in rules], "verdict string, rule string")


def url_verdicts(
    pages: DataFrame,
    rules: DataFrame,
    default: str = "allow",
    key: str = "page_id",
    url: str = "url",
    broadcast_rules: int = BROADCAST_RULES,
) -> DataFrame:
    """key, host, path, rule, verdict for every row of pages.

    A rule `host/path` fits its host and all subdomains when the URL's path starts with the rule's path. The longest rule wins
    (ties: the one with the longer host, then `block`, then by text). No fitting rule: rule null, verdict `default`. A null URL, or one
    without `://`, has empty host and path and fits nothing. Null keys and repeated rows are kept as they are; rules that repeat
    count once; rules without a slash, or null, are ignored; an empty table gives an empty result. Other columns are ignored.
    """
    spark = pages.sparkSession
    slash = F.instr("rule", "/")
    rules = (
        rules.select("verdict", "rule")
        .where(F.coalesce(slash, F.lit(0)) > 0)
        .select("verdict", "rule", lower_ascii(F.substring_index("rule", "/", 1)).alias("r_host"), F.expr("substring(rule, instr(rule, '/'))").alias("r_path"))
        .withColumn("rule", F.concat("r_host", "r_path"))
        .groupBy("rule", "r_host", "r_path")
        .agg(F.max("verdict").alias("r_verdict"))
        .withColumn("digest", F.sha2("rule", 256))
    )
    shape = rules.agg(F.count("*").alias("n"), F.array_sort(F.collect_set(F.size(F.split("r_host", "\\.")))).alias("labels"), F.array_sort(F.collect_set(F.length("r_path"))).alias("lengths")).first()
    labels, lengths = shape["labels"] or [], shape["lengths"] or []
    base = pages.select(F.col(key).alias("page_id"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    if not shape["n"]:
        return base.select("page_id", "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    part = F.split("host", "\\.")
    suffixes = F.transform(
        F.filter(F.array(*map(F.lit, labels)), lambda n: n <= F.size(part)),
        lambda n: F.array_join(F.slice(part, F.size(part) - n + 1, n), "."),
    )
    prefixes = F.transform(F.filter(F.array(*map(F.lit, lengths)), lambda n: n <= F.length("path")), lambda n: F.substring(F.col("path"), F.lit(1), n))
    expressions = F.flatten(F.transform(suffixes, lambda h: F.transform(prefixes, lambda p: F.concat(h, p))))
    short = lambda digest: F.substring(digest, 1, HASH_PREFIX_HEX)
    choose = F.max(
        F.when(F.col("x.digest") == F.col("r_digest"), F.struct(F.length("r_rule").alias("n"), F.length("r_host").alias("h"), F.col("r_verdict").alias("verdict"), F.col("r_rule").alias("rule")))
    )
    rules = rules.select("r_verdict", "r_host", F.col("rule").alias("r_rule"), F.col("digest").alias("r_digest"), short(F.col("digest")).alias("short"))
    if shape["n"] <= broadcast_rules:
        # The rules arrive as a broadcast, so the expressions are looked up and confirmed where they are; what is exchanged is one row per URL, after a partial
        # aggregation that has ranked its matches.
        hashed = base.withColumn("row", F.monotonically_increasing_id()).withColumn("x", F.explode_outer(_digests(expressions)))
        joined = hashed.withColumn("short", short(F.col("x.digest"))).join(F.broadcast(rules), "short", "left")
    else:
        hashed = base.withColumn("row", F.monotonically_increasing_id()).withColumn("x", F.explode_outer(_digests(expressions)))
        hashed = hashed.withColumn("short", short(F.col("x.digest"))).withColumn("salt", F.pmod(F.xxhash64("host", "path", "row"), F.lit(SALT)))
        copies = rules.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1)).cast("array<bigint>")))
        joined = hashed.join(copies, ["short", "salt"], "left")
    best = joined.groupBy("row", "page_id", "host", "path").agg(choose.alias("best"))
    return best.select("page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"))


def _digests(expressions: Column) -> Column:
    return F.transform(F.array_distinct(expressions), lambda e: F.struct(F.sha2(e, 256).alias("digest")))
