"""Allow and block rules for urls, found by hashed expressions.

Rules are (action, host, path). A rule fits its host and all hosts below it when the
url's path starts with the rule's path; the longest fitting rule decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Hex digits of the digest that urls and rules are joined on.
PREFIX = 8


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """Rules as rows; give every rule (action, host, path), action allow or block, path with its leading slash."""
    return spark.createDataFrame(rules, "action string, host string, path string")


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (after the first ``://`` up to ``/``, ``?``, ``#``; A-Z lower-cased) and path (then up to ``?``, ``#``).

    Both are empty for null and for a url without ``://``.
    """
    at = F.instr(url, "://")
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, UPPER.lower())
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def judge_urls(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """Add ``host``, ``path``, ``rule`` (host and path of the deciding rule, else null) and ``verdict`` to ``pages``.

    Every distinct host and path is expanded into the expressions a rule could have: the
    host's suffixes of as many labels as some rule has, each with the path's prefixes of
    lengths that some rule has (both read from the rules, so none is missed). Expressions
    meet rules in an equi-join on the first digits of their SHA-256; the full digest
    confirms. The longest rule (host and path together) wins, then the longer host, then
    block. Columns of ``pages`` with the four names are replaced; null, empty and repeated
    urls and empty tables are ordinary cases: no rule, ``default``.
    """
    parts = url_parts(F.col(url))
    judged = pages.withColumns({"_host": parts[0], "_path": parts[1]}).drop("host", "path", "rule", "verdict")
    judged = judged.withColumnsRenamed({"_host": "host", "_path": "path"})
    rules = rules.filter("action in ('allow', 'block') and host is not null and path is not null").distinct()
    shape = rules.agg(F.max(F.size(F.split("host", r"\."))), F.collect_set(F.length("path"))).first()
    most_labels, lengths = shape[0] or 0, sorted(shape[1])

    keyed = rules.select(
        F.sha2(F.concat("host", "path"), 256).alias("r_digest"),
        F.struct(
            (F.length("host") + F.length("path")).alias("length"),
            F.length("host").alias("host_length"),
            F.col("action").alias("verdict"),
            F.concat("host", "path").alias("rule"),
        ).alias("found"),
    ).withColumn("short", F.substring("r_digest", 1, PREFIX))

    labels = F.split("host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.least(F.size(labels), F.lit(most_labels))) if most_labels else F.array().cast("array<int>"),
        lambda n: F.call_function("substring_index", F.col("host"), F.lit("."), -n),
    )
    prefixes = F.filter(
        F.array(*[F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in lengths]) if lengths else F.array().cast("array<string>"),
        lambda p: p.isNotNull(),
    )
    expressions = (
        judged.select("host", "path")
        .distinct()
        .withColumn("suffix", F.explode(suffixes))
        .withColumn("prefix", F.explode(prefixes))
        .withColumn("digest", F.sha2(F.concat("suffix", "prefix"), 256))
        .withColumn("short", F.substring("digest", 1, PREFIX))
    )
    best = (
        expressions.join(keyed, "short")
        .filter("digest = r_digest")
        .groupBy("host", "path")
        .agg(F.max("found").alias("found"))
        .select(F.col("host").alias("_h"), F.col("path").alias("_p"), "found")
    )
    return (
        judged.join(best, (F.col("host") == F.col("_h")) & (F.col("path") == F.col("_p")), "left")
        .withColumn("rule", F.col("found.rule"))
        .withColumn("verdict", F.coalesce("found.verdict", F.lit(default)))
        .drop("_h", "_p", "found")
    )
