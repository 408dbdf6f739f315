"""URL filters: host suffixes and path prefixes of each address meet the rules on short hashes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import as_often

#: The rules of the query: (verdict, host, path).
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)

#: Bytes of a SHA-256 digest that the join compares first, as hex digits.
PREFIX_HEX = 8


def host_of(url: Column) -> Column:
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(u_url, instr(u_url, '://') + 3)")).otherwise("")
    return F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(u_url, instr(u_url, '://') + 3)")).otherwise("")
    return F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_table(spark: SparkSession, rules=RULES) -> DataFrame:
    return spark.createDataFrame([tuple(r) for r in rules], "verdict string, host string, path string")


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\n"), path).cast("binary"), 256)


def _count(text: str, mark: str) -> Column:
    return F.length(text) - F.length(F.replace(F.col(text), F.lit(mark), F.lit("")))


def judge(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow") -> DataFrame:
    """One row for each row of ``pages``: id, host, path, the rule that decides and its verdict.

    A rule fits its host and every subdomain where the path starts with the rule's; the longest rule wins, ties go
    to ``block`` and then to the smaller text. Rows without a fitting rule get ``default`` and a null rule. Nulls
    and addresses without ``://`` have an empty host and path, which no rule fits unless its path is empty too.
    Equal rows are judged once and returned as often as they came. An address of any length is expanded only into
    the host suffixes and path prefixes of as many parts as some rule has. Rules may be any number, of which only the
    numbers of parts, a few pairs, come to the driver: Spark broadcasts the rules only while their size is below its
    threshold, and otherwise splits skewed prefixes. Other columns are ignored; an empty table stays empty.
    """
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("u_url"))
    u = F.coalesce("u_url", F.lit(""))
    rows = rows.select("page_id", host_of(u).alias("host"), path_of(u).alias("path")).groupBy("page_id", "host", "path").agg(F.count("*").alias("n"))

    # A rule is filed under its path up to the last slash; the rest of the path is compared after the join.
    kept = rules.where(F.col("host").isNotNull() & F.col("path").isNotNull()).dropDuplicates(["verdict", "host", "path"])
    filed = _digest(F.col("host"), F.regexp_extract("path", "^(?:.*/)?", 0))
    index = kept.select(F.col("verdict").alias("r_verdict"), F.col("path").alias("r_path"), F.concat("host", "path").alias("r_rule"), filed.alias("r_digest"), F.substring(filed, 1, PREFIX_HEX).alias("r_short"))
    parts = kept.select((_count("host", ".") + 1).alias("labels"), _count("path", "/").alias("slashes")).distinct().orderBy("labels", "slashes").collect()
    asked = []
    for labels, slashes in parts:
        prefix = F.concat(F.substring_index("path", "/", slashes), F.lit("/")) if slashes else F.lit("")
        fits = (_count("host", ".") + 1 >= labels) & F.col("path").startswith(prefix)
        asked.append(F.when(fits, _digest(F.substring_index("host", ".", -labels), prefix)))
    known = F.array_compact(F.array(*asked)) if asked else F.array().cast("array<string>")
    each = rows.withColumn("digest", F.explode_outer(known)).withColumn("short", F.substring("digest", 1, PREFIX_HEX))

    fits = (F.col("digest") == F.col("r_digest")) & F.col("path").startswith(F.col("r_path"))
    rank = F.struct(F.length("r_rule").alias("len"), (F.col("r_verdict") == "block").alias("block"), F.col("r_rule").alias("rule"), F.col("r_verdict").alias("verdict"))
    found = each.join(index, each["short"] == index["r_short"], "left").select("page_id", "host", "path", "n", F.when(fits, rank).alias("rank"))
    best = found.groupBy("page_id", "host", "path").agg(F.first("n").alias("n"), F.max("rank").alias("best"))
    out = best.select("page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"), "n")
    return as_often(out, "n", "i").drop("n", "i")
