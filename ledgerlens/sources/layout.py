"""Tables laid out by chain and by bucket of blocks, of which a read opens only the folders that it asks for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Blocks of a bucket.
WIDTH = 1000


def write(df: DataFrame, path: str, block: str = "block_number", width: int = WIDTH, mode: str = "errorifexists") -> None:
    """``df``, which has ``chain_id``, in a folder for each chain and bucket; a folder's rows are dealt to one task each."""
    rows = df.withColumn("bucket", F.expr(f"{block} div {width}"))
    rows.hint("rebalance", "chain_id", "bucket").write.partitionBy("chain_id", "bucket").mode(mode).parquet(path)


def read(spark: SparkSession, path: str, chain: str | None = None, low: int | None = None, high: int | None = None, block: str = "block_number", width: int = WIDTH) -> DataFrame:
    """Rows of a chain with ``low <= block <= high``; chain and bucket select folders before any file is opened."""
    out = spark.read.parquet(path)
    rules: list[Column] = []
    if chain is not None:
        rules.append(F.col("chain_id") == chain)
    if low is not None:
        rules += [F.col("bucket") >= low // width, F.col(block) >= low]
    if high is not None:
        rules += [F.col("bucket") <= high // width, F.col(block) <= high]
    for rule in rules:
        out = out.where(rule)
    return out


def bucket(spark: SparkSession, path: str, number: int, chain: str | None = None, width: int = WIDTH) -> DataFrame:
    """Rows of one bucket."""
    return read(spark, path, chain, number * width, (number + 1) * width - 1, width=width)


def at_blocks(laid: DataFrame, blocks: DataFrame, block: str = "block_number", width: int = WIDTH) -> DataFrame:
    """Rows of the blocks that ``blocks`` names; where that side is small, its buckets select folders while the query runs."""
    keys = blocks.select(F.col(block).alias("asked")).distinct().withColumn("asked_bucket", F.expr(f"asked div {width}"))
    return laid.join(keys, (F.col("bucket") == F.col("asked_bucket")) & (F.col(block) == F.col("asked"))).drop("asked", "asked_bucket")


def from_footers(spark: SparkSession, path: str, column: str) -> tuple[int, object, object]:
    """Rows of a Parquet table, and the least and largest value of a number or date, read from the files' footers alone."""
    own = spark.newSession()  # the settings hold here only
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return tuple(own.read.parquet(path).agg(F.count("*"), F.min(column), F.max(column)).first())
