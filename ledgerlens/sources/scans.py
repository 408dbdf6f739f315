"""Reads: ranges, lists, flags, pages and slices as filters that reach the scan, and joins in place of lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def in_range(df: DataFrame, column: str, low: int, high: int) -> DataFrame:
    """Rows with ``low <= column <= high``."""
    return df.where(F.col(column).between(low, high))


def by_list(df: DataFrame, keys: DataFrame, key: str, fields: list[str] | None = None) -> DataFrame:
    out = df.join(keys.select(key).distinct(), key, "left_semi")
    return out.select(*fields) if fields else out


def by_flag(df: DataFrame, flag: str, fields: list[str] | None = None) -> DataFrame:
    out = df.where(F.coalesce(F.col(flag), F.lit(False)))
    return out.select(*fields) if fields else out


def recent_not_hot(vertices: DataFrame, since: int) -> DataFrame:
    return vertices.where(~F.coalesce("hot_wallet", F.lit(False)) & (F.col("last_transfer_at") > since))


def native_transfers(transactions: DataFrame, receipts: DataFrame) -> DataFrame:
    """Plain transfers of value that succeeded; the receiver is the created contract where there is none."""
    met = transactions.join(receipts, ["hash", "transaction_index", "block_number"])
    good = met.where((F.col("input") == "0x") & F.col("value").rlike("^0*[1-9][0-9]*$") & (F.col("receipt_status") == 1))
    receiver = F.coalesce(F.expr("nullif(to_address, '')"), F.col("receipt_contract_address"))
    return good.select("hash", "block_number", F.col("from_address").alias("f"), receiver.alias("t"), (F.col("value").cast("double") / F.lit(1e18)).alias("amt"))


def with_time(transfers: DataFrame, blocks: DataFrame) -> DataFrame:
    """With the time of the block. A block that isn't known is an error; ``missing_blocks`` lists them all."""
    met = transfers.join(blocks.select(F.col("number").alias("block_number"), F.col("timestamp").alias("ts")), "block_number", "left")
    unknown = F.raise_error(F.concat(F.lit("no time for block "), F.coalesce(F.col("block_number").cast("string"), F.lit("null")))).cast("long")
    return met.withColumn("ts", F.when(F.col("ts").isNull(), unknown).otherwise(F.col("ts")))


def missing_blocks(transfers: DataFrame, blocks: DataFrame) -> DataFrame:
    return transfers.select("block_number").distinct().join(blocks.select(F.col("number").alias("block_number")), "block_number", "left_anti")


def related(transactions: DataFrame, wallets: DataFrame, low: int, high: int) -> DataFrame:
    """Transactions of ``low <= block < high`` from or to any of the wallets, each once."""
    some = transactions.where((F.col("block_number") >= low) & (F.col("block_number") < high))
    keys = wallets.select("address").distinct()
    sent = some.join(keys.withColumnRenamed("address", "from_address"), "from_address", "left_semi").select(*transactions.columns)
    got = some.join(keys.withColumnRenamed("address", "to_address"), "to_address", "left_semi").select(*transactions.columns)
    return sent.union(got).dropDuplicates(["hash"])


def page(df: DataFrame, key: str, offset: int, limit: int) -> DataFrame:
    """Rows ``offset`` to ``offset + limit`` in the order of ``key``."""
    return df.orderBy(key).offset(offset).limit(limit)


def slice_after(df: DataFrame, key: str, start, end, limit: int | None = None) -> DataFrame:
    """The rows strictly between two keys, or the first ``limit`` of them: where a run resumes."""
    left = df.where((F.col(key) > start) & (F.col(key) < end)).orderBy(key)
    return left if limit is None else left.limit(limit)


def ends(df: DataFrame, column: str) -> tuple[int, int]:
    """Least and largest value, one row of the driver's; an empty range where there are none."""
    low, high = df.agg(F.min(column), F.max(column)).first()
    return (1, 0) if low is None else (low, high)


def sources(names: list[str], **tables: DataFrame) -> DataFrame:
    """The union of the named tables in the order of ``names``, each row with its source; an unknown name is an error."""
    unknown = [n for n in names if n not in tables]
    if unknown or not names:
        raise ValueError(f"no such sources: {unknown}")
    parts = [tables[n].select(F.lit(n).alias("source"), *tables[n].columns) for n in names]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
