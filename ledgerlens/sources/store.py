"""Tables that change: upserts, merges and deletes as joins, and data written to cut lineage."""

from __future__ import annotations

import re
import tempfile
import uuid
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


@cache
def _own_dir() -> str:
    return tempfile.mkdtemp(prefix="ledgerlens-")


def shared_path(spark: SparkSession) -> str:
    """A new path in the folder that ``spark.checkpoint.dir`` names.

    Where that is unset a local folder stands in, if all tasks run in the driver's process; it is an error elsewhere.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root and not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return f"{(root or _own_dir()).rstrip('/')}/tables/{uuid.uuid4().hex}"


def written(df: DataFrame, *by: str) -> DataFrame:
    """``df`` as a table of its own; a folder for each value of the columns ``by``, which then come last."""
    path = shared_path(df.sparkSession)
    df.write.partitionBy(*by).option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete what ``written`` has kept for ``tables``, once nothing reads it any more."""
    for df in tables:
        spark = df.sparkSession
        for file in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            at = spark._jvm.org.apache.hadoop.fs.Path(file)
            if re.search(r"/tables/[0-9a-f]{32}$", file):
                at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def flattened(df: DataFrame) -> DataFrame:
    """Fields of nested structs, however deep, as columns with dotted names."""

    def leaves(kind, path: tuple[str, ...]):
        for f in kind.fields:
            own = (*path, f.name)
            yield from leaves(f.dataType, own) if isinstance(f.dataType, StructType) else [own]

    return df.select(*(F.col(".".join(f"`{p}`" for p in path)).alias(".".join(path)) for path in leaves(df.schema, ())))


def csv_copy(df: DataFrame, path: str | None = None) -> DataFrame:
    """Write ``df`` as CSV with a header and read it with its own types."""
    path = path or shared_path(df.sparkSession)
    df.write.csv(path, header=True, mode="overwrite", compression="gzip")
    return df.sparkSession.read.schema(df.schema).csv(path, header=True)


def upsert_set(old: DataFrame, patch: DataFrame, key: str) -> DataFrame:
    """Rows by key with the patch's values where it has any, the old ones elsewhere."""
    columns = [c for c in dict.fromkeys([*old.columns, *patch.columns]) if c != key]
    a, b = old.select(key, F.struct(*(c for c in old.columns)).alias("o")), patch.select(key, F.struct(*(c for c in patch.columns)).alias("p"))
    pick = lambda c: F.coalesce(*([F.col(f"p.{c}")] if c in patch.columns else []), *([F.col(f"o.{c}")] if c in old.columns else []))
    return a.join(b, key, "full_outer").select(key, *(pick(c).alias(c) for c in columns))


def upsert_add_to_set(old: DataFrame, patch: DataFrame, key: str, sets: list[str]) -> DataFrame:
    """As ``upsert_set``, but the columns ``sets`` hold arrays, of which the union is kept, sorted."""
    scalars = upsert_set(old.drop(*sets), patch.drop(*sets), key)
    both = old.select(key, *sets).unionByName(patch.select(key, *sets))
    for c in sets:  # members are made distinct as rows, and gathered only then
        members = both.select(key, F.explode_outer(c).alias("member")).distinct()
        scalars = scalars.join(members.groupBy(key).agg(F.sort_array(F.collect_list("member")).alias(c)), key)
    return scalars


def upsert_merge(old: DataFrame, patch: DataFrame, key: str, sets: tuple[str, ...] = (), cleared: str = "cleared") -> DataFrame:
    """As ``upsert_set``; the patch's array ``cleared`` names columns to make null, and ``sets`` add up without blanks."""
    a, b = old.select(key, F.struct("*").alias("o")), patch.select(key, F.struct("*").alias("p"))
    met = a.join(b, key, "full_outer")

    def value(c: str) -> Column:
        if c in sets:
            none = F.array().cast("array<string>")
            return F.sort_array(F.array_union(F.coalesce(f"o.{c}", none), F.filter(F.coalesce(f"p.{c}", none), lambda x: x != "")))
        return F.when(F.coalesce(F.array_contains(f"p.{cleared}", c), F.lit(False)), F.lit(None)).otherwise(F.coalesce(f"p.{c}", f"o.{c}"))

    return met.select(key, *(value(c).alias(c) for c in old.columns if c != key))


def merge_vertices(old: DataFrame, new: DataFrame) -> DataFrame:
    """Vertices of either table: the later transfer, and a tag where either has it."""
    return old.unionByName(new).groupBy("address").agg(F.max("last_transfer_at").alias("last_transfer_at"), F.bool_or("hot_wallet").alias("hot_wallet"), F.bool_or("deposit_wallet").alias("deposit_wallet"))


def merge_logs(old: DataFrame, new: DataFrame, replace: bool = False) -> DataFrame:
    """Log entries of either table, the new one's on equal keys; with ``replace`` a new edge drops its old entries."""
    keys = ["f", "t"] if replace else ["f", "t", "tok", "ts"]
    return old.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new)


def delete(table: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    return table.join(keys.select(key), key, "left_anti")
