"""Sharding: a tree of regions, racks and shards, descended by weighted hash draws."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import as_often, materialize, text_of


@dataclass(frozen=True)
class Shard:
    region: str
    rack: str
    number: int
    weight: float = 1.0


def regular_tree(shards: int = 16, racks: int = 2, per_rack: int = 2) -> tuple[Shard, ...]:
    """Shards 0 to ``shards`` - 1, ``per_rack`` in a rack and ``racks`` racks in a region."""
    return tuple(Shard(f"r{n // (racks * per_rack)}", f"k{n // per_rack}", n) for n in range(shards))


def grown(tree: tuple[Shard, ...], weight: float = 1.0) -> tuple[Shard, ...]:
    """The tree with one more shard, in a region of its own.

    Draws of the other regions don't change then, so rows move only into the new shard. Put into an old rack it
    would draw rows into that rack's region and so to its neighbours too.
    """
    n = max((s.number for s in tree), default=-1) + 1
    return (*tree, Shard(f"r+{n}", f"k+{n}", n, weight))


def _draw(key: Column, level: str, name: str, weight: float) -> Column:
    """An exponential draw of rate ``weight``: the smallest of several wins in proportion to its weight."""
    h = F.xxhash64(F.concat_ws("|", key, F.lit(level), F.lit(name)))
    u = (F.shiftrightunsigned(h, 11) + F.lit(0.5)) / F.lit(float(2**53))
    return -F.ln(u) / F.lit(float(weight))


def _descend(key: Column, tree: tuple[Shard, ...]) -> Column:
    def pick(level: str, branches: dict[str, tuple[Shard, ...]], below) -> Column:
        if len(branches) == 1:
            return below(next(iter(branches.values())))
        best = F.array_min(F.array(*(F.struct(_draw(key, level, name, sum(s.weight for s in part)).alias("d"), F.lit(name).alias("name")) for name, part in branches.items())))
        out = None
        for name, part in branches.items():
            out = F.when(best["name"] == name, below(part)) if out is None else out.when(best["name"] == name, below(part))
        return out

    def by(attribute: str, part: tuple[Shard, ...]) -> dict[str, tuple[Shard, ...]]:
        out: dict[str, tuple[Shard, ...]] = {}
        for s in part:
            if s.weight > 0:
                out[str(getattr(s, attribute))] = (*out.get(str(getattr(s, attribute)), ()), s)
        return out

    leaf = lambda part: F.lit(part[0].number)
    return pick("region", by("region", tree), lambda r: pick("rack", by("rack", r), lambda k: pick("shard", by("number", k), leaf)))


def assign(docs: DataFrame, tree: tuple[Shard, ...] = regular_tree(), id_col: str = "doc_id", text_col: str = "text", rows_per_bucket: int = 2000) -> DataFrame:
    """Shard and slot of each row: ``doc_id, size, text_crc32, law, shard, slot, grown_shard``.

    The id alone decides the shard (a null id counts as the text ``null``), and slots run from 0 in each shard
    without gaps. A null text has no bytes. Equal rows are counted before they are moved and get neighbouring
    slots; slots come from counts of hash buckets, so no shard is ever gathered in one task.
    """
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    text = text_of("text")
    rows = (
        docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
        .select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).cast("long").alias("text_crc32"))
        .groupBy("doc_id", "size", "text_crc32")
        .agg(F.count("*").alias("n"))
    )
    rows = rows.withColumns({"shard": _descend(key, tree).cast("int"), "grown_shard": _descend(key, grown(tree)).cast("int")})
    rows = materialize(rows)
    buckets = max(1, rows.count() // (max(1, len(tree)) * rows_per_bucket) + 1)
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "size", "text_crc32"), F.lit(buckets)))
    totals = rows.groupBy("shard", "bucket").agg(F.sum("n").alias("in_bucket"))
    before = totals.select("shard", "bucket", F.expr("sum(in_bucket) OVER (PARTITION BY shard ORDER BY bucket) - in_bucket").alias("offset"))
    placed = rows.join(before, ["shard", "bucket"]).withColumn(
        "start", F.expr("offset + sum(n) OVER (PARTITION BY shard, bucket ORDER BY doc_id, size, text_crc32) - n")
    )
    return as_often(placed, "n", "i").select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", (F.col("start") + F.col("i")).alias("slot"), "grown_shard")
