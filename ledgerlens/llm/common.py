"""Helpers that the text operators share."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a maximal run of anything but ASCII white space.
SPACE = r"[\x20\x09-\x0D]"


@cache
def _own_dir() -> str:
    return tempfile.mkdtemp(prefix="ledgerlens-")


def shared_dir(spark: SparkSession) -> str:
    """A new folder below the one that driver and executors share.

    The cluster names it in ``spark.checkpoint.dir``. Where that is unset a local folder stands in, if all tasks run
    in the driver's process; otherwise executors would write to their own disks, which is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root and not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return f"{(root or _own_dir()).rstrip('/')}/llm/{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back, which cuts its lineage."""
    path = shared_dir(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_of(column: str | Column) -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit("")).cast("string")


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE + "+"), "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once a row, even where ``body`` uses it inside a lambda."""
    return F.transform(F.array(value), body).getItem(0)


def as_often(df: DataFrame, times: str, at: str, block: int = 1024) -> DataFrame:
    """Each row of ``df`` as often as its column ``times`` says, ``at`` counting from 0.

    Counts beyond a block are cut into blocks that are dealt out before they become rows, so a row that repeats
    without end neither fills one task nor one array.
    """
    few = df.where(F.col(times) <= block).withColumn(at, F.explode(F.expr(f"sequence(0L, {times} - 1)")))
    parts = df.where(F.col(times) > block).withColumn("as_often_part", F.explode(F.expr(f"sequence(0L, ({times} - 1) div {block})"))).repartition("as_often_part")
    many = parts.withColumn(at, F.explode(F.expr(f"sequence(as_often_part * {block}, least((as_often_part + 1) * {block}, {times}) - 1)"))).drop("as_often_part")
    return few.unionByName(many)
