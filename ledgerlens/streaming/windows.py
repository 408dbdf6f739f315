"""Event-time windows and repeats within a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def tumbling_counts(transfers: DataFrame, seconds: int = 900, late: str = "1 hour") -> DataFrame:
    """Transfers and amount by token in windows of event time; rows later than ``late`` are left out, openly."""
    timed = transfers.withColumn("at", F.timestamp_seconds("ts")).withWatermark("at", late)
    return timed.groupBy(F.window("at", f"{seconds} seconds"), "tok").agg(F.count("*").alias("n"), F.sum("amt").alias("amt"))


def once_per_key(transfers: DataFrame, keys: list[str], late: str = "1 hour") -> DataFrame:
    """Transfers without repeats of ``keys`` within the watermark."""
    return transfers.withColumn("at", F.timestamp_seconds("ts")).withWatermark("at", late).dropDuplicatesWithinWatermark(keys)
