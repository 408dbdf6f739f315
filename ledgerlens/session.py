"""A session with the settings that the operators rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(master: str | None = None, **settings: str) -> SparkSession:
    """UTC, adaptive execution, and last-wins maps; ``settings`` come on top, dots written as ``__``."""
    builder = SparkSession.builder.appName("ledgerlens")
    if master:
        builder = builder.master(master)
    fixed = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    }
    for key, value in (fixed | {k.replace("__", "."): v for k, v in settings.items()}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
