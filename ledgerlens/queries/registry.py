"""Queries by name, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..codes import named
from ..fixtures import Relations, sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(twin: str | None = None, coded: bool = False):
    """Register a function of ``Relations``; ``twin`` is SQL over the relations of the same names.

    With ``coded`` the relations hold addresses as numbers, and the result gets the addresses back.
    """

    def add(f: Callable[[Relations], DataFrame]):
        run = (lambda spark, sf_dir: named(f(Relations(spark, sf_dir, True)))) if coded else (lambda spark, sf_dir: f(Relations(spark, sf_dir)))
        QUERIES[f.__name__] = run
        if twin:
            ORACLE_SQL[f.__name__] = sql(twin)
        return f

    return add
