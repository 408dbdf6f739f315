"""Addresses as numbers: both ways, and in the order of the addresses."""

import pytest
from pyspark.sql import functions as F

from ledgerlens.codes import address, code, named


def test_codes(spark):
    keys = [0, 1, 10, 12, 2, 99, 100, 5999999, 10**10, -3]
    days = ["1992-01-31", "1998-12-01", "2024-02-29"]
    rows = spark.createDataFrame([(k, d) for k in keys for d in days], "k long, d string").withColumn("d", F.col("d").cast("timestamp"))
    month = F.date_format("d", "yyyyMM")
    made = [rows.select(code(c, F.col("k"), F.col("d")).alias("n"), F.concat(F.lit(c), "k", F.lit("m"), month).alias("name")) for c in "cp"]
    made.append(rows.select(code("s", F.col("k")).alias("n"), F.concat(F.lit("s"), "k").alias("name")))
    got = made[0].union(made[1]).union(made[2]).withColumn("back", address(F.col("n"))).collect()
    assert all(x.name == x.back for x in got)
    assert [x.name for x in sorted(got, key=lambda x: x.n)] == sorted(x.name for x in got)


def test_codes_of_nothing(spark):
    rows = spark.createDataFrame([(None, None)], "k long, d timestamp").select(code("p", F.col("k"), F.col("d")).alias("f"))
    assert named(rows).first()[0] is None
    with pytest.raises(Exception, match="no code"):
        spark.range(1).select(code("p", F.lit(10**12))).collect()


def test_components_shrink(spark):
    """What a round reads shrinks, also along a path in the order of its addresses."""
    from ledgerlens.operators import graph
    from ledgerlens.sources.store import written

    sizes = []

    def cut(df):
        out = written(df)
        if {"a", "o"} <= set(out.columns):
            sizes.append(out.count())
        return out

    path = spark.range(3000).select(F.col("id").alias("f"), (F.col("id") + 1).alias("t"))
    apart = spark.createDataFrame([(9001, 9000), (9005, 9005), (9000, 9003)], "f long, t long")
    got = {x.address: x.component for x in graph.components(path.union(apart), cut).collect()}
    assert got == {i: 0 for i in range(3001)} | {9000: 9000, 9001: 9000, 9003: 9000, 9005: 9005}
    assert sum(sizes) < 3 * sizes[0] and len(sizes) < 25
