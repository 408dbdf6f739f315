"""Queries write what several of their parts read, and nothing else."""

import time
from pathlib import Path

from pyspark.sql import functions as F

from ledgerlens.catalog import QUERIES
from ledgerlens.functions.scalars import sides

DIR = "/root/testdata/sf0.001"


def tables(spark):
    """Columns of the tables that have been written."""
    root = Path(spark.sparkContext.getConf().get("spark.checkpoint.dir").removeprefix("file://")) / "tables"
    return {p: set(spark.read.parquet(f"file://{p}").columns) for p in (root.iterdir() if root.exists() else ())}


def test_single_reads_are_not_written(spark):
    for name, most in (("edge_logs", 3), ("tag_bots", 2), ("prune_graph", 4)):  # hot, burn, prices; edges and vertices
        before = tables(spark)
        QUERIES[name](spark, DIR)
        new = [c for p, c in tables(spark).items() if p not in before]
        assert len(new) <= most and not any("usd" in c for c in new), name


def test_sides(spark):
    got = sides(spark.range(2), a=(F.col("id"), -F.col("id")), b=(F.lit("x"), F.lit(None))).collect()
    assert sorted(map(tuple, got), key=repr) == sorted([(0, "x"), (0, None), (1, "x"), (-1, None)], key=repr)


def shuffled(spark):
    """Rows that all stages so far have shuffled."""
    store, none = spark.sparkContext._jsc.sc().statusStore(), spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.double, 0)
    stages = spark.sparkContext._jvm.scala.jdk.javaapi.CollectionConverters.asJava(store.stageList(None, False, False, none, None))
    return sum(s.shuffleWriteRecords() for s in stages if s.status().toString() != "SKIPPED")


def test_subgraphs_are_written_nowhere(spark):
    """Each query deals the transfers by address once, and writes no relation but hot, burn and prices."""
    for name in ("edge_first_claim", "subgraph_edge_logs", "subgraph_preprocess", "diffusion_walks", "build_pairs", "label_counts"):
        before = tables(spark)
        QUERIES[name](spark, DIR)
        assert len([p for p in tables(spark) if p not in before]) <= 3, name


def test_dealings_are_shuffled_once(spark):
    before = shuffled(spark)
    QUERIES["edge_first_claim"](spark, DIR).collect()
    time.sleep(2)  # for the listener
    lines = spark.read.parquet(f"{DIR}/lineitem.parquet").count()
    assert shuffled(spark) - before < 10 * lines


def test_reached_odd(spark):
    """Self-transfers, hot wallets that are burn wallets, busy neighbours and null ends, against the plain joins."""
    from ledgerlens.operators import deposits, graph

    rows = [("u", "d"), ("d", "h"), ("v", "d"), ("u", "u"), ("d", "u"), ("u", "v"), ("v", "w"), ("w", "hb"), ("x", "w"), ("b", "d"), ("u", "b"), ("h", "u"), (None, "d"), ("u", None), ("u", "d")]
    rows += [("u", "busy"), *((f"n{k}", "busy") for k in range(5))]
    t = spark.createDataFrame(rows, "f string, t string")
    hot = spark.createDataFrame([("h", "E"), ("hb", "E"), ("h", "F")], "address string, exchange string")
    burn = spark.createDataFrame([("b",), ("hb",)], "address string")
    dealt = graph.dealings(t, hot, burn)
    edges = graph.admit(t.where("f IS NOT NULL AND t IS NOT NULL").distinct(), hot, burn).withColumn("newest", F.lit(1))
    v = graph.vertices_with_degrees(edges, hot)
    users = deposits.deposit_users(t, deposits.exchange_deposits(t, hot, burn), hot, burn)
    want = graph.two_hop(users.select(F.col("usr").alias("center")), edges, v, v, 4)
    got = graph.reached(dealt, 4).distinct()
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and not got.isEmpty()
    single = deposits.without_bots(deposits.single_deposit(deposits.users_by_edges(edges, deposits.qualified(v))), v, 2)
    assert sorted(map(tuple, deposits.sharing_users(dealt, bot_sent=2).collect())) == sorted(map(tuple, single.collect()))


def test_sides_meet_pairs_once(spark):
    """Token values of both sides join the pairs together, and give what each gives on its own."""
    from ledgerlens.operators import features

    rows = spark.createDataFrame([("s", "a", "b"), ("s", "a", "c")], "sg string, x string, subx string")
    sent = spark.createDataFrame([("s", "a", "T", 1.0), ("s", "b", "U", 2.0)], "sg string, address string, token string, usd double")
    received = spark.createDataFrame([("s", "c", "T", 3.0), ("s", "a", None, 4.0)], sent.schema)
    both = features.long_features(rows, sent.withColumn("side", F.lit("From")).unionByName(received.withColumn("side", F.lit("To"))))
    each = features.long_features(rows, sent, "From").unionByName(features.long_features(rows, received, "To"))
    assert sorted(map(tuple, both.collect()), key=repr) == sorted(map(tuple, each.collect()), key=repr)
    assert ("s", "a", "c", "SubX_To_T", 3.0) in set(map(tuple, both.collect()))
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString().count("Join ")
    assert plan(both) == 1 and plan(each) == 2
