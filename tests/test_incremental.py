"""Batches and streams give the same graph; pruning twice changes nothing; the whole pipeline runs."""

import pytest
from pyspark.sql import functions as F

from ledgerlens.fixtures import LAST, Relations
from ledgerlens.operators import graph
from ledgerlens.operators.boosting import Growth
from ledgerlens.plans import pipeline
from ledgerlens.sources.store import written
from ledgerlens.streaming import state, windows

DIR = "/root/testdata/sf0.001"


def rows(df):
    return sorted(map(repr, df.collect()))


VERTEX = ["address", "last_transfer_at", "hot_wallet", "deposit_wallet"]
EVER = "20000 days"


@pytest.fixture(scope="module")
def given(spark):
    r = Relations(spark, DIR)
    return [written(x) for x in (r.transfers(), r.hot(), r.burn(), r.prices())]


def arrive(spark, transfers, source):
    transfers.write.mode("append").parquet(source)
    return spark.readStream.schema(transfers.schema).parquet(source)


def test_stream_equals_batch(spark, tmp_path, given):
    """Three runs, the oldest transfers last, give what one batch gives; a run without input changes nothing."""
    transfers, hot, burn, prices = given
    source, v, e = (str(tmp_path / x) for x in ("in", "vertices", "entries"))
    for rule in ("ts >= 852076800 AND leg = 1", "ts >= 852076800 AND leg = 0", "ts < 852076800", "false"):
        stream = arrive(spark, transfers.where(rule), source)
        state.run_available(state.vertices(stream, hot, burn, EVER), v)
        state.run_available(state.entries(stream, hot, burn, prices, LAST, EVER), e)
    admitted = graph.admit(transfers, hot, burn)
    assert rows(state.table(spark, v, "vertex").select(*VERTEX)) == rows(graph.vertices_of(admitted, hot))
    assert rows(state.table(spark, e, "entry")) == rows(graph.fold_logs(graph.price(admitted, prices), LAST))


def test_stream_cut_off(spark, tmp_path, given):
    """A batch whose sink fails runs again from the state before it, which stays readable by its number."""
    transfers, hot, burn, _ = given
    source, checkpoint, seen = str(tmp_path / "in"), str(tmp_path / "checkpoint"), []
    state.run_available(state.vertices(arrive(spark, transfers.where("leg = 0"), source), hot, burn, EVER), checkpoint)
    done = state.last_batch(spark, checkpoint)
    first = rows(state.table(spark, checkpoint, "vertex").select(*VERTEX))
    assert first == rows(graph.vertices_of(graph.admit(transfers.where("leg = 0"), hot, burn), hot))

    def fail(batch, number):
        batch.count()  # the batch's work is done, and lost
        raise ValueError("lost")

    stream = arrive(spark, transfers.where("leg = 1"), source)
    with pytest.raises(Exception, match="lost"):
        state.run_available(state.vertices(stream, hot, burn, EVER), checkpoint, fail)
    assert rows(state.table(spark, checkpoint, "vertex", done).select(*VERTEX)) == first

    def keep(batch, number):
        seen.append((number, batch.count()))

    state.run_available(state.vertices(stream, hot, burn, EVER), checkpoint, keep)
    admitted = graph.admit(transfers, hot, burn)
    assert rows(state.table(spark, checkpoint, "vertex").select(*VERTEX)) == rows(graph.vertices_of(admitted, hot))
    changed = graph.vertices_of(graph.admit(transfers.where("leg = 1"), hot, burn), hot).count()
    assert sum(n for _, n in seen) == changed and min(k for k, _ in seen) > done


def tiny(spark, data):
    return spark.createDataFrame([(f, t, "T", ts, amt, leg) for f, t, ts, amt, leg in data], "f string, t string, tok string, ts long, amt double, leg int")


def test_stream_expires(spark, tmp_path):
    """What is older than ``keep`` before the watermark leaves, what is on the border stays, and late rows stay out."""
    hot, burn = (spark.createDataFrame([(x,)], "address string") for x in ("H", "X"))
    prices = spark.createDataFrame([("T", 0, 2.0)], "tok string, day long, px double")
    source, v, e, gone = str(tmp_path / "in"), str(tmp_path / "v"), str(tmp_path / "e"), []
    batches = [
        [("a", "b", 100, 1.0, 0), ("a", "b", 100, 9.0, None), ("b", "H", 200, 1.0, 0), ("X", "a", 100, 1.0, 0)],
        [("c", "H", 1000, 5.0, 1), ("c", "H", 1000, 4.0, 2), (None, "c", 1000, 1.0, 0)],  # to 900: 100 + 700 is before it, 200 + 700 is not
        [("late", "H", 899, 1.0, 0), ("d", None, 950, 1.0, 0)],
        [("b", "H", 1001, 7.0, 0)],  # to 901: the entry of 200 leaves, the vertex b has a newer transfer
    ]
    for data in batches:
        stream = arrive(spark, tiny(spark, data), source)
        state.run_available(state.vertices(stream, hot, burn, "100 seconds", 700), v, lambda b, _: gone.extend(r.address for r in b.where("gone").collect()))
        state.run_available(state.entries(stream, hot, burn, prices, ("leg",), "100 seconds", 700), e)
        if data is batches[2]:
            assert {(r.f, r.t, r.ts) for r in state.table(spark, e, "entry").collect()} == {("b", "H", 200), ("c", "H", 1000), (None, "c", 1000), ("d", None, 950)}
    assert {tuple(r) for r in state.table(spark, e, "entry").collect()} == {("b", "H", "T", 1001, 7.0, 14.0), ("c", "H", "T", 1000, 4.0, 8.0), (None, "c", "T", 1000, 1.0, 2.0), ("d", None, "T", 950, 1.0, 2.0)}
    held = {r.address: (r.last_transfer_at, r.hot_wallet, r.deposit_wallet) for r in state.table(spark, v, "vertex").collect()}
    assert held == {"b": (1001, False, True), "H": (1001, True, False), "c": (1000, False, True), None: (1000, False, False), "d": (950, False, False)}
    assert gone == ["a"]


def test_busy_address_shuffles_few_rows(spark):
    """Rows of one address are put together before the shuffle."""
    hot = spark.createDataFrame([("H",)], "address string")
    many = spark.range(50000, numPartitions=2).select(F.lit("a").alias("f"), F.lit("H").alias("t"), F.col("id").alias("ts"))
    got = state._combined(graph.ends_of(many, hot))
    assert got.count() < 100 and got.groupBy("address").agg(F.max("ts")).count() == 2


def test_once_per_key(spark, tmp_path):
    """Repeats within the watermark go, also those that a later batch brings; other rows stay."""
    r, source = Relations(spark, DIR), str(tmp_path / "in")
    some = written(r.transfers().where("leg = 0"))
    keys = ["f", "t", "tok", "ts", "l_orderkey", "l_linenumber"]
    for _ in range(2):
        some.write.mode("append").parquet(source)
    stream = windows.once_per_key(spark.readStream.schema(some.schema).option("maxFilesPerTrigger", 1000).parquet(source), keys, "4000 days")
    q = stream.writeStream.outputMode("append").format("memory").queryName("once").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("once").count() == some.select(*keys).distinct().count()


def test_windows(spark, tmp_path):
    r = Relations(spark, DIR)
    path = str(tmp_path / "in")
    r.transfers().write.parquet(path)
    stream = spark.readStream.schema(r.transfers().schema).parquet(path)
    q = windows.tumbling_counts(stream).writeStream.outputMode("update").format("memory").queryName("counts").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("counts").agg(F.sum("n")).first()[0] == r.transfers().count()


def test_prune_twice(spark):
    r = Relations(spark, DIR)
    admitted = graph.admit(r.transfers(), r.hot(), r.burn())
    logs, vertices = written(graph.fold_logs(graph.price(admitted, r.prices()), LAST)), written(graph.vertices_of(admitted, r.hot()))
    v, e = (written(x) for x in graph.prune_graph(vertices, logs, r.contracts(), 852076800, 2))
    again_v, again_e = graph.prune_graph(v.drop("number_sent", "number_received", "bot", "contract"), e, r.contracts(), 852076800, 2)
    assert rows(again_e) == rows(e)
    assert rows(again_v.select("address", "bot")) == rows(v.select("address", "bot"))


def test_degrees_add_up(spark):
    r = Relations(spark, DIR)
    edges = written(graph.edges_of(graph.admit(r.transfers(), r.hot(), r.burn())))
    total = graph.degrees(edges).agg(F.sum("number_sent"), F.sum("number_received")).first()
    assert total[0] == total[1] == edges.count()


def test_pipeline(spark):
    r = Relations(spark, DIR)
    t = pipeline.Tables(written(r.transfers()), r.hot(), r.burn(), r.prices(), r.contracts(), r.t("part").select(F.col("p_brand").alias("tok")).distinct())
    s = pipeline.Settings(order=LAST, stages=("export", "exchange_deposits", "deposit_users", "subgraphs"), growth=Growth(rounds=2, leaves=4), replicates=1)
    made = pipeline.run_all(t, s).made
    assert made["pairs"].where("x_address = subx_address").isEmpty()
    flipped = made["pairs"].select(F.col("subx_address").alias("x_address"), F.col("x_address").alias("subx_address"), "deposit_address")
    assert made["pairs"].exceptAll(flipped).isEmpty()
    assert not made["split"].isEmpty()
    columns = made["split"].columns
    assert {"X_Time_0", "SubX_Time_23", "X_Kind", "Similarity"} <= set(columns) and any(c.startswith("SubX_To_") for c in columns)
    members = made["sub"].select("center", F.explode(F.array("f", "t")).alias("address")).distinct().count()
    assert made["embeddings"].count() == members and made["embeddings"].where("size(embedding) <> 24 OR chain_id <> '0x1'").isEmpty()
    m = made["metrics"].first()
    assert m.tp + m.fp + m.fn + m.tn == made["split"].where("part = 'test'").count() == made["scored"].count()
    assert len(t.models["model"].trees) == 2 and t.models["encoding"].names == t.models["model"].columns
