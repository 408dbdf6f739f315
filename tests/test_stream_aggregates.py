"""State that needs no timers is kept by Spark's aggregates, and is what one batch gives."""

import pytest

from ledgerlens.operators import graph
from ledgerlens.streaming import state


def tiny(spark, data):
    return spark.createDataFrame([(f, t, "T", ts, amt, leg) for f, t, ts, amt, leg in data], "f string, t string, tok string, ts long, amt double, leg int")


def test_aggregates_keep_the_state(spark, tmp_path, monkeypatch):
    """No Python has a state; late and old rows count where there is no watermark, and go at it where there is."""
    for processor in (state._Vertex, state._Entry):
        monkeypatch.setattr(processor, "__init__", lambda *a, **k: pytest.fail("state by hand"))
    hot, burn = (spark.createDataFrame([(x,)], "address string") for x in ("H", "X"))
    prices = spark.createDataFrame([("T", 0, 2.0)], "tok string, day long, px double")
    batches = [
        [("a", "b", 100, 1.0, 0), ("a", "b", 100, 9.0, None), ("b", "H", 200, 1.0, 0), ("X", "a", 100, 1.0, 0), ("n", "m", None, 1.0, 0)],
        [("c", "H", 1000, 5.0, 1), ("c", "H", 1000, 4.0, 2), (None, "c", 1000, 1.0, 0), ("c", "d", 900, 1.0, 0), ("c", "d", 899, 1.0, 0)],
        [("late", "H", 899, 1.0, 0), ("d", None, 950, 1.0, 0), ("c", "d", 900, 3.0, 5), ("a", "b", 100, 7.0, 1)],
    ]
    source, v, e, recent = (str(tmp_path / x) for x in ("in", "v", "e", "recent"))
    for data in batches:
        tiny(spark, data).write.mode("append").parquet(source)
        stream = spark.readStream.schema(tiny(spark, data).schema).parquet(source)
        state.run_available(state.vertices(stream, hot, burn, None), v)
        state.run_available(state.entries(stream, hot, burn, prices, ("leg",), None), e)
        state.run_available(state.entries(stream, hot, burn, prices, ("leg",), "100 seconds", 0), recent)
    rows = lambda df: sorted(map(repr, df.collect()))
    admitted = graph.admit(tiny(spark, sum(batches, [])), hot, burn)
    logs = graph.fold_logs(graph.price(admitted, prices), ("leg",))
    assert rows(state.table(spark, v, "vertex")) == rows(graph.vertices_of(admitted, hot))
    assert rows(state.table(spark, e, "entry")) == rows(logs)
    assert rows(state.table(spark, recent, "entry")) == rows(logs.where("ts >= 900"))
    first = graph.admit(tiny(spark, batches[0]), hot, burn)
    assert rows(state.table(spark, v, "vertex", 0)) == rows(graph.vertices_of(first, hot))
    with pytest.raises(ValueError, match="watermark"):
        state.entries(spark.range(1).selectExpr("'a' AS f", "'b' AS t", "'T' AS tok", "id AS ts", "1.0 AS amt", "0 AS leg"), hot, burn, prices, ("leg",), None, 5)
