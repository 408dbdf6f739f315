"""Cases worked out by hand."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from ledgerlens.functions import scalars
from ledgerlens.operators import blocks, deposits, embedding, features, graph, names, training
from ledgerlens.sources import scans, store


class AnyOrder(list):
    def __eq__(self, other):
        return sorted(self, key=repr) == sorted(other, key=repr)


def rows(df, *columns):
    return AnyOrder(tuple(r) for r in df.select(*columns).collect())


def table(spark, data, schema):
    return spark.createDataFrame(data, schema)


@pytest.fixture(scope="module")
def logs(spark):
    t = table(spark, [("A", "B", "T1", 100, 1.0, 10.0, 1), ("A", "B", "T1", 100, 2.0, 20.0, 2), ("A", "B", "T1", 160, 3.0, None, 3), ("A", "B", "T2", 100, 4.0, 40.0, 4)], "f string, t string, tok string, ts long, amt double, usd double, k int")
    return graph.fold_logs(t, ("k",))


def test_last_write_wins(logs):
    assert rows(logs, "tok", "ts", "amt", "usd") == [("T1", 100, 2.0, 20.0), ("T1", 160, 3.0, None), ("T2", 100, 4.0, 40.0)]


def test_prune_logs(logs):
    assert rows(graph.prune_logs(logs, 150), "tok", "ts") == [("T1", 160)]
    assert graph.prune_logs(logs, 200).isEmpty()


def test_admission(spark):
    t = table(spark, [("H", "A"), ("A", "H"), ("Z", "A"), ("A", "Z"), ("A", "B")], "f string, t string")
    hot, burn = table(spark, [("H",)], "address string"), table(spark, [("Z",)], "address string")
    assert rows(graph.admit(t, hot, burn), "f", "t") == [("A", "B"), ("A", "H")]


def test_prices(spark):
    daily = graph.daily_prices(table(spark, [("X", 86400, 1.0), ("X", 100000, 2.0), ("X", 172800, 3.0), ("Y", 0, 0.0)], "tok string, ts long, px double"))
    assert rows(daily, "tok", "day", "px") == [("X", 86400, 2.0), ("X", 172800, 3.0), ("Y", 0, 0.0)]
    t = table(spark, [("X", 90000, 5.0), ("X", 259200, 5.0), ("Y", 10, 5.0)], "tok string, ts long, amt double")
    assert rows(graph.price(t, daily), "tok", "ts", "usd") == [("X", 259200, None), ("X", 90000, 10.0), ("Y", 10, None)]


def test_degrees(spark):
    e = table(spark, [("A", "B"), ("A", "C"), ("B", "C"), ("C", "C")], "f string, t string")
    assert rows(graph.degrees(e), "address", "number_sent", "number_received") == [("A", 2, 0), ("B", 1, 1), ("C", 1, 3)]


def test_reuse_pairs(spark):
    users = table(spark, [("D1", "u1"), ("D1", "u2"), ("D1", "u3"), ("D2", "u3"), ("D2", "u4"), ("D2", "u5")], "deposit string, usr string")
    got = deposits.reuse_pairs(deposits.single_deposit(users))
    assert rows(got, "x_address", "subx_address") == [("u1", "u2"), ("u2", "u1"), ("u4", "u5"), ("u5", "u4")]


def test_hours(spark):
    h = features.hours(table(spark, [("g", "a", t) for t in (0, 3599, 3600, 86399, 90000)], "sg string, f string, ts long"), "f").first()["time"]
    assert (h[0], h[1], h[23], sum(h)) == (2, 2, 1, 5)


def test_token_usd(spark):
    e = [("g", "a", "1", "X", v) for v in (10.0, 20.0)] + [("g", "a", "1", "Y", 7.0), ("g", "a", "2", "X", 5.0), ("g", "a", "2", "W", 1.0), ("g", "a", "2", "W", 3.0)]
    got = features.token_usd(table(spark, e, "sg string, f string, t string, tok string, usd double"), table(spark, [("X",)], "tok string"), "f")
    assert rows(got, "token", "usd") == [("X", 20.0), ("other_token", 9.0)]


def test_add24(spark):
    df = spark.range(1).select(features.add24(F.array(F.lit(1), F.lit(2)), F.lit(None).cast("array<int>")).alias("x"))
    assert df.first()["x"] == [1, 2] + [0] * 22


def test_block_at(spark):
    b = table(spark, [(1, 100), (2, 112), (3, 124), (4, 9000)], "number long, timestamp long")
    asked = table(spark, [(112,), (120,), (124,), (99,), (9001,), (8000,)], "t long")
    assert dict(rows(blocks.block_at(asked, b), "t", "number")) == {112: 2, 120: 2, 124: 3, 99: None, 9001: None, 8000: 3}


def test_two_hop(spark):
    e = table(spark, [("U", "N1"), ("N2", "U"), ("U", "H"), ("N1", "X"), ("N1", "H"), ("N2", "Y"), ("X", "Q")], "f string, t string")
    d = graph.degrees(e)
    v = d.select("address", (F.col("address") == "H").alias("hot_wallet"))
    got = graph.two_hop(table(spark, [("U",)], "center string"), e, v, d)
    assert rows(got, "f", "t") == [("N1", "X"), ("N2", "U"), ("N2", "Y"), ("U", "N1")]


def test_splits(spark):
    data = [("g", f"x{i}", "y", i < 4) for i in range(14)]
    got = features.split_balanced(table(spark, data, "sg string, x string, subx string, label boolean"), 0.9)
    assert rows(got.groupBy("part", "label").count(), "part", "label", "count") == [("test", False, 7), ("test", True, 1), ("train", False, 3), ("train", True, 3)]
    ten = table(spark, [("g", f"x{i}", "y", True) for i in range(10)], "sg string, x string, subx string, label boolean")
    assert features.split_by_address(ten, 0.9).where("part = 'train'").count() == 9
    assert features.split_by_address(ten.limit(1), 0.9).where("part = 'train'").count() == 1


def test_scalars(spark):
    one = spark.range(1)
    texts = {"1,234.5": 1234.5, "abc": None, "": None, "-3": -3.0}
    for t, v in texts.items():
        assert one.select(scalars.number(F.lit(t)).alias("v")).first()["v"] == v
    assert one.select(scalars.cosine(F.array(F.lit(1.0), F.lit(0.0)), F.array(F.lit(1.0), F.lit(1.0))).alias("v")).first()["v"] == pytest.approx(0.70710678)
    assert one.select(scalars.cosine(F.array().cast("array<double>"), F.array(F.lit(1.0))).alias("v")).first()["v"] == 0.0
    said = {-1: "", 5: "just now", 59: "59 seconds ago", 100: "a minute ago", 3601: "an hour ago", 90000: "yesterday", 8 * 86400: "1 weeks ago", 800 * 86400: "2 years ago"}
    for d, words in said.items():
        assert one.select(scalars.in_words(F.lit(d)).alias("v")).first()["v"] == words


def test_timeline(spark):
    points = [("a", t) for t in (0, 900, 1800, 2700)] + [("b", t) for t in (900, 1800, 3600)]
    assert rows(blocks.timeline(table(spark, points, "k string, ts long"), "k", 900), "ts") == [(1800,), (2700,), (900,)]
    assert blocks.timeline(table(spark, [("a", 0), ("b", 900)], "k string, ts long"), "k", 900).isEmpty()


def test_dangling_and_tags(spark):
    v = table(spark, [("A", 3), ("K", 3), ("B", 2), ("C", None)], "address string, number_sent int")
    tagged = graph.tag_bots(v, table(spark, [("K", True)], "address string, is_contract boolean"), 2)
    assert rows(tagged, "address", "bot", "contract", "number_sent") == [("A", True, False, None), ("B", False, False, 2), ("C", False, False, None), ("K", False, True, None)]
    d = table(spark, [("a", 0, 0), ("b", None, 0), ("c", 1, 0)], "address string, number_sent int, number_received int")
    assert rows(graph.dangling(d), "address") == [("a",)]


def test_pairs(spark):
    f = table(spark, [("A", "A"), ("A", "B"), ("A", "C"), ("Z", "B"), ("Z", "C"), ("Q", "Q")], "sg string, address string")
    assert rows(features.pairs(f), "sg", "x", "subx") == [("A", "A", "B"), ("A", "A", "C"), ("Z", "B", "C")]


def test_upserts(spark):
    old, patch = table(spark, [(1, ["a"])], "id int, tags array<string>"), table(spark, [(1, ["a", "b"]), (2, ["c"])], "id int, tags array<string>")
    merged = store.upsert_add_to_set(old, patch, "id", ["tags"])
    assert rows(merged, "id", "tags") == [(1, ["a", "b"]), (2, ["c"])]
    again = store.upsert_add_to_set(merged, patch, "id", ["tags"])
    assert rows(again, "id", "tags") == rows(merged, "id", "tags")
    a = table(spark, [(1, 1, 2, ["x"])], "id int, a int, b int, l array<string>")
    p = table(spark, [(1, None, 3, ["y", ""], ["a"])], "id int, a int, b int, l array<string>, cleared array<string>")
    assert rows(store.upsert_merge(a, p, "id", ("l",)), "id", "a", "b", "l") == [(1, None, 3, ["x", "y"])]


def test_names(spark):
    e = [(10, "NAMEREGISTERED", "n1", "a", "x"), (11, "NAMEREGISTERED", "n2", "b", "y"), (12, "ADDRESSCHANGED", "n1", "a", "addr1"), (13, "ADDRESSCHANGED", "n3", "c", "addr3")]
    got = names.merge_events(table(spark, e, "block_number long, event_type string, node string, name string, new_address string"))
    assert rows(got, "node", "kind", "new_address", "block_number") == [("n1", "registered", "addr1", 12), ("n2", "registered", None, 11), ("n3", "leftover", "addr3", 13)]


def test_namehash(spark):
    """Published hashes; nulls, empty names, empty labels and repeats; and the permutation against the standard library."""
    root, eth = "0x" + "0" * 64, "0x93cdeb708b7545dc668eb9280176169d1c33cfd8ed6f04690a0bcc88a93fc4ae"
    foo = "0xde9b09fd7c5f901e23a3f19fecc54828e9c848539801e86591bd9801b019f84f"
    assert names.namehash([None, "", "eth", "foo.eth", "eth"]) == [root, root, eth, foo, eth]
    assert names.namehash([]) == [] and len(set(names.namehash(["a.eth", ".eth", "a..eth", "eth."]))) == 4
    assert names.keccak256([b""])[0].hex() == "c5d2460186f7233c927e7db2dcc703c0e500b653ca82273b7bfad8045d85a470"
    rng = random.Random(3)
    texts = [rng.randbytes(n) for n in (*range(0, 600, 7), 135, 136, 137, 271, 272, 273, 5000)]
    assert names.keccak256(texts, pad=6) == [hashlib.sha3_256(t).digest() for t in texts]
    got = names.with_namehash(table(spark, [("foo.eth",), (None,), ("eth",), ("foo.eth",)], "name string"))
    assert rows(got, "name", "namehash") == [("foo.eth", foo), (None, root), ("eth", eth), ("foo.eth", foo)]


def test_prune_vertices(spark):
    v = table(spark, [("A", 90), ("B", 200), ("C", None)], "address string, last_transfer_at long")
    kept, left = graph.prune_vertices(v, table(spark, [("A", "B"), ("B", "C")], "f string, t string"), 100)
    assert rows(kept, "address") == [("B",)]
    assert left.isEmpty()


def test_walks():
    near = {"a": ["b", "c"], "b": ["a"], "c": ["a", "d"], "d": ["c"], "z": []}
    for seed in range(20):
        w = embedding.diffusion_walk(near, "a", 4, str(seed))
        assert len(w) == 7 and w[0] == w[-1] == "a"
        assert all(y in near[x] for x, y in zip(w, w[1:], strict=False))
    assert embedding.diffusion_walk(near, "z", 5, "0") == ["z"]


def test_walks_and_embeddings(spark):
    sub = table(spark, [("g", "a", "b"), ("g", "b", "c"), ("h", "a", "z")], "center string, f string, t string")
    w = embedding.walks(sub, replicates=2)
    assert w.count() == 2 * (3 + 2)
    e = embedding.filled(table(spark, [("a",), ("nobody",)], "address string"), embedding.embed(w))
    found = {r["address"]: r["embedding"] for r in e.collect()}
    assert len(found["a"]) == 24 and any(found["a"]) and found["nobody"] == [0.0] * 24


def test_components_against_union_find(spark):
    rng = random.Random(3)
    pairs = [(f"v{rng.randrange(80):02d}", f"v{rng.randrange(80):02d}") for _ in range(60)]
    parent = {v: v for p in pairs for v in p}

    def top(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for a, b in pairs:
        x, y = sorted((top(a), top(b)))
        parent[y] = x
    got = graph.components(table(spark, pairs, "f string, t string"), store.written)
    assert {r["address"]: r["component"] for r in got.collect()} == {v: top(v) for v in parent}


def test_related_and_pages(spark):
    t = table(spark, [("h1", 1, "a", "b"), ("h2", 2, "b", "a"), ("h3", 3, "c", "d"), ("h4", 9, "a", "c")], "hash string, block_number int, from_address string, to_address string")
    assert rows(scans.related(t, table(spark, [("a",)], "address string"), 1, 9), "hash") == [("h1",), ("h2",)]
    assert rows(scans.page(t, "hash", 1, 2), "hash") == [("h2",), ("h3",)]


def test_label_and_metrics(spark):
    good = table(spark, [("True",), ("no",)], "x string").select(training.mapped_label(F.col("x")).alias("y"))
    assert rows(good, "y") == [(0,), (1,)]
    with pytest.raises(Exception, match="no label"):
        table(spark, [("maybe",)], "x string").select(training.mapped_label(F.col("x")).alias("y")).collect()


def test_smote_whole(spark):
    """The missing number exactly, each between a minority row and one of its five nearest."""
    made = random.Random(3)
    few = [(round(made.uniform(0, 900), 3), round(made.uniform(0, 900), 3)) for _ in range(39)]
    few.append(few[0])
    df = table(spark, [(a, b, 1) for a, b in few] + [(float(i), 1.0, 0) for i in range(133)], "a double, b double, label int")
    new = training.oversampled(df, ["a", "b"], "label", block=8).collect()
    assert len(new) == 93 and {r["label"] for r in new} == {1}
    near = [(p, q) for i, p in enumerate(few) for q in sorted((x for j, x in enumerate(few) if j != i), key=lambda x: (x[0] - p[0]) ** 2 + (x[1] - p[1]) ** 2)[:5]]
    on = lambda r, p, q: any(abs(p[0] + u * (q[0] - p[0]) - r["a"]) < 1e-6 and abs(p[1] + u * (q[1] - p[1]) - r["b"]) < 1e-6 for u in [((r["a"] - p[0]) / (q[0] - p[0])) if q[0] != p[0] else 0.0] if 0 <= u <= 1)
    assert all(any(on(r, p, q) for p, q in near) for r in new)
    assert training.oversampled(df.where("label = 0 OR a = 0").limit(5), ["a", "b"], "label").count() == 0
    assert training.oversampled(table(spark, [(1.0, 1), (2.0, 1), (3.0, 0), (4.0, 0)], "a double, label int"), ["a"], "label").count() == 0
    assert training.oversampled(table(spark, [(1.0, 1), (3.0, 0), (4.0, 0)], "a double, label int"), ["a"], "label").count() == 0
