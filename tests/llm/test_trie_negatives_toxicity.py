"""Prefix trie, hard negatives and toxicity against brute force and held-out labels."""

import hashlib
import itertools
import math
import re
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import hard_negatives, prefix_trie, queries, toxicity

DIR = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def trie_by_hand(rows):
    own = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            own[c].append((t is not None, t or 0, r or "", x or ""))
    own = {c: [v[2:] for v in sorted(turns)] for c, turns in own.items()}
    seqs = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        seqs[c] = tuple(own.get(c - int(math.fmod(c, 20)), [])[:h] + turns[h:])
    members, ends, kids = defaultdict(list), defaultdict(list), defaultdict(list)
    for c, s in seqs.items():
        ends[s].append(c)
        for d in range(len(s) + 1):
            members[s[:d]].append(c)
    for n in members:
        if n:
            kids[n[:-1]].append(n)
    leaves, saved = defaultdict(int), defaultdict(int)
    for n, m in members.items():
        words = (len(m) - 1) * len(WORD.findall(n[-1][1])) if n else 0
        for d in range(len(n) + 1):
            leaves[n[:d]] += not kids[n]
            saved[n[:d]] += words
    digest = lambda n: hashlib.sha256(",".join(map(str, sorted(ends[n]))).encode()).hexdigest()
    return sorted(((min(m), len(n), min(members[n[:-1]]) if n else None, len(m), len(kids[n]), leaves[n], saved[n], digest(n)) for n, m in members.items()), key=repr)


def talks(spark, rows):
    """With columns that are called like the working ones."""
    d = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return d.withColumns({"c": F.lit(1), "pos": F.lit("x"), "depth": F.lit(2.0), "path": F.lit(None).cast("string")})


ODD_TALKS = [
    (0, 1, "user", "one two"), (0, 2, "bot", None), (0, None, "user", "first"), (0, 3, None, ""), (1, 0, "user", "first"), (1, 1, "user", "one two"), (2, 5, "a", "x"),
    (2, 5, "b", "x"), (2, 5, "b", "x"), (20, 0, "user", "é 漢字 \t y"), (21, 0, "user", "lost"), (21, 1, "user", "z " * 3000), (40, 1, "", ""), (41, 0, "q", "r"), (None, 0, "user", "nobody"),
    (-3, 0, "user", "one two"), (-3, 1, "user", "three"), (67, 1, "only", "its own"),
]


@pytest.mark.parametrize("chunk", [2, 4096])
def test_trie_odd(spark, monkeypatch, chunk):
    monkeypatch.setattr(prefix_trie, "CHUNK", chunk)
    long = [(c, t, "user", f"turn {t if t < 9 or c == 60 else c * 100 + t}") for c in (60, 61, 62, 63, 65) for t in range(11)]
    rows = ODD_TALKS + long
    got = sorted(map(tuple, prefix_trie.trie(talks(spark, rows)).collect()), key=repr)
    assert got == trie_by_hand(rows)
    assert any(r[2] is None for r in got)


def test_trie_empty(spark):
    assert prefix_trie.trie(talks(spark, [])).count() == 0


def test_trie_light_paths(spark):
    """Enough branches that totals rise over several rounds."""
    rows = [(100 + 20 * k + 7, t, "u", f"t{t}" if t == 0 or (k >> (t - 1)) & 1 else f"t{t}k{k % (1 << t)}") for k in range(16) for t in range(5)]
    assert sorted(map(tuple, prefix_trie.trie(talks(spark, rows)).collect()), key=repr) == trie_by_hand(rows)


def test_negatives_by_hand(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "ROWS", 7)
    monkeypatch.setattr(hard_negatives, "ANCHORS", 2)
    monkeypatch.setattr(hard_negatives, "DIMS", 3)
    rng = np.random.default_rng(3)
    vectors = lambda n: np.round(rng.normal(size=(n, 8)), 1)  # noqa: E731  coarse, so that scores tie
    rows = [(int(i), v.tolist(), int(y)) for i, v, y in zip([*range(0, 900, 20), *range(1, 30)], vectors(74), rng.integers(0, 4, 74), strict=True)]
    rows += [(0, rows[0][1], rows[0][2]), (100, rows[1][1], 2), (5, None, 1), (7, [1.0, float("nan")], 1), (9, [float("inf")], 2), (11, [1.0, None], 1), (13, [1.0], None), (15, [], 3), (17, [0.5, 0.25], 3), (None, vectors(1)[0].tolist(), 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("n", F.lit("x")).withColumn("part", F.lit(0))
    got = sorted((tuple(r) for r in hard_negatives.mine(df).collect()), key=repr)

    usable = [(i, (y + 1) % 10 if i is not None and i % 7 == 0 else y, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v, y in rows if y is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    dot = lambda a, b: sum(p * q for p, q in zip(a, b, strict=False))
    order = lambda pair: (-pair[1], pair[0] is None, pair[0] or 0)
    want = []
    for k, (i, y, v) in enumerate(usable):
        if i is None or i % 100:
            continue
        scored = [(j, dot(v, w), z) for m, (j, z, w) in enumerate(usable) if m != k]
        for p, s, _ in sorted((x for x in scored if x[2] == y), key=order)[:5]:
            fit = sorted((x for x in scored if x[2] != y and 30 * s <= 100 * x[1] <= 90 * s), key=order)[:10]
            want += [(i, p, r, j, s, t) for r, (j, t, _) in enumerate(fit, 1)]
    assert got == sorted(want, key=repr) and len(got) > 50
    assert hard_negatives.mine(df.limit(0)).count() == 0


def test_product_exact():
    a = np.array([[1 << 31, -(1 << 26)], [3, 4]], np.int64)
    assert (hard_negatives.product(a, a) == np.array([[x[0] * y[0] + x[1] * y[1] for y in a] for x in a])).all()
    assert hard_negatives.product(a[1:], a[1:])[0, 0] == 25


@pytest.mark.parametrize("name", ["op11_prefix_trie", "op12_hard_negatives"])
def test_twins(spark, name):
    con = duckdb.connect()
    for t in ("conversations", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    got, want = queries.QUERIES[name](spark, DIR), con.sql(queries.ORACLE_SQL[name])
    columns = sorted(got.columns)
    assert sorted(want.columns) == columns
    assert sorted(map(tuple, got.select(*columns).collect()), key=repr) == sorted(want.select(*columns).fetchall(), key=repr)


def kernel_by_hand(a, b):
    a, b = "^" + a, "^" + b
    total = 0.0
    for i in itertools.combinations(range(len(a)), 3):
        for j in itertools.combinations(range(len(b)), 3):
            if [a[k] for k in i] == [b[k] for k in j]:
                total += 0.7 ** (i[-1] - i[0] + 1 + j[-1] - j[0] + 1)
    return total


def test_kernel():
    words = ["idiot", "id*iot", "dot", "io", "toad"]
    marks = toxicity.Strings("adiot")
    known = np.unique(np.concatenate([c[c > 0] for _, _, codes, _ in marks.each(words) for c in codes]))
    rows = toxicity.kernels(marks, words, known)
    for x, y in itertools.product(range(5), range(5)):
        plain = [w.replace("*", "*") for w in (words[x], words[y])]
        # a gap never matches: give it another sign on each side
        a, b = plain[0].replace("*", "1"), plain[1].replace("*", "2")
        own = [kernel_by_hand(w.replace("*", "1"), w.replace("*", "2")) for w in plain]
        assert rows[x] @ rows[y] == pytest.approx(kernel_by_hand(a, b) / math.sqrt(own[0] * own[1]), abs=1e-5)


def test_folded_machine():
    """One weight for each subsequence decides as the machine over landmarks does."""
    toxic, clean = ["idiot", "moron", "stupid"], ["the", "and", "table", "thing", "another", "window", "house"]
    m = toxicity.fit_machine(toxic + clean[:3], toxic + clean, np.array([True] * 3 + [False] * 7), np.ones(10))
    f = m.decide([*toxic, *clean, "i-d-i-o-t", "st*upid", "", "x"])
    assert (f[:3] > 0).all() and (f[3:10] < 0).all() and (f[10:12] > 0).all() and (f[12:] == m.constant).all()


def test_words_in():
    assert toxicity.words_in('The "Idiot," i d i o t') == {"the", "idiot", "i-d-i-o-t", "i", "d", "o", "t"}
    long = "ab" * 500 + "idiot" + "cd" * 500
    assert any("idiot" in w for w in toxicity.words_in(long)) and all(len(w) <= toxicity.WINDOW for w in toxicity.words_in(long))


SCORES = "doc_id long, held_out boolean, score double, predicted int"


def test_toxicity_odd(spark):
    names = "doc_id long, text string, lang string, score string, word string"
    texts = [(i, f"some plain words {i} here and there" + (" you stupid idiot" if i % 3 == 0 else ""), "en", "x", "y") for i in range(120)]
    texts += [(None, "idiot", "en", "x", "y"), (500, None, None, None, None), (501, "", "en", "x", "y"), (3, "you idiot", "en", "x", "y"), (502, "w " * 50_000 + "idiot", "en", "", ""), (503, "a" * 100_000, "", "", "")]
    documents = spark.createDataFrame(texts, names)
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(120)] + [(1, 7), (None, 1), (None, 0)], "doc_id long, toxic int").withColumn("text", F.lit("z"))
    rows = toxicity.score(documents, labels).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
    by = {r["doc_id"]: r["predicted"] for r in rows}
    assert [by[i] for i in range(120)] == [int(i % 3 == 0) for i in range(120)]
    assert by[502] == 1 and by[500] == by[501] == by[503] == 0 and by[None] == 1
    for few in (labels.limit(0), labels.where("toxic = 1")):
        assert {r["score"] for r in toxicity.score(documents, few).collect()} == {float(few.count() > 0)}
    assert toxicity.score(documents.limit(0), labels).count() == 0


def test_toxicity_held_out(spark):
    """Accuracy on labels that were not learnt from, and spaced or altered insults in texts that were never seen."""
    documents, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit(documents, labels)
    rows = toxicity.score(documents, labels, model).where("held_out").join(labels.select("doc_id", "toxic"), "doc_id").toPandas()
    bad, good = (rows[rows["toxic"] == y]["score"].to_numpy() for y in (1, 0))
    assert np.mean([(b > good).mean() + (b == good).mean() / 2 for b in bad]) > 0.92
    assert (good >= 0.5).mean() < 0.04 and (bad >= 0.5).mean() > 0.7
    assert (model.probability(model.machine.decide(["stupid", "st*upid", "idiot", "i.d.i.o.t"])) >= 0.5).all()
    gapped, *clean = model.probability(model.machine.decide(["s-t-u-p-i-d", "the", "and", "thing"]))
    assert max(clean) < 0.1 and gapped > 4 * max(clean)  # so few labels leave it just under a half
