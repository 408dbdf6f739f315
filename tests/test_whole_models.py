"""Queries train whole models; small tables are grown by one task; splits shuffle counts only."""

import hashlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerlens.catalog import QUERIES
from ledgerlens.operators import boosting, features


def numbers(spark, n):
    x = np.round(np.random.default_rng(4).normal(size=(n, 5)), 1)
    y = ((x[:, 0] + x[:, 1] ** 2 > 0.8) | (x[:, 2] > 1)).astype(int)
    return spark.createDataFrame(pd.DataFrame(np.c_[x, y], columns=[*"abcde", "label"])).repartition(3)


def test_one_task_grows_what_passes_grow(spark, monkeypatch):
    """Trees of a table that one task holds are those of passes over a distributed one."""
    df = numbers(spark, 600)
    how = boosting.Growth(rounds=3, leaves=8, fraction=0.6, rate=0.3)
    alone = boosting.train(df, list("abcde"), "label", how)
    monkeypatch.setattr(boosting, "ALONE", 0)
    passes = boosting.train(df, list("abcde"), "label", how)
    for a, b in zip(alone.trees, passes.trees, strict=True):
        assert (a.feature, a.cut, a.left, a.right) == (b.feature, b.cut, b.left, b.right)
        assert a.value == pytest.approx(b.value)
    assert alone.gains == pytest.approx(passes.gains)


def test_queries_train_whole_models(spark, monkeypatch):
    """Queries train with all the rounds and leaves of production."""
    asked = []
    monkeypatch.setattr(boosting, "train", lambda rows, columns, label, how=boosting.Growth(): asked.append(how) or boosting.Model(columns, [[] for _ in columns], 0.0))
    for name in ("train_gbt", "predict"):
        QUERIES[name](spark, "/root/testdata/sf0.001")
    assert asked == [boosting.Growth()] * 2 and asked[0].rounds == 250 and asked[0].leaves == 190


@pytest.mark.parametrize("k", [0, 1, 137, 299, 300])
def test_among_first_shuffles_counts_only(spark, k):
    """The first rows in hash order, without rows being shuffled."""
    df = spark.range(300, numPartitions=3).select(F.concat(F.lit("a"), "id").alias("x"))
    got = df.where(features.among_first(df, k, F.concat(F.lit("42"), "x"), "x"))
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    want = sorted((hashlib.md5(f"42a{i}".encode()).hexdigest(), f"a{i}") for i in range(300))[:k]
    assert sorted(r.x for r in got.collect()) == sorted(x for _, x in want)


def test_labels_go_with_the_pairs(spark):
    """Pairs keep their label through the join with token values, so they need no second one."""
    pairs = spark.createDataFrame([("g", "a", "b", True), ("g", "a", "c", False)], "sg string, x string, subx string, label boolean")
    tokens = spark.createDataFrame([("g", "b", "T", 2.0), ("g", "c", "T", 3.0)], "sg string, address string, token string, usd double")
    got = features.long_features(pairs, tokens, keep=("label",))
    assert {tuple(r) for r in got.collect()} == {("g", "a", "b", "SubX_From_T", 2.0, True), ("g", "a", "c", "SubX_From_T", 3.0, False)}
