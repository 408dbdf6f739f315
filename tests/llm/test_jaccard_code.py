"""The keys of crowded buckets are a small piece of code: 124 of them written out are more than a method may hold."""

import re

from pyspark.sql import functions as F

from ledgerlens.llm import ngram_jaccard


def test_keys_are_small_code(spark):
    nodes = spark.range(3).select(*(F.xxhash64("id", F.lit(i)).alias(f"k{i}") for i in range(ngram_jaccard.SKETCH)), F.lit(1).alias("g"), F.lit(0).alias("h"))
    keys = nodes.select(ngram_jaccard._keys(F.col("g"), F.col("h")).alias("keys"))
    assert all(len(set(r["keys"])) == 4 * (1 + 2 + 4 + 8 + 16) for r in keys.collect())
    said = spark.sparkContext._jvm.PythonSQLUtils.explainString(keys.select(F.explode("keys"))._jdf.queryExecution(), "codegen")
    sizes = [int(x) for x in re.findall(r"maxMethodCodeSize:(-?\d+)", said)]
    assert sizes and all(0 < x < 8000 for x in sizes) and said.count("\n") < 3000


def test_sketches_are_joined_before_keys(spark, monkeypatch):
    """A node of a crowd meets its sketch once, not once for each of its keys."""
    monkeypatch.setattr(ngram_jaccard, "CROWD", 2)
    write, plans = ngram_jaccard.materialize, []

    def seen(df):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return write(df)

    monkeypatch.setattr(ngram_jaccard, "materialize", seen)
    frame = " ".join(f"f{i}" for i in range(60))
    texts = [(i, f"{frame} {' '.join(f'w{i}x{k}' for k in range(12))}") for i in range(40)]
    assert ngram_jaccard.linked(spark.createDataFrame(texts, "doc_id long, text string")).where("component_id <> doc_id").isEmpty()
    keyed = [p for p in plans if "explode(keys" in p]
    assert keyed and all(p.index("explode(keys") < p.index("Join") for p in keyed)
