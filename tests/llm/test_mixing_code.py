"""Passes of the fit run the same generated code, so the driver's memory doesn't grow with them."""

from pyspark.sql import functions as F

from ledgerlens.llm import mixing


def test_passes_share_code(spark):
    u = F.pmod(F.xxhash64("id"), F.lit(1000)) / 1000.0
    posts = spark.range(3000).select((10 + F.col("id") % 7).alias("n_tokens"), (1 - u * 0.5).alias("p_clean"), (u * 0.3).alias("p_low"), (u * 0.2).alias("p_toxic"))
    compiled = lambda: spark.sparkContext._jvm.org.apache.spark.metrics.source.CodegenMetrics.METRIC_COMPILATION_TIME().getCount()
    posts = mixing.materialize(posts)
    mixing.fit_rates(posts)
    before = compiled()
    again = mixing.fit_rates(posts, {"clean": 0.9, "low": 0.06, "toxic": 0.04})
    assert again.residual < 1e-3
    assert compiled() - before < 5
