"""Token counts kept by digest: only texts that no run has counted are encoded."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import codec
from .common import materialize, text_of

CACHE_SCHEMA = "digest binary, n_tokens long"


def tokenizer_version(path: str) -> str:
    """Digest of the tokenizer file: counts of another file or version are never mixed up."""
    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


def stored(spark, cache: str, version: str) -> DataFrame:
    """The counts kept for one tokenizer, one row a digest even if a retried or second writer has appended some twice; nothing, where none are kept yet."""
    where = f"{cache}/tokenizer={version}"
    at = spark._jvm.org.apache.hadoop.fs.Path(where)
    if at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
        return spark.read.schema(CACHE_SCHEMA).parquet(where).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))
    return spark.createDataFrame([], CACHE_SCHEMA)


def count_tokens(docs: DataFrame, path: str, cache: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 1024) -> DataFrame:
    """One row for each row of ``docs``: ``doc_id, n_bytes, n_tokens, over_limit``.

    Content is normalised by reading null as empty; nothing else may change, or counts would. Its SHA-256 and the
    tokenizer's version make the key. Digests alone look for their counts in ``cache``; only texts of those that have
    none are reduced to one row a digest, moved, encoded, and appended there; then every row takes its count from the
    cache by a join whose hot digests Spark splits. Very long texts are encoded whole, rows that repeat get the same
    count, null ids are kept, empty tables give empty results; other columns are ignored.
    """
    spark, version = docs.sparkSession, tokenizer_version(path)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c = codec(path)
        for b in batches:
            yield pd.DataFrame({"digest": b["digest"], "n_tokens": [len(c.encode(t)) for t in b["text"]]})

    text = text_of("text")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).select("doc_id", text.alias("text"), F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"))
    known = stored(spark, cache, version)
    wanted = rows if known.isEmpty() else rows.join(materialize(rows.select("digest").distinct().join(known, "digest", "left_anti")), "digest", "left_semi")
    misses = wanted.groupBy("digest").agg(F.first("text").alias("text"))
    misses.mapInPandas(run, CACHE_SCHEMA).write.mode("append").parquet(f"{cache}/tokenizer={version}")
    sized = rows.select("doc_id", "digest", F.octet_length("text").cast("long").alias("n_bytes"))
    return sized.join(stored(spark, cache, version), "digest").select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
