"""A corpus from raw documents to tokens: quality, repeated lines, near duplicates, mixture, encoding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm import bpe, line_dedup, mixing, ngram_jaccard, quality_rules
from ledgerlens.llm.common import materialize
from ledgerlens.llm.queries import vocabulary


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep; null and empty texts go, equal rows stay or go together, null ids stay."""
    return quality_rules.keep_good(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without runs of lines that occurred before; those of which nothing is left go.

    Rows that repeat an id and its text are one occurrence and keep the same lines; null texts stay null.
    """
    removed = F.col(line_dedup.removed_column(docs))
    cut = line_dedup.dedup(docs).where((removed == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    return cut.withColumn("n_chars", F.when(removed > 0, F.char_length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links make: the smallest id, with all rows of it; null ids and null texts stay."""
    return ngram_jaccard.keep_one(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn at the rates that bring the domains to their target weights, each at most once.

    The clean domain aims at 0.95 of its tokens, which leaves room to meet the others' weights without repeating any.
    Equal rows are drawn alike; null ids and texts, and tables without labels: see ``mixing.drawn``.
    """
    labels, raw = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("labels", "documents"))
    return mixing.drawn(docs, labels, keep=0.95, most=1.0, labelled_docs=raw)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokens of each row: their number and digests of the ids and of the decoded text; a null text has none."""
    return bpe.round_trip(docs, vocabulary())


STAGES = [("quality rules", quality), ("line dedup", lines), ("n-gram Jaccard join", near_duplicates), ("mixing to target weights", mixture), ("BPE encoding and decoding", tokens)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)


#: Mixing iterates over floating-point sums, which SQL can't express; tests hold the stages against plain Python.
ORACLE_SQL = None
QUERIES = {"pipeline": run}
