"""Queries do their whole job: nothing of their tables is left out."""

from pyspark.sql import functions as F

from ledgerlens.catalog import QUERIES

DIR = "/root/testdata/sf0.001"


def test_resume_slice_whole(spark):
    events = spark.read.parquet(f"{DIR}/events.parquet")
    low, high = events.agg(F.min("event_id"), F.max("event_id")).first()
    left = events.where((F.col("event_id") > low + 10) & (F.col("event_id") < high)).count()
    got = QUERIES["resume_slice"](spark, DIR)
    assert got.count() == left > 100
    assert [x[0] for x in got.collect()] == sorted(x[0] for x in got.collect())


def test_merge_edges_whole(spark):
    every = QUERIES["edge_logs"](spark, DIR).agg(F.count("*"), F.max("ts")).first()
    assert QUERIES["merge_edges"](spark, DIR).agg(F.count("*"), F.max("ts")).first() == every
