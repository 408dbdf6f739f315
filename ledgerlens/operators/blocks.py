"""Times and blocks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def latest(asked: DataFrame, points: DataFrame, key: list[str] | None = None, step: int = 3600) -> DataFrame:
    """``asked`` (``key, at``) with ``value``: that of the last of ``points`` (``key, at, value``) at or before each time.

    Times meet points within buckets of ``step``; what a bucket without an earlier point needs is carried over from
    the buckets before, of which there is one row each. So no task ever holds all times, nor all of one key. Of
    points at one time the largest value counts.
    """
    key = key or []
    bucket = F.expr(f"floor(at / {step})").alias("bucket")
    both = asked.select(*key, "at", F.lit(None).cast("long").alias("value"), F.lit(True).alias("asks")).unionByName(points.select(*key, "at", F.col("value").cast("long"), F.lit(False).alias("asks")))
    both = both.select("*", bucket)
    ends = points.select(*key, "at", "value", bucket).groupBy(*key, "bucket").agg(F.max_by("value", F.struct("at", "value")).cast("long").alias("last"))
    buckets = both.select(*key, "bucket").distinct().join(ends, [*key, "bucket"], "left")
    order = W.partitionBy(*key).orderBy("bucket") if key else W.orderBy("bucket")
    carried = buckets.select(*key, "bucket", F.last("last", ignorenulls=True).over(order.rowsBetween(W.unboundedPreceding, -1)).alias("before"))
    # a point at the time asked for counts, so at equal times points come first
    near = W.partitionBy(*key, "bucket").orderBy("at", "asks", "value").rowsBetween(W.unboundedPreceding, 0)
    ranked = both.select(*key, "at", "asks", "bucket", F.last("value", ignorenulls=True).over(near).alias("within"))
    return ranked.where("asks").join(carried, [*key, "bucket"]).select(*key, "at", F.coalesce("within", "before").alias("value"))


def block_at(asked: DataFrame, blocks: DataFrame, step: int = 3600) -> DataFrame:
    """``t, number``: the last block at or before each time, null outside the blocks' own times."""
    found = latest(asked.select(F.col("t").alias("at")), blocks.select(F.col("timestamp").alias("at"), F.col("number").alias("value")), step=step)
    limits = F.broadcast(blocks.agg(F.min("timestamp").alias("lo"), F.max("timestamp").alias("hi")))
    return found.join(limits).select(F.col("at").alias("t"), F.when(F.col("at").between(F.col("lo"), F.col("hi")), F.col("value")).alias("number"))


def block_ranges(asked: DataFrame, blocks: DataFrame, strict: bool = False) -> DataFrame:
    """``start, end, first_block, last_block, problem`` of each range of times, both ends included.

    The first block is the one at or after the start, and block 0 instead of block 1; a start outside the blocks'
    times means block 0. The last is the one at or before the end. ``problem`` tells why there is no answer:
    ``reversed``, ``outside`` where the end lies outside the blocks' times, or ``empty`` where no block lies between;
    with ``strict`` it is raised as an error.
    """
    at = lambda sign: blocks.select((F.col("timestamp") * sign).alias("at"), (F.col("number") * sign).alias("value"))
    times = asked.select(F.explode(F.array("start", "end")).alias("at")).distinct()
    lower = latest(times, at(1)).select("at", F.col("value").alias("lower"))
    upper = latest(times.select((-F.col("at")).alias("at")), at(-1)).select((-F.col("at")).alias("at"), (-F.col("value")).alias("upper"))
    bounds = lower.join(upper, "at")
    side = lambda name: bounds.select(F.col("at").alias(name), F.struct("lower", "upper").alias(f"{name}_in"))
    met = asked.distinct().join(side("start"), "start").join(side("end"), "end")
    inside = lambda name: F.col(f"{name}_in.lower").isNotNull() & F.col(f"{name}_in.upper").isNotNull()
    problem = F.when(F.col("start") > F.col("end"), "reversed").when(~inside("end"), "outside")
    problem = problem.when(inside("start") & (F.col("start_in") == F.col("end_in")) & (F.col("start_in.lower") != F.col("start_in.upper")), "empty")
    if strict:
        problem = F.when(problem.isNotNull(), F.raise_error(F.concat(F.lit("no blocks for the times asked for: "), problem)).cast("string"))
    first = F.when(inside("start") & (F.col("start_in.upper") != 1), F.col("start_in.upper")).otherwise(0)
    found = met.withColumn("problem", problem)
    good = F.col("problem").isNull()
    return found.select("start", "end", F.when(good, first).alias("first_block"), F.when(good, F.col("end_in.lower")).alias("last_block"), "problem")


def blocks_by_day(blocks: DataFrame) -> DataFrame:
    """First and last block of each day that has any."""
    return blocks.groupBy(F.expr("timestamp div 86400 * 86400").alias("day")).agg(F.min("number").alias("first_block"), F.max("number").alias("last_block"))


def timeline(points: DataFrame, key: str, step: int, start: int | None = None) -> DataFrame:
    """``ts``: times at ``step`` that every key's span covers, from ``start`` rounded up if that is later; none where the spans don't meet."""
    spans = points.groupBy(key).agg(F.min("ts").alias("lo"), F.max("ts").alias("hi"))
    ends = spans.agg(F.max("lo").alias("lo"), F.min("hi").alias("hi"))
    if start is not None:
        ends = ends.withColumn("lo", F.when(F.col("lo") < start, F.lit(-(-start // step) * step)).otherwise(F.col("lo")))
    ends = ends.where("lo <= hi")
    return ends.select(F.explode(F.sequence("lo", "hi", F.lit(step).cast("long"))).alias("ts"))
