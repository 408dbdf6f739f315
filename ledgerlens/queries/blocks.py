"""Times and blocks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..fixtures import Relations, seconds
from ..operators import blocks
from .registry import query


@query("""WITH asked AS (SELECT DISTINCT CAST(floor(epoch(ts)) AS BIGINT) + event_id % 7 AS t FROM events),
ends AS (SELECT min(timestamp) AS lo, max(timestamp) AS hi FROM blocks)
SELECT a.t, CASE WHEN a.t BETWEEN lo AND hi THEN b.number END AS number FROM asked a CROSS JOIN ends ASOF LEFT JOIN blocks b ON a.t >= b.timestamp""")
def block_for_timestamp(r: Relations) -> DataFrame:
    asked = r.t("events").select((seconds("ts") + F.col("event_id") % 7).alias("t")).distinct()
    return blocks.block_at(asked, r.blocks())


@query("SELECT timestamp // 86400 * 86400 AS day, min(number) AS first_block, max(number) AS last_block FROM blocks GROUP BY 1")
def block_range(r: Relations) -> DataFrame:
    return blocks.blocks_by_day(r.blocks())


@query("""WITH asked AS (SELECT DISTINCT CAST(floor(epoch(ts)) AS BIGINT) + event_id % 7 - 40 AS s, CAST(floor(epoch(ts)) AS BIGINT) + event_id % 7 - 40 + event_id % 5 * 700 - event_id % 11 // 10 AS e FROM events),
lo AS (SELECT a.s, a.e, b.number AS sl FROM asked a ASOF LEFT JOIN blocks b ON a.s >= b.timestamp),
lo2 AS (SELECT a.*, b.number AS el FROM lo a ASOF LEFT JOIN blocks b ON a.e >= b.timestamp),
up AS (SELECT a.*, b.number AS su FROM lo2 a ASOF LEFT JOIN blocks b ON a.s <= b.timestamp),
up2 AS (SELECT a.*, b.number AS eu FROM up a ASOF LEFT JOIN blocks b ON a.e <= b.timestamp),
p AS (SELECT *, CASE WHEN s > e THEN 'reversed' WHEN el IS NULL OR eu IS NULL THEN 'outside' WHEN sl = el AND su = eu AND sl <> su THEN 'empty' END AS problem FROM up2)
SELECT s AS start, e AS end, CASE WHEN problem IS NULL THEN CASE WHEN sl IS NULL OR su IS NULL OR su = 1 THEN 0 ELSE su END END AS first_block, CASE WHEN problem IS NULL THEN el END AS last_block, problem FROM p""")
def block_range_for_times(r: Relations) -> DataFrame:
    start = seconds("ts") + F.col("event_id") % 7 - 40
    asked = r.t("events").select(start.alias("start"), (start + F.col("event_id") % 5 * 700 - F.expr("event_id % 11 div 10")).alias("end"))
    return blocks.block_ranges(asked, r.blocks())


@query("""WITH e AS (SELECT event_type, CAST(floor(epoch(ts)) AS BIGINT) // 900 * 900 AS ts FROM events),
s AS (SELECT max(lo) AS lo, min(hi) AS hi FROM (SELECT min(ts) AS lo, max(ts) AS hi FROM e GROUP BY event_type))
SELECT unnest(range(lo, hi + 1, 900)) AS ts FROM s""")
def timeline_intersection(r: Relations) -> DataFrame:
    points = r.t("events").select("event_type", (F.floor(seconds("ts") / 900) * 900).alias("ts"))
    return blocks.timeline(points, "event_type", 900)


@query("""WITH e AS (SELECT event_type, CAST(floor(epoch(ts)) AS BIGINT) // 900 * 900 AS ts FROM events),
s AS (SELECT max(lo) AS lo, min(hi) AS hi FROM (SELECT min(ts) AS lo, max(ts) AS hi FROM e GROUP BY event_type))
SELECT unnest(range((lo + hi) // 2 // 900 * 900 + 900, hi + 1, 900)) AS ts FROM s""")
def timeline_from(r: Relations) -> DataFrame:
    """From the middle of the span, rounded up."""
    points = r.t("events").select("event_type", (F.floor(seconds("ts") / 900) * 900).alias("ts"))
    low, high = points.groupBy("event_type").agg(F.min("ts").alias("lo"), F.max("ts").alias("hi")).agg(F.max("lo"), F.min("hi")).first()
    return blocks.timeline(points, "event_type", 900, (low + high) // 2 // 900 * 900 + 1)
