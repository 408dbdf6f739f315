"""When incremental runs are due, and which times they cover."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .scalars import DAY, window_end

#: The monthly run starts at 01:30 on the first, seven hours ahead of UTC, and covers these days before it.
AHEAD, AT, FROM_DAYS, TO_DAYS = 7 * 3600, 5400, 14, 1


def ends(start: Column, interval: int, delay: int, until: Column) -> Column:
    """Ends of the windows that are due from ``start`` up to ``until``; each begins where the one before ends."""
    first = window_end(start, interval, delay)
    return F.when(first <= until, F.sequence(first, until, F.lit(interval).cast("long"))).otherwise(F.array().cast("array<bigint>"))


def next_window(start: int, interval: int, delay: int, end: int | None = None) -> tuple[int, int] | None:
    """The window that a run resumes with from the time synced last; None after ``end``."""
    due = (start + interval) // interval * interval + delay
    return None if end is not None and start >= end else (start, due)


def monthly_window(now: Column) -> tuple[Column, Column]:
    """First and last second that the monthly run covers."""
    return now - FROM_DAYS * DAY, now - TO_DAYS * DAY


def next_month(now: Column) -> Column:
    """When the monthly run is due next."""
    month = F.add_months(F.trunc(F.to_date(F.timestamp_seconds(now + AHEAD)), "month"), 1)
    return F.unix_timestamp(month.cast("timestamp")) + AT - AHEAD
