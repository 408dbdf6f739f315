"""Scalar expressions: time, text, numbers, arrays."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DAY = 86400
#: For ages below so many seconds, the words, and the unit that a number in them counts.
AGES = (
    (10, "just now", 0), (60, "{} seconds ago", 1), (120, "a minute ago", 0), (3600, "{} minutes ago", 60), (7200, "an hour ago", 0),
    (DAY, "{} hours ago", 3600), (2 * DAY, "yesterday", 0), (7 * DAY, "{} days ago", DAY), (31 * DAY, "{} weeks ago", 7 * DAY),
    (365 * DAY, "{} months ago", 30 * DAY), (None, "{} years ago", 365 * DAY),
)
DURATIONS = (
    (10, "few seconds", 0), (60, "{} seconds", 1), (120, "minute", 0), (3600, "{} minutes", 60), (7200, "hour", 0),
    (DAY, "{} hours", 3600), (2 * DAY, "24 hours", 0), (7 * DAY, "{} days", DAY), (31 * DAY, "{} weeks", 7 * DAY),
    (365 * DAY, "{} months", 30 * DAY), (None, "{} years", 365 * DAY),
)


def div(a: Column, b: Column | int) -> Column:
    """Whole quotient, towards zero."""
    return F.call_function("div", a, F.lit(b) if isinstance(b, int) else b)


def round_to(t: Column, step: int = DAY) -> Column:
    return div(t, step) * step


def hour_of(t: Column) -> Column:
    return div(t % DAY, 3600)


def in_words(span: Column, ladder=AGES) -> Column:
    """A span of seconds in words; none before 0."""

    def words(template: str, unit: int) -> Column:
        head, found, tail = template.partition("{}")
        return F.concat(F.lit(head), div(span, unit).cast("string"), F.lit(tail)) if found else F.lit(template)

    steps = [(span < 0, F.lit("")), *((span < top, words(t, unit)) for top, t, unit in ladder if top)]
    out = reduce(lambda c, s: c.when(*s), steps[1:], F.when(*steps[0]))
    return out.otherwise(words(*ladder[-1][1:]))


def window_end(start: Column, interval: int, delay: int) -> Column:
    """When the window that follows ``start`` is due."""
    return div(start + interval, interval) * interval + delay


def last_part(key: Column, mark: str = "_") -> Column:
    return F.element_at(F.split(key, mark), -1)


def number(x: Column) -> Column:
    """A text as a double, without its commas; null where it is none."""
    return F.expr("try_cast(x as double)") if x is None else F.replace(x, F.lit(","), F.lit("")).try_cast("double")


def from_hex(x: Column) -> Column:
    return F.conv(F.regexp_replace(F.lower(x), "^0x", ""), 16, 10).cast("long")


def batches(low: Column, high: Column, size: int) -> Column:
    """Inclusive ranges of up to ``size`` numbers, as an array of ``(low, high)``."""
    return F.transform(F.sequence(low, high, F.lit(size).cast("long")), lambda s: F.struct(s.alias("low"), F.least(s + size - 1, high).alias("high")))


def floats(text: Column) -> Column:
    """All numbers with a decimal point."""
    return F.transform(F.regexp_extract_all(text, F.lit(r"(-?\d+\.\d+)"), 1), lambda x: x.cast("double"))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; 0 where either vector is empty or null."""
    total = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    size = F.sqrt(total(a, a)) * F.sqrt(total(b, b))
    return F.when(F.coalesce(size, F.lit(0.0)) == 0, 0.0).otherwise(total(a, b) / size)


def sanitised(name: Column) -> Column:
    return F.regexp_replace(name, r"[^\w]", "_")


def sides(df: DataFrame, **columns: tuple[Column, Column]) -> DataFrame:
    """Two rows for each of ``df``: columns by name, as the first and the second row have them.

    The row is repeated before its columns are chosen, as an array of two structs costs several times as much.
    """
    first = F.col("_first")
    return df.withColumn("_first", F.explode(F.array(F.lit(True), F.lit(False)))).select(*(F.when(first, a).otherwise(b).alias(c) for c, (a, b) in columns.items()))
