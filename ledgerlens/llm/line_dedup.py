"""Line dedup by winnowing: runs of lines that occurred before are deleted, wherever in the corpus they stand.

A run is worth deleting from ``min_lines`` lines, or from ``min_words`` words if it has fewer. Its windows are the
shortest runs that are. Each window selects the line with its smallest hash, the last of equals, as its fingerprint:
equal windows select the same line, so a repeated run is guaranteed to share one. Only selected positions are joined
on their fingerprints; those that meet no other position end there. Matches are then extended both ways, line by line
up to the windows that selected them: positions of one fingerprint that agree over ``l`` lines before and ``r`` lines
after form a class, and all but its first lie in a later repeat. Classes stand in for pairs, of which a line that a
third of all rows hold would make too many. Longer runs are the union of their windows. Shorter repeats, such as a
single line of fewer words, stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, let, materialize


def _fingerprints(lines: Column, min_lines: int, min_words: int) -> Column:
    """The lines that windows select: fingerprint, line number, and how far the match must reach to fill each of these windows.

    ``lines`` is an array of ``(i, h, g, w)``. A reach has a hash of all its lines and their numbers.
    """

    def at(ls: Column, p: Column, own: Column) -> Column:
        near = {k: F.get(ls, p + k) for k in range(1 - min_lines, min_lines) if k} | {0: own}
        total = lambda ks: sum((near[k]["w"] for k in ks[1:]), near[ks[0]]["w"]) if ks else F.lit(0)
        out = []
        for n in range(1, min_lines + 1):
            for before in range(n):
                part = list(range(-before, n - before))
                fits = (p >= before) & (p + n - before <= F.size(ls))
                shortest = (total(part[:-1]) < min_words) | (total(part[1:]) < min_words)
                enough = F.lit(True) if n == min_lines else total(part) >= min_words
                least = F.lit(True)
                for k in part:
                    least = least & (near[k]["h"] >= own["h"] if k < 0 else near[k]["h"] > own["h"] if k > 0 else F.lit(True))
                run = F.struct(F.xxhash64(*(near[k]["g"] for k in part)).alias("run"), F.array(*(near[k]["i"] for k in part)).alias("at"))
                out.append(F.when(fits & enough & shortest & least, run))
        return F.filter(F.array(*out), lambda x: x.isNotNull())

    return let(lines, lambda ls: F.filter(F.transform(ls, lambda x, p: F.struct(x["h"].alias("fingerprint"), x["i"].alias("line"), at(ls, p, x).alias("reach"))), lambda x: F.size(x["reach"]) > 0))


def repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_lines: int = 3, min_words: int = 50) -> DataFrame:
    """``doc_id, text_hash, removed``: the numbers of the lines to delete, for the rows that have any."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    lines = F.filter(
        F.transform(
            F.split("text", "\n", -1),
            lambda x, i: F.struct(
                i.alias("i"), F.xxhash64(x).alias("h"), F.xxhash64(F.concat(F.lit("~"), x)).alias("g"), F.size(F.array_remove(F.split(x, SPACE + "+"), "")).alias("w")
            ),
        ),
        lambda x: x["w"] > 0,
    )
    chosen = _fingerprints(lines, min_lines, min_words)
    found = materialize(rows.where("text IS NOT NULL").select("doc_id", F.xxhash64("text").alias("text_hash"), chosen.alias("chosen")))
    each = found.select("doc_id", "text_hash", F.inline("chosen"))
    place = F.struct("doc_id", "text_hash", "line")
    # positions whose fingerprint stands at another one too
    met = each.groupBy("fingerprint").agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first <> last").select("fingerprint")
    grown = materialize(each.join(met.hint("merge"), "fingerprint").select("fingerprint", "doc_id", "text_hash", F.inline("reach")))
    place = F.struct("doc_id", "text_hash", F.col("at")[0].alias("line"))
    again = materialize(grown.groupBy("fingerprint", "run").agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first <> last").select("fingerprint", "run", "first"))
    later = grown.join(again.hint("merge"), ["fingerprint", "run"]).where(~place.eqNullSafe(F.col("first")))
    return materialize(later.groupBy("doc_id", "text_hash").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set("at")))).alias("removed")))


def _without(lines: Column, removed: Column) -> Column:
    """``lines`` without those numbered in the ascending ``removed``: the stretches between them, each taken once."""
    ends = F.concat(removed, F.array(F.size(lines)))

    def stretches(at: Column) -> Column:
        before = lambda k: F.coalesce(F.get(at, k - 1), F.lit(-1))
        return F.flatten(F.transform(at, lambda end, k: F.slice(lines, before(k) + 2, end - before(k) - 1)))

    return let(ends, stretches)


def removed_column(docs: DataFrame, column: str = "line_dedup_removed") -> str:
    """A name that no column of ``docs`` has, in any case, for the number of lines removed."""
    taken = {c.lower() for c in docs.columns}
    while column.lower() in taken:
        column += "_"
    return column


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_lines: int = 3, min_words: int = 50) -> DataFrame:
    """``docs`` with repeated runs cut out of the text, and a last column ``removed_column(docs)``; other columns stay.

    The first occurrence is the one with the smallest id, then text hash, then line; it stays. Lines without a word
    are kept and don't interrupt a run. A null text stays null, a text that goes wholly becomes empty, rows that
    repeat an id and its text count as one occurrence, null ids come first, and an empty table stays empty. Columns may
    have any names. Work is in proportion to the lines of a text, of which there may be very many.
    """
    gone = repeated_lines(docs, id_col, text_col, min_lines, min_words).select(F.col("doc_id").alias("gone_id"), "text_hash", "removed")
    rows = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("own_id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("own_hash"))
    met = rows.join(gone.hint("merge"), F.col("own_id").eqNullSafe(F.col("gone_id")) & (F.col("own_hash") == F.col("text_hash")), "left")
    kept = let(F.split("text", "\n", -1), lambda lines: F.array_join(_without(lines, F.col("removed")), "\n"))
    text = F.when(F.col("removed").isNull(), F.col("text")).otherwise(kept)
    return met.select(*(text.alias(c) if c == text_col else F.col("row").getField(c).alias(c) for c in docs.columns), F.coalesce(F.size("removed"), F.lit(0)).alias(removed_column(docs)))


def report(docs: DataFrame) -> DataFrame:
    """``doc_id, n_lines, n_removed, text`` of each row, the text after deletion."""
    n = F.coalesce(F.size(F.filter(F.split("text", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))), F.lit(0))
    rows = docs.select("doc_id", "text", F.when(F.col("text").isNull(), 0).otherwise(n).cast("long").alias("n_lines"))
    return dedup(rows).select("doc_id", "n_lines", F.col("line_dedup_removed").cast("long").alias("n_removed"), "text")
