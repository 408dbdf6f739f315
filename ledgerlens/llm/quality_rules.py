"""Quality rules: a table of thresholds compiled into one projection, without user functions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, let, text_of, words_of

#: Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "the be to of and that have with in is a an for as was by it on are this at or from "
    "der die das und von zu mit den ein eine ist im auf nicht sich "
    "la le les de des du et en un une que qui dans pour par sur au pas ne "
    "el los las y del se por con su al lo"
).split()


@dataclass(frozen=True)
class Rule:
    """A document fails where ``low <= metric <= high`` is false and it has ``from_words`` words or more."""

    name: str
    metric: str
    low: float = float("-inf")
    high: float = float("inf")
    from_words: int = 0


RULES = (
    Rule("word_length", "mean_word_length", 2.0, 14.0, 10),
    Rule("symbols", "symbol_ratio", high=0.1),
    Rule("capitals", "capital_ratio", high=0.35),
    Rule("stop_words", "stop_word_ratio", low=0.02, from_words=50),
    Rule("repeated_lines", "dup_line_ratio", high=0.6),
    Rule("stutter", "stutter_ratio", high=0.25),
)

#: The ratios as SQL over the counts, so that the same text serves Spark and any other engine.
METRICS = {
    "mean_word_length": "CAST(word_chars AS DOUBLE) / greatest(n_words, 1)",
    "symbol_ratio": "CAST(n_symbols AS DOUBLE) / greatest(n_words, 1)",
    "capital_ratio": "CAST(n_capitals AS DOUBLE) / greatest(word_chars, 1)",
    "stop_word_ratio": "CAST(n_stop_words AS DOUBLE) / greatest(n_words, 1)",
    "dup_line_ratio": "CAST(n_dup_lines AS DOUBLE) / greatest(n_lines, 1)",
    "stutter_ratio": "CAST(n_stutters AS DOUBLE) / greatest(n_words, 1)",
}


def verdict_sql(rules: tuple[Rule, ...] = RULES) -> str:
    """One SQL predicate: true where every rule of the table holds."""
    parts = []
    for r in rules:
        bounds = [f"({METRICS[r.metric]}) {op} {v}" for op, v in ((">=", r.low), ("<=", r.high)) if abs(v) != float("inf")]
        parts.append(f"(n_words < {r.from_words} OR ({' AND '.join(bounds)}))")
    return " AND ".join(parts)


def _repeated_words(hashes: Column, size: int) -> Column:
    """Words that lie in a window of ``size`` words found twice or more.

    Windows are hashed, the hashes sorted with their positions, and equal neighbours kept: linear memory and
    n log n time in the words of one text, however repetitive it is. Most texts repeat no window and stop there.
    """
    windows = let(
        hashes,
        lambda h: F.transform(
            F.slice(h, 1, F.greatest(F.size(h) - (size - 1), F.lit(0))),
            lambda x, i: F.xxhash64(x, *(F.get(h, i + k) for k in range(1, size))),
        ),
    )

    def covered(w: Column) -> Column:
        twins = let(
            F.array_sort(F.transform(w, lambda x, i: F.struct(x.alias("h"), i.alias("i")))),
            lambda s: F.array_sort(
                F.transform(
                    F.filter(
                        s,
                        lambda x, k: (x["h"] == F.get(s, k - 1)["h"]) | (x["h"] == F.get(s, k + 1)["h"]),
                    ),
                    lambda x: x["i"],
                )
            ),
        )
        return let(
            twins,
            lambda p: F.aggregate(
                F.transform(p, lambda x, k: F.least(F.lit(size), F.coalesce(F.get(p, k + 1) - x, F.lit(size)))),
                F.lit(0),
                lambda a, x: a + x,
            ),
        )

    return let(windows, lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0)).otherwise(covered(w)))


def measure(docs: DataFrame, text_col: str = "text", *, window: int = 5) -> DataFrame:
    """``docs`` with the counts that the rules read, in columns whose names are ``q_`` and those of ``COUNTS``.

    Nulls and empty texts have no words, lines or symbols. Columns of ``docs`` are kept; one that is called like a
    count is an error.
    """
    if clash := {f"q_{c}" for c in COUNTS} & set(docs.columns):
        raise ValueError(f"columns called like counts: {sorted(clash)}")
    text = text_of(text_col)
    words, lines, hashes = (f"measure_{k}_{'_' * max(map(len, docs.columns))}" for k in ("words", "lines", "hashes"))  # longer than any column
    out = docs.withColumns({words: words_of(text), lines: F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))})
    out = out.withColumns({hashes: F.transform(words, lambda w: F.xxhash64(w))})
    return out.withColumns(
        {
            "q_n_words": F.size(words).cast("long"),
            "q_word_chars": F.char_length(F.regexp_replace(text, SPACE + "+", "")).cast("long"),
            "q_n_symbols": F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("long"),
            "q_n_lines": F.size(lines).cast("long"),
            "q_n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
            "q_n_repeat_words": _repeated_words(F.col(hashes), window).cast("long"),
            "q_n_capitals": F.regexp_count(text, F.lit("[A-Z]")).cast("long"),
            "q_n_stop_words": F.size(F.filter(words, lambda w: F.lower(w).isin(STOP_WORDS))).cast("long"),
            "q_n_stutters": let(F.col(hashes), lambda h: F.size(F.filter(h, lambda x, i: x == F.get(h, i - 1)))).cast("long"),
        }
    ).drop(words, lines, hashes)


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals", "n_stop_words", "n_stutters")


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Counts and verdict of each row: id, the counts, ``base_failed`` and ``kept``.

    Null and empty texts have no words and fail. Repeated rows are judged one by one; an empty table gives an empty
    result; further columns of ``docs`` are ignored, whatever they are called.
    """
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    counted = measure(own).select("doc_id", *(F.col(f"q_{c}").alias(c) for c in COUNTS))
    failed = F.expr("n_words < 10 OR 100 * n_repeat_words > 20 * n_words")
    return counted.select("*", failed.alias("base_failed"), (~failed & F.expr(verdict_sql(rules))).alias("kept"))


def keep_good(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of ``docs`` that pass, with their own columns."""
    names = {f"q_{c}": c for c in COUNTS}
    rule = " AND ".join(["NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words)", verdict_sql(rules)])
    wrapped = docs.select(F.struct("*").alias("row"), F.col(text_col).alias("text"))
    return measure(wrapped).withColumnsRenamed(names).where(rule).select("row.*")
