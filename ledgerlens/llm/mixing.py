"""Mixing to target weights: soft membership in domains, and document rates that meet the domains' totals.

A classifier trained on the labelled table gives each document a posterior over the domains. Non-negative rates,
one a document and all 1 at first, then follow the projected gradient of the squared difference between the
expected token totals of the domains and their targets. Steps are summed and projected last (lazy projection), so
the rate of a document follows from its posterior and one number a domain. A step is taken in the metric of the
documents that no bound holds; its length is the best of a few that one pass over the posteriors compares. Steps end
when every domain is within ``close`` of its target, or when no step lowers the objective, which is then reported.
"""

from __future__ import annotations

import math
import warnings
from dataclasses import dataclass

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, materialize, text_of

DOMAINS = ("clean", "low", "toxic")
#: Share of the expected tokens that each domain shall have; by default the first domain keeps its own total.
TARGETS = {"clean": 0.96, "low": 0.03, "toxic": 0.01}
BUCKETS = 1 << 14
#: The classifier is fitted on no more labelled documents than these, those with the smallest hash.
MOST_LABELLED = 6000
TEMPERATURES = (0.25, 0.5, 0.75, 1.0, 1.5, 2.0)


def domain_of(quality: Column, toxic: Column) -> Column:
    return F.when(toxic == 1, "toxic").when(quality == 0, "low").otherwise("clean")


def _words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), r"[\x20\x09-\x0D.,]+"), "")


def _features(text: Column, words: Column) -> Column:
    """Hash buckets of the distinct words and of a few traits of the whole text."""

    def traits(w: Column, d: Column) -> Column:
        n = F.greatest(F.size(w), F.lit(1))
        marks, capitals = F.regexp_count(text, F.lit(r"[#*$%&|<>!]")), F.regexp_count(text, F.lit("[A-Z]"))
        grade = lambda x, *steps: sum((F.when(x > s, 1).otherwise(0) for s in steps[1:]), F.when(x > steps[0], 1).otherwise(0))
        named = [
            F.concat(F.lit("marks "), grade(marks / n, 0.05, 0.2, 1.0).cast("string")),
            F.concat(F.lit("capitals "), grade(capitals / n, 0.5, 2.0).cast("string")),
            F.concat(F.lit("variety "), grade(F.size(d) / n, 0.1, 0.3, 0.5).cast("string")),
        ]
        return F.array(*(F.pmod(F.xxhash64(t), F.lit(BUCKETS)) for t in named))

    def hashed(w: Column) -> Column:
        return let(F.array_distinct(w), lambda d: F.concat(F.transform(d, lambda x: F.pmod(F.xxhash64(x), F.lit(BUCKETS))), traits(w, d)))

    return let(words, hashed)


@dataclass(frozen=True)
class Classifier:
    """Logistic regression over hashed words: weights by domain and bucket, and a temperature for its posteriors."""

    prior: tuple[float, ...]
    weights: tuple[tuple[float, ...], ...]
    temperature: float = 1.0

    @property
    def blind(self) -> bool:
        """Whether every text gets the same posterior for every domain."""
        return len(set(self.prior)) == 1 and not any(map(any, self.weights))

    def scores(self, features: Column) -> list[Column]:
        # posteriors depend on differences only, so the first domain's score is 0 and costs nothing
        out, base = [F.lit(0.0)], self.weights[0]
        for prior, own in list(zip(self.prior, self.weights, strict=True))[1:]:
            prior, weights = prior - self.prior[0], [a - b for a, b in zip(own, base, strict=True)]
            table = F.split(F.lit(",".join(f"{w:.5g}" for w in weights)), ",").cast("array<double>")  # folded into a constant
            out.append(F.lit(prior) + let(table, lambda t: F.aggregate(features, F.lit(0.0), lambda a, i: a + F.get(t, i.cast("int")))))
        return out

    @staticmethod
    def posteriors(scores: list[Column], temperature: float) -> list[Column]:
        top = F.greatest(*scores)
        powers = [F.exp((s - top) / temperature) for s in scores]
        total = sum(powers[1:], powers[0])
        return [p / total for p in powers]


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: int = MOST_LABELLED) -> Classifier:
    """Fit on up to ``most`` labelled documents; a fifth of them sets the temperature. No label, no opinion."""
    picked = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max(F.struct("quality", "toxic")).alias("l"))
    picked = picked.select("doc_id", domain_of(F.col("l.quality"), F.col("l.toxic")).alias("domain")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    texts = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text")).join(F.broadcast(picked), "doc_id")  # no more rows than ``most``
    sample = materialize(texts.select("domain", _features(F.col("text"), _words(F.col("text"))).alias("features"), (F.pmod(F.xxhash64("doc_id", F.lit("held out")), F.lit(5)) == 0).alias("held")))
    train = sample.where("NOT held")
    sizes = {r["domain"]: r["count"] for r in train.groupBy("domain").count().collect()}
    shares = tuple(math.log(sizes[d] / sum(sizes.values())) if d in sizes else -20.0 if sizes else 0.0 for d in DOMAINS)
    by_share = Classifier(shares, tuple((0.0,) * BUCKETS for _ in DOMAINS))
    if len(sizes) < 2:
        return by_share
    labelled = train.select(F.array_position(F.array(*map(F.lit, DOMAINS)), F.col("domain")).cast("double").alias("place"), F.transform("features", lambda x: x.cast("string")).alias("words"))
    counter = CountVectorizer(inputCol="words", outputCol="vector", minDF=3.0, vocabSize=BUCKETS, binary=True).fit(labelled)
    if not counter.vocabulary:  # too few labels for any word to recur
        return by_share
    regression = LogisticRegression(labelCol="label", featuresCol="vector", family="multinomial", regParam=0.0007, elasticNetParam=0.5, maxIter=60, standardization=False)
    fitted = regression.fit(counter.transform(labelled.withColumn("label", F.col("place") - 1)))
    matrix, weights = fitted.coefficientMatrix.toArray(), np.zeros((len(DOMAINS), BUCKETS))
    weights[: len(matrix), [int(w) for w in counter.vocabulary]] = matrix
    prior = np.full(len(DOMAINS), -20.0)
    prior[: len(matrix)] = np.maximum(fitted.interceptVector.toArray(), -20.0)
    model = Classifier(tuple(prior.tolist()), tuple(map(tuple, weights.tolist())))
    scores = sample.where("held").select("domain", *(s.alias(f"s{k}") for k, s in enumerate(model.scores(F.col("features")))))
    losses = []
    for t in TEMPERATURES:
        p = model.posteriors([F.col(f"s{k}") for k in range(len(DOMAINS))], t)
        right = F.coalesce(*(F.when(F.col("domain") == d, p[k]) for k, d in enumerate(DOMAINS)))
        losses.append(F.sum(-F.ln(F.greatest(right, F.lit(1e-12)))).alias(f"t{t}"))
    held = scores.agg(*losses).first()
    best = min(range(len(TEMPERATURES)), key=lambda i: held[i] if held[i] is not None else math.inf)
    return Classifier(model.prior, model.weights, TEMPERATURES[best])


def classify(docs: DataFrame, model: Classifier, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens`` (words between white space, commas and full stops) and a posterior ``p_<domain>`` for each domain."""
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    rows = rows.withColumn("words", _words(F.col("text")))
    rows = rows.select("doc_id", F.size("words").cast("long").alias("n_tokens"), _features(F.col("text"), F.col("words")).alias("f"))
    scored = rows.select("doc_id", "n_tokens", F.array(*model.scores(F.col("f"))).alias("s"))
    posts = model.posteriors([F.col("s")[k] for k in range(len(DOMAINS))], model.temperature)
    return scored.select("doc_id", "n_tokens", *(F.round(p, 9).alias(f"p_{d}") for p, d in zip(posts, DOMAINS, strict=True)))


def rate(pull: list[float], most: float = math.inf) -> Column:
    """The rate of a row of posteriors: 1 plus the summed steps ``pull``, projected between 0 and ``most``."""
    return F.least(F.greatest(F.lit(0.0), _unprojected(pull)), F.lit(most))


def _unprojected(pull: list[float] | list[Column]) -> Column:
    return sum((F.col(f"p_{d}") * x for d, x in zip(DOMAINS, pull, strict=True)), F.lit(1.0))


#: Lengths of which the best is taken.
LENGTHS = (4.0, 2.0, 1.0, 0.25, 1 / 32, 1 / 1024)
#: Weight of staying near the rates of 1, as a share of all tokens: it picks one of the many solutions. It falls tenfold
#: from the first to the last, or until, below the third, it no longer keeps the totals from their targets.
FIRST_NEAR, LAST_NEAR, PLATEAU = 1e-2, 1e-10, 1e-3


@dataclass(frozen=True)
class Rates:
    """What ``rate`` needs, the expected token totals that it gives, and those that were asked for."""

    pull: tuple[float, ...]
    totals: tuple[float, ...]
    wanted: tuple[float, ...]

    @property
    def residual(self) -> float:
        """The largest difference of a total from its target, as a share of that target."""
        return max((abs(t - w) / w if w else float(t > 0) for t, w in zip(self.totals, self.wanted, strict=True)), default=0.0)


def fit_rates(posts: DataFrame, targets: dict[str, float] = TARGETS, keep: float = 1.0, most: float = math.inf, close: float = 1e-4) -> Rates:
    """Rates from 0 to ``most`` whose expected token totals are ``targets`` (shares), of so many tokens that the first domain keeps ``keep`` of its own.

    Least squares with a pull towards 1 that falls until the targets are met. Where no such rates meet them, it falls
    until the residual no longer does; that leaves nearly the least one, and a warning gives the totals. A domain
    without documents leaves the others as they would be.
    """
    k = len(DOMAINS)
    p = [F.col(f"p_{d}") for d in DOMAINS]

    def sums() -> list[Column]:
        # expected totals, the metric of the rows that move freely, and the integral of the rates
        n, y = F.col("n_tokens"), F.col("y")
        free, held = (y > 0) & (y <= most), F.least(F.greatest(F.lit(0.0), y), F.lit(most))
        own = [F.sum(a * n * held).alias(f"e_{i}") for i, a in enumerate(p)]
        own += [F.sum(F.when(free, p[i] * p[j] * n).otherwise(0.0)).alias(f"g_{i}_{j}") for i in range(k) for j in range(i, k)]
        return [*own, F.sum(n * held * (y - held / 2)).alias("o")]

    def at(pulls: list[np.ndarray]) -> list[tuple[float, np.ndarray, np.ndarray]]:
        # pulls come as rows of data: as literals they would make a plan and code of its own, many times as large, of every pass
        names = [f"x{a}" for a in range(k)]
        steps = posts.sparkSession.createDataFrame([(i, *map(float, x)) for i, x in enumerate(pulls)], ", ".join(["i int", *(f"{n} double" for n in names)]))
        met = posts.select("n_tokens", *p).crossJoin(F.broadcast(steps))  # a row for each pull, no more than LENGTHS
        found = {r["i"]: r for r in met.withColumn("y", _unprojected([F.col(n) for n in names])).groupBy("i").agg(*sums()).collect()}
        nothing = (None, np.array([None] * k), None)
        sides = lambda row: (row["o"], np.array([row[f"e_{a}"] for a in range(k)]), np.array([[row[f"g_{min(a, b)}_{max(a, b)}"] for b in range(k)] for a in range(k)]))
        return [sides(found[i]) if i in found else nothing for i in range(len(pulls))]

    pull = np.zeros(k)
    whole, totals, metric = at([pull])[0]
    if totals[0] is None or not sum(totals) > 0:
        return Rates((0.0,) * k, (0.0,) * k, (0.0,) * k)
    share = np.array([targets[d] for d in DOMAINS], float)
    wanted = share * keep * totals[0] / share[0]
    size, near, left, now = totals.sum(), FIRST_NEAR, math.inf, totals / wanted

    def height(whole: float, pull: np.ndarray) -> float:
        return whole - pull @ wanted + near * size / 2 * pull @ pull

    while (np.abs(totals - wanted) > close * wanted).any() and near > LAST_NEAR:
        best = height(whole, pull)
        while (np.abs(slope := totals - wanted + near * size * pull) > close / 10 * wanted).any():
            step = -np.linalg.pinv(metric + near * size * np.eye(k), rcond=1e-12, hermitian=True) @ slope
            tried = [pull + x * step for x in LENGTHS]
            found = at(tried)
            lowest, i = min((height(got[0], x), i) for i, (got, x) in enumerate(zip(found, tried, strict=True)))
            if not lowest < best - 1e-12 * size:
                break
            best, pull, (whole, totals, metric) = lowest, tried[i], found[i]
        before, left, was, now = left, float(np.linalg.norm(totals - wanted)), now, totals / wanted
        if near < PLATEAU and left > 0.99 * before and np.abs(now - was).max() < 5e-3:
            break
        near /= 10
    rates = Rates(tuple(pull.tolist()), tuple(totals.tolist()), tuple(wanted.tolist()))
    if rates.residual > 10 * close:
        warnings.warn(f"no rates meet the targets: expected totals {rates.totals} for {rates.wanted}", stacklevel=2)
    return rates


def _posteriors(docs: DataFrame, model: Classifier, text_col: str) -> DataFrame:
    """``row`` with all columns of ``docs``, ``n_tokens`` and the posteriors, in the shared folder."""
    return materialize(classify(docs.select(F.struct("*").alias("row"), F.col(text_col).alias("text")), model, "row").withColumnRenamed("doc_id", "row"))


def mix(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", targets: dict[str, float] = TARGETS, keep: float = 1.0) -> DataFrame:
    """One row for each row of ``docs``: ``doc_id, n_tokens, p_clean, p_low, p_toxic, rate``.

    Rates are how often a document shall be drawn; above 1 it repeats. Null and empty texts have no tokens and the
    rate of their posterior. Repeated rows count as often as they come; null ids and empty tables are allowed.
    Without labels there is no opinion, and every rate is 1. Columns of ``docs`` other than the two named are ignored.
    """
    model = fit(docs, labels, id_col, text_col)
    posts = materialize(classify(docs, model, id_col, text_col))
    return posts.withColumn("rate", F.lit(1.0) if model.blind else F.round(rate(fit_rates(posts, targets, keep).pull), 6))


def drawn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", targets: dict[str, float] = TARGETS, keep: float = 1.0, most: float = math.inf, labelled_docs: DataFrame | None = None) -> DataFrame:
    """The rows of ``docs`` as often as they are drawn: the whole part of the rate, and once more by the hash of id and text.

    With ``most`` = 1 no row repeats: the bound is part of the fit, not a cut made afterwards.

    Equal rows are drawn alike, whatever their id, null among them; null and empty texts are drawn at the rate of
    their posterior; columns of any name are kept as they are; an empty table stays empty. The labels may speak of
    ``labelled_docs``, where ``docs`` are what an earlier step has left of these.
    """
    model = fit(docs if labelled_docs is None else labelled_docs, labels, id_col, text_col)
    if model.blind:
        return docs
    posts = _posteriors(docs, model, text_col)
    own = rate(fit_rates(posts, targets, keep, most).pull, most)
    chance = F.pmod(F.xxhash64(F.col("row").getField(id_col).cast("string"), F.col("row").getField(text_col), F.lit("drawn")), F.lit(1 << 30)) / float(1 << 30)
    times = (F.floor(own) + F.when(chance < own - F.floor(own), 1).otherwise(0)).cast("int")
    return posts.select("row", times.alias("times")).where("times > 0").select("row", F.explode(F.expr("sequence(1, times)"))).select("row.*")
