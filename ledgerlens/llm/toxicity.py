"""Toxicity by a support vector machine on a subsequence string kernel, with Nyström landmarks.

The kernel of two words counts their common subsequences of ``LENGTH`` characters, each weighted by ``DECAY`` to the
number of places it spans in both, and is normalised; a word begins with a mark, so that beginnings count. Characters
that no landmark has are gaps, so an insult with characters put between its letters stays near the insult itself.

Landmarks are words of labelled text. A word is mapped to its kernels with the landmarks, times the inverse root of the
landmarks' own kernel matrix, where a linear machine is fitted. The decision is linear in subsequences, so that machine
and landmarks fold into one weight for each subsequence that some landmark has; scoring a word reads those weights.

A sentence scores as its highest word, and a document as its highest sentence. Labels are of documents: all sentences of
a clean document are clean, and of a toxic one the highest sentence is toxic; fitting and choosing that sentence take
turns. A logistic curve, fitted on documents that the machine has not seen, turns the highest score into a probability.

Rows with crc32(doc_id) mod 5 = 0 give no labels. At most ``MOST_DOCS`` documents a label are used for fitting, first by
hash of their id, and ``MOST_WORDS`` clean words; scoring covers all documents, whole, within the task that reads them.

Handling: null texts are empty; an empty text has the score of a text without any known word. Rows that repeat an id or a
text are scored each alike. A null doc_id is never a label's and not held out. Labels other than 0 and 1 are not read;
where a document's labels disagree it counts as toxic. Without labels of both kinds, or words that tell them apart,
every score is the share of toxic labels (0 without labels). Words beyond ``WINDOW`` characters are scored by windows
that overlap by half. Letters set apart one by one by blanks are one word. Other columns are not read. Empty tables
give no rows.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache, cached_property
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, text_of

LENGTH, DECAY = 3, 0.7
WINDOW = 24
#: Bounds of what is fitted on: labelled documents of each label, clean words, landmarks of either kind.
MOST_DOCS, MOST_WORDS, TOXIC_LANDMARKS, CLEAN_LANDMARKS, LEAST_LANDMARKS = 3000, 12000, 256, 64, 16
#: Weight of a landmark with a letter put into it, as an example, against one document.
CHANGED = 0.5
#: Characters that subsequences tell apart; those of landmarks beyond so many are gaps.
ALPHABET = 95
ROUNDS, COST = 4, 1.0
#: Scores that a worker keeps at most.
CACHED = 300_000
_SPACED = re.compile(r"(?<!\S)\S(?:[^\S\n]\S){2,}(?!\S)")
_EDGE = ".,;:!?\"'()[]{}<>«»„“”…-–*#_~|/\\"


def words_in(text: str) -> set[str]:
    """Distinct lower-cased words without outer punctuation; runs of single characters count as one word too."""
    low = text.lower()
    found = {w.strip(_EDGE) for w in low.split()}
    found.update(re.sub(r"\s", "-", run) for run in _SPACED.findall(low))
    for word in [w for w in found if len(w) > WINDOW]:
        found.remove(word)
        found.update(word[i : i + WINDOW] for i in range(0, len(word) - WINDOW // 2, WINDOW // 2))
    found.discard("")
    return found


@cache
def _places(n: int) -> tuple[np.ndarray, np.ndarray]:
    """All choices of ``LENGTH`` of n places, and the weight of each."""
    at = np.array(list(combinations(range(n), LENGTH)), np.int64).reshape(-1, LENGTH)
    return at.T, (DECAY ** (at[:, -1] - at[:, 0] + 1)).astype(np.float32)


def _norms(classes: np.ndarray) -> np.ndarray:
    """The kernel of each word with itself; class 0 is a gap."""
    n = classes.shape[1]
    gap = np.subtract.outer(np.arange(n), np.arange(n)) - 1
    down = np.where(gap >= 0, DECAY ** np.maximum(gap, 0), 0).astype(np.float32)
    match = ((classes[:, :, None] == classes[:, None, :]) & (classes[:, :, None] > 0)).astype(np.float32) * np.float32(DECAY**2)
    ends = match
    for _ in range(LENGTH - 1):
        ends = match * np.matmul(down, ends @ down.T)
    return ends.sum(axis=(1, 2))


@dataclass
class Strings:
    """Words as rows of character classes, by length; 0 is a gap, 1 the mark at the beginning."""

    alphabet: str

    @cached_property
    def table(self) -> np.ndarray:
        out = np.zeros(0x110000, np.uint8)
        for k, c in enumerate(self.alphabet):
            out[ord(c)] = k + 2
        return out

    @property
    def base(self) -> int:
        return len(self.alphabet) + 2

    def __getstate__(self) -> dict:
        return {"alphabet": self.alphabet}

    def each(self, words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Places in ``words``, classes, codes of all subsequences (0 where one has a gap), and their weights."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        for n in np.unique(lengths):
            at, weights = _places(int(n) + 1)
            if not len(weights):
                continue
            rows = np.flatnonzero(lengths == n)
            for part in np.array_split(rows, -(-len(rows) * len(weights) // 2_000_000)):
                points = np.frombuffer("".join(words[i] for i in part).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(part), n)
                classes = np.c_[np.ones(len(part), np.int64), self.table[points].astype(np.int64)]
                codes = np.zeros((len(part), len(weights)), np.int64)
                gaps = np.zeros(codes.shape, bool)
                for k in at:
                    c = classes[:, k]
                    codes *= self.base
                    codes += c
                    gaps |= c == 0
                codes[gaps] = 0
                yield part, classes, codes, weights


@dataclass
class Machine:
    """A folded machine: a weight for each subsequence, and the constant."""

    strings: Strings
    codes: np.ndarray
    weights: np.ndarray
    constant: float
    _seen: dict = field(default_factory=dict)

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_seen": {}, "_dense": None}

    def decide(self, words: list[str]) -> np.ndarray:
        if self.__dict__.get("_dense") is None:
            self._dense = np.zeros(self.strings.base**LENGTH, np.float32)
            self._dense[self.codes] = self.weights
        out = np.full(len(words), self.constant)
        for part, classes, codes, weights in self.strings.each(words):
            norm = np.sqrt(_norms(classes))
            out[part] += np.divide(self._dense[codes] @ weights, norm, out=np.zeros(len(part), np.float32), where=norm > 0)
        return out

    def best(self, texts: list[str]) -> list[tuple[float, str]]:
        """The highest score of each text and the word that has it; words seen before are looked up."""
        sets, seen = [words_in(t) for t in texts], self._seen
        if len(seen) > CACHED:
            seen.clear()
        new = [w for w in set().union(*sets) if w not in seen] if sets else []
        seen.update(zip(new, self.decide(new).tolist(), strict=True))
        return [max(((seen[w], w) for w in s), default=(self.constant, "")) for s in sets]


def kernels(strings: Strings, words: list[str], known: np.ndarray) -> np.ndarray:
    """Normalised weights of each word for the subsequences ``known`` (sorted codes), a row for each word."""
    out = np.zeros((len(words), len(known)), np.float32)
    for part, classes, codes, weights in strings.each(words):
        at = np.minimum(np.searchsorted(known, codes), max(len(known) - 1, 0))
        row, col = np.nonzero((known[at] == codes) & (codes > 0))
        np.add.at(out, (part[row], at[row, col]), weights[col])
        norm = np.sqrt(_norms(classes))
        out[part] /= np.where(norm > 0, norm, 1)[:, None]
    return out


def fit_machine(landmarks: list[str], words: list[str], toxic: np.ndarray, counts: np.ndarray) -> Machine:
    """Nyström map over the landmarks and a linear machine with squared hinge loss, both classes of the same weight."""
    letters = pd.Series(list("".join(landmarks))).value_counts()
    strings = Strings("".join(sorted(letters.index[:ALPHABET])))
    known = np.unique(np.concatenate([np.unique(codes) for _, _, codes, _ in strings.each(landmarks)] or [np.zeros(0, np.int64)]))
    known = known[known > 0]
    marks = kernels(strings, landmarks, known).astype(np.float64)
    values, vectors = np.linalg.eigh(marks @ marks.T)
    keep = values > 1e-6 * values.max(initial=1e-12)
    root = vectors[:, keep] / np.sqrt(values[keep])
    x = np.concatenate([kernels(strings, words[i : i + 500], known).astype(np.float64) @ marks.T @ root for i in range(0, len(words), 500)])
    x = np.c_[x, np.ones(len(x))]
    y = np.where(toxic, 1.0, -1.0)
    cost = COST * np.where(toxic, counts / counts[toxic].sum(), counts / counts[~toxic].sum()) * len(y) / 2
    # Newton steps on the active set; the constant is hardly held back
    w, ridge = np.zeros(x.shape[1]), np.r_[np.ones(x.shape[1] - 1), 1e-3]
    active = np.ones(len(y), bool)
    for _ in range(30):
        xa = x[active] * cost[active, None]
        w = np.linalg.solve(np.diag(ridge) + xa.T @ x[active], xa.T @ y[active])
        now = y * (x @ w) < 1
        if (now == active).all():
            break
        active = now
    return Machine(strings, known, (marks.T @ (root @ w[:-1])).astype(np.float32), float(w[-1]))


def fit_curve(scores: np.ndarray, toxic: np.ndarray, share: float) -> tuple[float, float]:
    """Slope and constant of the logistic curve, for documents of which ``share`` are toxic."""
    y = toxic.astype(float)
    weight = np.where(toxic, share / max(y.mean(), 1e-9), (1 - share) / max(1 - y.mean(), 1e-9))
    x, w = np.c_[scores, np.ones(len(y))], np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(0.01 * np.eye(2) + (x * (weight * p * (1 - p))[:, None]).T @ x, x.T @ (weight * (y - p)) - 0.01 * w)
        w = w + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return max(float(w[0]), 1e-3), float(w[1])


@dataclass
class Model:
    """A machine with its curve; without one, the share of toxic labels."""

    share: float
    machine: Machine | None = None
    slope: float = 0.0
    constant: float = 0.0

    def probability(self, best: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * best + self.constant, -700, 700)))


def labelled(documents: DataFrame, labels: DataFrame) -> tuple[DataFrame, float]:
    """(doc_id, toxic, text) of the documents that labels are learnt from, bounded for each label, and the toxic share."""
    known = labels.where("toxic IN (0, 1) AND crc32(CAST(doc_id AS STRING)) % 5 != 0").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    share = known.agg(F.avg("toxic")).first()[0] or 0.0
    few = [known.where(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(MOST_DOCS) for y in (0, 1)]
    chosen = F.broadcast(few[0].unionByName(few[1]))  # two bounded samples of ids
    texts = documents.select("doc_id", text_of("text").alias("text")).join(chosen, "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    return materialize(texts), share


def variants(word: str) -> list[str]:
    """The word with a letter of its own put between its letters, at two places."""
    n = len(word)
    return [word[:k] + word[(k * 7 + n) % n] + word[k:] for k in (n // 3, 2 * n // 3) if 0 < k < n] if n > 3 else []


def _word_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for i in range(0, len(batch), 200):
            part = batch.iloc[i : i + 200]
            rows = [(w, y) for t, y in zip(part["text"], part["toxic"], strict=True) for w in words_in(t)]
            yield pd.DataFrame(rows, columns=["word", "toxic"])


def _best_rows(machine: Machine, columns: list[str]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for i in range(0, len(batch), 200):
                part = batch.iloc[i : i + 200]
                best = machine.best(list(part["text"]))
                yield part[columns].assign(best=[b for b, _ in best], word=[w for _, w in best])

    return run


def fit(documents: DataFrame, labels: DataFrame) -> Model:
    """The model of the given labels."""
    sample, share = labelled(documents, labels)
    for_curve = "crc32(concat('curve ', CAST(doc_id AS STRING))) % 5 = 0"
    fitted = sample.where(f"NOT {for_curve}")
    n = {r["toxic"]: r["n"] for r in fitted.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(n) < 2:
        return Model(share)
    seen = fitted.mapInPandas(_word_rows, "word string, toxic int").groupBy("word").agg(F.sum("toxic").alias("t"), F.count_if(F.col("toxic") == 0).alias("c"))
    # log likelihood ratio of a word's documents against toxic ones at their share; that many words reach log(words) by chance
    p, t, c = n[1] / (n[0] + n[1]), F.col("t"), F.col("c")
    ratio = t * F.log(F.greatest(t, F.lit(0.5)) / ((t + c) * p)) + c * F.log(F.greatest(c, F.lit(0.5)) / ((t + c) * (1 - p)))
    seen = materialize(seen.withColumns({"toxic": t > (t + c) * p, "ratio": ratio}))
    ranked = [(r["word"], r["ratio"]) for r in seen.where("toxic").orderBy(F.desc("ratio"), "word").limit(TOXIC_LANDMARKS).collect()]
    enough = math.log(max(seen.count(), 2))
    marks = [w for k, (w, r) in enumerate(ranked) if r > enough or k < LEAST_LANDMARKS]
    clean = [r[0] for r in seen.where("c > 0 AND (NOT toxic OR ratio < 1)").orderBy(F.xxhash64("word"), "word").limit(MOST_WORDS).select("word").collect()]
    common = [r[0] for r in seen.where("c > 0 AND NOT toxic").orderBy(F.desc("c"), "word").limit(CLEAN_LANDMARKS).collect()]
    if not marks or not clean:
        return Model(share)
    examples = [(w, True, 1.0) for w in marks]
    changed = [(v, True, CHANGED) for w in marks for v in variants(w)]
    hard: dict[str, float] = {}
    for turn in range(ROUNDS + 1):
        every = examples + changed + [(w, False, n[0] / len(clean)) for w in clean] + [(w, False, k) for w, k in hard.items()]
        words, toxic, counts = zip(*every, strict=True)
        machine = fit_machine(marks + common, list(words), np.array(toxic), np.array(counts))
        best = sample.withColumn("for_curve", F.expr(for_curve)).mapInPandas(_best_rows(machine, ["doc_id", "toxic", "for_curve"]), "doc_id long, toxic int, for_curve boolean, best double, word string")
        if turn < ROUNDS:
            top = best.where("NOT for_curve AND word <> ''").groupBy("word", "toxic").agg(F.count("*").alias("n")).collect()
            examples = [(r["word"], True, float(r["n"])) for r in top if r["toxic"] == 1] or examples
            hard |= {r["word"]: float(r["n"]) for r in top if r["toxic"] == 0}  # of all turns, so that none comes back
    ends = best.where("for_curve").select("toxic", "best").toPandas()  # of the bounded sample
    if ends["toxic"].nunique() < 2:
        ends = best.select("toxic", "best").toPandas()
    return Model(share, machine, *fit_curve(ends["best"].to_numpy(), ends["toxic"].to_numpy() == 1, min(max(share, 0.001), 0.999)))


def score(documents: DataFrame, labels: DataFrame, model: Model | None = None) -> DataFrame:
    """(doc_id, held_out, score, predicted, worst_word) for every row, with the word that decided."""
    model = model or fit(documents, labels)
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_of("text").alias("text"))
    if model.machine:
        found = rows.mapInPandas(_best_rows(model.machine, ["doc_id"]), "doc_id long, best double, word string")
        z = F.least(F.greatest(F.col("best") * model.slope + model.constant, F.lit(-700.0)), F.lit(700.0))
        found = found.select("doc_id", (1 / (1 + F.exp(-z))).alias("score"), "word")
    else:
        found = rows.select("doc_id", F.lit(float(model.share)).alias("score"), F.lit("").alias("word"))
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False)).alias("held_out")
    return found.select("doc_id", held, "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).cast("int").alias("predicted"), F.col("word").alias("worst_word"))
