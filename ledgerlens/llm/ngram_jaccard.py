"""Exact Jaccard join of word-shingle sets by partitioning the universe of shingles.

Two sets of sizes r <= s that reach the similarity t differ in at most (1 - t) / (1 + t) * (r + s) shingles. Sizes
fall into bands; in each band shingles are hashed into m segments, and k of the segments also tolerate one
difference, with m + k one more than the largest difference. Then some segment agrees: its subset is equal, or, if
it is one of the k, becomes equal when one shingle is left out. Signatures of these subsets and one-deletion
neighbourhoods are what Spark shuffles; k is chosen for each band by its number of documents. Pairs that share a
signature pass a size and a parity-sketch bound, which never reject a link, and are then verified on the sets.

Equal sets are one node, a hash of the set. In each signature's bucket nodes first meet one hub; only nodes that are
still in different components meet each other after that, so a group of copies costs links in proportion to its size.
Where many such nodes share a bucket, as texts of one frame do, they meet only if the sketches agree too: the sketch is
cut into groups of four parts, so many that linked sets differ in at most one part of some group, and nodes are dealt
out by each group without one of its parts, once for all of their buckets. That loses no link. Sets of more than about
300 shingles may differ in too many bits for that; they meet in their bucket, where the agreeing segment already holds
many shingles.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, let, materialize, text_of

SKETCH = 8  # 64-bit words of parity bits
_K = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5)]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str, size: int = 3) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles of a text; of all its words where it has fewer than ``size``."""
    words = text.encode().lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = min(size, len(words))
    out = np.full(len(words) - n + 1, n, np.uint64)
    for k in range(n):
        out = (out + h[k : len(words) - n + 1 + k]) * _K[k % 4]
    return np.unique(_mix(out))


@dataclass(frozen=True)
class Join:
    """The similarity ``num / den`` and what follows from it."""

    num: int = 90
    den: int = 100
    size: int = 3

    def most_apart(self, total: int) -> int:
        """The largest symmetric difference of linked sets whose sizes sum to ``total``."""
        return (self.den - self.num) * total // (self.den + self.num)

    def partner(self, n: int) -> int:
        """The largest size that a set of ``n`` links with."""
        return n * self.den // self.num

    def bands(self, largest: int) -> list[int]:
        """Least sizes of the bands: a set links within its band, the one below and the one above."""
        out = [1]
        while out[-1] <= largest:
            out.append(self.partner(out[-1]) + 1)
        return out


def allocate(join: Join, lows: list[int], counts: dict[int, int]) -> list[tuple[int, int]]:
    """Segments and how many of them tolerate one difference, for each band of which ``lows`` has both ends.

    The cost of a document is its signatures, plus the documents of the band that agree with a segment by chance:
    they do where both segments are nearly empty, with a chance of about exp(-2 * shingles in a segment).
    """
    out = []
    for b in range(len(lows) - 1):
        high = lows[b + 1] - 1
        need = join.most_apart(high + join.partner(high)) + 1
        if need == 1:
            out.append((0, 0))  # equal sets only
            continue

        def cost(k: int, high=high, need=need, n=counts.get(b, 0) + counts.get(b + 1, 0)) -> float:
            m = need - k
            return m + k * high / m + n * m * math.exp(-2 * high / m) * (1 + k / m)

        steps = sorted({round(need / 2 * i / 8) for i in range(9)} | {need // 2})
        k = min((k for k in steps if 2 * k <= need), key=cost)
        out.append((need - k, k))
    return out


def signatures(sets: np.ndarray, band: int, plan: tuple[int, int]) -> np.ndarray:
    m, k = plan
    if not m:
        return np.empty(0, np.uint64)
    seg = (sets % np.uint64(m)).astype(np.int64)
    value = _mix(sets + _K[0])
    own = _mix(np.arange(m, dtype=np.uint64) + np.uint64((band * int(_K[1]) + int(_K[2])) % 2**64))
    np.add.at(own, seg, value)
    if k:
        near = seg < k
        return np.unique(np.concatenate([own, own[seg[near]] - value[near]]))
    return own


def _sketch(sets: np.ndarray) -> list[int]:
    bits = np.bincount((sets >> np.uint64(32)).astype(np.int64) % (64 * SKETCH), minlength=64 * SKETCH) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64).tolist()


def _lists(parts: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, parts)]).astype(np.int32)
    flat = np.concatenate(parts) if parts else np.empty(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.view(np.int64)))


def _described(docs: DataFrame, join: Join, lows: list[int], plans: list[tuple[int, int]]) -> DataFrame:
    """Size, digest, sketch and signatures of each set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, digest, sketch, own, below = [], [], [], [], []
            for text in batch.column("text").to_pylist():
                s = shingles(text, join.size)
                b = int(np.searchsorted(lows, len(s), "right")) - 1
                size.append(len(s))
                digest.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                sketch.append(_sketch(s))
                own.append(signatures(s, b, plans[b]) if b >= 0 else s)
                below.append(signatures(s, b - 1, plans[b - 1]) if b > 0 else s[:0])
            columns = [batch.column("doc_id"), pa.array(size, pa.int32()), pa.array(digest, pa.binary())]
            columns += [pa.array([x[i] for x in sketch], pa.int64()) for i in range(SKETCH)]
            yield pa.RecordBatch.from_arrays([*columns, _lists(own), _lists(below)], names=["doc_id", "n", "digest", *(f"k{i}" for i in range(SKETCH)), "own", "below"])

    fields = ", ".join(f"k{i} long" for i in range(SKETCH))
    return docs.mapInArrow(run, f"doc_id long, n int, digest binary, {fields}, own array<long>, below array<long>")


def _sets(docs: DataFrame, join: Join) -> DataFrame:
    """``node, hashes`` of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [shingles(t, join.size).tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([xxhash.xxh3_128_digest(x) for x in got], pa.binary()), pa.array(got, pa.binary())], names=["digest", "hashes"])

    return docs.mapInArrow(run, "digest binary, hashes binary").select(F.xxhash64("digest").alias("node"), "hashes")


def _verified(pairs: DataFrame, sets: DataFrame, join: Join) -> DataFrame:
    """The pairs ``a, b`` of nodes that link, by their whole sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True):
                p, q = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(p, q, assume_unique=True))
                keep.append(join.den * both >= join.num * (len(p) + len(q) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    x, y = sets.select(F.col("node").alias("a"), F.col("hashes").alias("x")), sets.select(F.col("node").alias("b"), F.col("hashes").alias("y"))
    return pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """``node, label``: the smallest node that the links ``a, b`` lead to. Labels spread and jump, so rounds stay few."""
    both = materialize(links.select("a", "b").union(links.select("b", "a")).distinct())
    labels = materialize(both.groupBy(F.col("a").alias("node")).agg(F.least("a", F.min("b")).alias("label")))
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        spread = materialize(labels.join(near, "node").select("node", F.least("label", "near").alias("label"), F.col("label").alias("old")))
        top = spread.select(F.col("node").alias("label"), F.col("label").alias("top"))
        jumped = materialize(spread.join(top, "label").select("node", F.col("top").alias("label"), (F.col("top") < F.col("old")).alias("moved")))
        labels = jumped.select("node", "label")
        if jumped.where("moved").isEmpty():
            return labels


def _may_link(join: Join, p: str, q: str) -> Column:
    """False only where two sets can't link: by their sizes, or by parities that differ too often."""
    n, m = F.col(f"{p}.n").cast("long"), F.col(f"{q}.n").cast("long")
    apart = sum((F.bit_count(F.col(f"{p}.k{i}").bitwiseXOR(F.col(f"{q}.k{i}"))) for i in range(1, SKETCH)), F.bit_count(F.col(f"{p}.k0").bitwiseXOR(F.col(f"{q}.k0"))))
    return (F.least(n, m) * join.den >= F.greatest(n, m) * join.num) & ((n + m) * (join.den - join.num) >= apart * (join.den + join.num))


#: Nodes of a bucket from which on their sketches decide who meets.
CROWD = 64


def _groups(join: Join, most: Column) -> Column:
    """Groups that the sketch is cut into for pairs whose larger set has ``most`` shingles; 0 where it has too few parts."""
    apart = F.floor(most * (2 * (join.den - join.num)) / (join.den + join.num))
    groups = F.when(apart > 31, 0)  # 2 * groups > apart, so some group has at most one part that differs
    for g in (1, 2, 4, 8):
        groups = groups.when(apart < 2 * g, g)
    return groups.otherwise(16)


def _keys(least: Column, most: Column) -> Column:
    """Keys of a node for each number of groups from ``least`` to ``most`` (no bound where that is 0): each group without one of its four parts.

    One small function of the number and the part: written out, the 124 keys are more code than a method may hold.
    """
    bits = F.concat(*(F.lpad(F.hex(f"k{i}"), 16, "0") for i in range(SKETCH)))

    def of(bits: Column, groups: Column) -> Column:
        size = F.call_function("div", F.lit(4 * SKETCH), groups).cast("int")  # hex digits of a part
        own = lambda i: F.substring(bits, F.call_function("div", i, F.lit(4)).cast("int") * 4 * size + 1, 4 * size)
        return F.transform(F.sequence(F.lit(0), groups * 4 - 1), lambda i: F.xxhash64(groups, i, F.overlay(own(i), F.lit("-"), i % 4 * size + 1, size)))

    fit = F.filter(F.array(*map(F.lit, (1, 2, 4, 8, 16))), lambda k: (least <= k) & ((most >= k) | (most == 0)))
    return let(bits, lambda b: F.flatten(F.transform(fit, lambda k: of(b, k))))


def linked(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", join: Join = Join()) -> DataFrame:
    """One row for each row of ``docs``: ``doc_id, n_shingles, component_id, class_id``.

    ``component_id`` is the smallest id that links lead to, ``class_id`` the smallest with the same set. Texts that
    are null or have no word have no shingles, link with nothing and are their own component and class. Ids are
    integers; rows that repeat an id are one document, and all their sets link it. Null ids link with nothing and
    get nulls. Empty tables give empty results, and other columns are ignored.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    words = F.greatest(F.size(F.split("text", SPACE + "+")), F.lit(1))
    step = math.log(join.den / join.num)
    # one row for each band of text lengths, of which there are few however many texts there are
    sizes = rows.groupBy(F.floor(F.log(words) / step).alias("b")).agg(F.count("*").alias("n"), F.max(words).alias("most")).collect()
    lows = join.bands(max([1, *(r["most"] for r in sizes)]))
    counts: dict[int, int] = {}
    for r in sizes:
        at = int(np.searchsorted(lows, math.exp(r["b"] * step), "right")) - 1
        counts[at] = counts.get(at, 0) + r["n"]
    plans = allocate(join, lows, counts)

    seen = materialize(_described(rows, join, lows, plans).withColumn("node", F.when(F.col("doc_id").isNotNull() & F.col("digest").isNotNull(), F.xxhash64("digest"))))
    marks = [f"k{i}" for i in range(SKETCH)]
    known = seen.where("node IS NOT NULL")
    classes = materialize(known.groupBy("node").agg(F.min("doc_id").alias("doc")))
    # different sets of one id link
    twice = known.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("b")).where("a <> b").select("doc_id", "a")
    again = known.join(twice, "doc_id").select("a", F.col("node").alias("b")).where("a <> b").distinct()

    # signatures whose buckets hold different sets, one of them in the band itself
    each = known.select("node", "n", F.explode("own").alias("sig"), F.lit(True).alias("own")).union(known.select("node", "n", F.explode("below").alias("sig"), F.lit(False).alias("own")))
    shared = (
        each.groupBy("sig")
        .agg(F.min("node").alias("least"), F.max("node").alias("most"), F.min(F.when(F.col("own"), F.col("node").bitwiseXOR(F.col("sig")))).alias("hub"))
        .where("least <> most AND hub IS NOT NULL")
        .select("sig", F.col("hub").bitwiseXOR(F.col("sig")).alias("hub"))
    )
    shared = materialize(shared)
    bucket = materialize(each.join(shared, "sig").groupBy("sig", "node").agg(F.max("own").alias("own"), F.first("n").alias("n"), F.first("hub").alias("hub")))
    marked = materialize(known.select("node", "n", *marks).join(bucket.select("node").distinct(), "node", "left_semi").dropDuplicates(["node"]))

    # every node meets the hubs of its buckets
    hubs = bucket.select(F.col("hub").alias("a"), F.col("node").alias("b")).where("a <> b").distinct()
    star = hubs.join(marked.select(F.col("node").alias("a"), F.struct("n", *marks).alias("p")), "a").join(marked.select(F.col("node").alias("b"), F.struct("n", *marks).alias("q")), "b")
    star = materialize(star.where(_may_link(join, "p", "q")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())

    def apart(labels: DataFrame) -> DataFrame:
        """Pairs that share a bucket, may link and are in different components so far."""
        placed = bucket.select("sig", "node", "own", "n").join(labels, "node", "left").select("sig", "node", "own", "n", F.coalesce("label", "node").alias("label"))
        placed = materialize(placed)
        mixed = materialize(placed.groupBy("sig").agg(F.min("label").alias("l"), F.max("label").alias("h"), F.count("*").alias("nodes")).where("l <> h").select("sig", "nodes"))
        # a pair has the groups of its larger set, which lie between those of a node and those of its largest partner
        own, beyond = _groups(join, F.col("n")), _groups(join, F.floor(F.col("n") * join.den / join.num))
        met = placed.join(mixed, "sig").select("sig", "node", "own", "label", (F.col("nodes") >= CROWD).alias("crowd"), own.alias("g"), beyond.alias("h"))
        few = met.where("NOT crowd OR h = 0").select(F.col("sig").alias("key"), "node", "own", "label").join(marked, "node")
        # in crowds a node has the same keys in all of its buckets; it meets its sketch once, before it comes once for each key
        many = met.where("crowd AND g > 0").select("node", "label", "g", "h").distinct().join(marked, "node")
        many = many.withColumn("keys", _keys(F.col("g"), F.col("h")))
        many = many.select(F.explode("keys").alias("key"), "keys", "node", F.lit(True).alias("own"), "label", "n", *marks)

        def meet(side: DataFrame, once: Column) -> DataFrame:
            side = materialize(side)
            p, q = side.alias("p"), side.where("own").alias("q")
            fits = (F.col("p.key") == F.col("q.key")) & (F.col("p.label") != F.col("q.label")) & _may_link(join, "p", "q") & once
            return p.join(q, fits).select(F.least("p.node", "q.node").alias("a"), F.greatest("p.node", "q.node").alias("b"))

        # a pair counts at the first key that its nodes share
        once = (F.col("p.node") < F.col("q.node")) & (F.get(F.array_intersect("p.keys", "q.keys"), 0) == F.col("p.key"))
        return meet(few, F.lit(True)).union(meet(many, once)).distinct()

    across = materialize(apart(components(star)))
    asked = star.union(across).distinct()
    ids = asked.select(F.col("a").alias("node")).union(asked.select("b")).distinct()
    held = classes.join(ids, "node", "left_semi").select(F.col("doc").alias("doc_id")).distinct()
    sets = materialize(_sets(rows.join(held, "doc_id", "left_semi"), join).join(ids, "node", "left_semi").dropDuplicates(["node"]))
    links = materialize(_verified(asked, sets, join).union(again))
    labels = components(links)
    rest = materialize(apart(labels).join(asked, ["a", "b"], "left_anti"))
    if not rest.isEmpty():
        labels = components(links.union(_verified(rest, sets, join)))
    placed = classes.join(labels, "node", "left").select("node", "doc", F.coalesce("label", "node").alias("label"))
    found = placed.join(placed.groupBy("label").agg(F.min("doc").alias("component")), "label").select("node", "doc", "component")
    out = seen.select("doc_id", "n", "node").join(materialize(found), "node", "left")
    return out.select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"), F.coalesce("doc", "doc_id").alias("class_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", join: Join = Join()) -> DataFrame:
    """The rows of ``docs`` without those that link to a smaller id, and with their own columns, whatever they are called.

    Rows that repeat an id are one document: all of them stay or go. Null ids, and texts that are null or have no
    word, stay. An empty table stays empty.
    """
    spare = linked(docs, id_col, text_col, join).where("component_id <> doc_id").select(F.col("doc_id").alias(id_col))
    return docs.join(spare, id_col, "left_anti")
