"""Hard-negative mining by a two-dimensional block matrix multiply.

Rows are dealt into blocks and vectors into chunks of dimensions. For each pair of an anchor block and a row block every
chunk gives a tile of partial int64 scores; the partial tiles are shuffled to their pair and added there, and only the
best of each tile leave it. A first multiply, over blocks of one label, gives the positives; a second, over blocks of
all labels, gives the negatives within each positive's window. No score matrix is stored.

Work is anchors times rows, in blocks of bounded size: a label with a third of all rows has more blocks, not larger
ones. The anchors are a stated query set (ids divisible by ``ANCHOR_EVERY``) that meets all rows.

Handling: rows with a null label, a null vector or a null or non-finite component take no part. A shorter vector counts
as if it went on with zeros. Components beyond the range of long are cut to it, and products wrap as long arithmetic
does. Equal rows are rows of their own, as anchors, positives and negatives. A null vec_id is no anchor and comes last
among ties (2^63-1 stands for it inside, so that id is returned as null). An anchor without positives, or a positive
without negatives, gives no row. Other columns are not read. Empty tables give no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

ANCHOR_EVERY, RELABEL_EVERY, LABELS = 100, 7, 10
POSITIVES, NEGATIVES = 5, 10
#: Bounds of a negative's score, in hundredths of the positive's.
LOW, HIGH = 30, 90
#: Rows and anchors of a block; a chunk has so many dimensions at least, and a vector so many chunks at most.
ROWS, ANCHORS, DIMS, CHUNKS = 2048, 256, 32, 8

NO_ID = np.iinfo(np.int64).max
KEYS = "part int, a int, b int, chunk int, "
#: What chunk 0 tells of its block: row numbers, ids and labels, and the positives wanted of each anchor.
BLOCK = "n array<long>, ids array<long>, labels array<int>, at array<int>, place array<int>, positive_id array<long>, positive_score array<long>"
BLOCK_COLUMNS = ["n", "ids", "labels", "at", "place", "positive_id", "positive_score"]


def usable(embeddings: DataFrame) -> DataFrame:
    """(n, vec_id, label, v): numbered rows that take part, labels changed where the rule says, components made whole.

    The table is written, so that numbers stay the same when a task runs again.
    """
    wrong = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    label = F.when(F.col("vec_id") % RELABEL_EVERY == 0, (F.col("label") + 1) % LABELS).otherwise(F.col("label"))
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * 256))
    rows = embeddings.where(F.col("label").isNotNull() & F.col("embedding").isNotNull() & ~wrong)
    return materialize(rows.select(F.monotonically_increasing_id().alias("n"), F.col("vec_id").cast("long").alias("vec_id"), label.cast("int").alias("label"), whole.alias("v")))


def _pack(rows: pd.DataFrame, width: int, chunks: int, on_side: str) -> pd.DataFrame:
    """A block as one matrix for each chunk of dimensions, its rows in order of id."""
    ids = rows["vec_id"].astype("Int64").fillna(NO_ID).astype("int64").to_numpy()
    order = np.argsort(ids, kind="stable")
    cells = np.zeros((len(rows), width * chunks), np.int64)
    for place, k in enumerate(order):
        v = rows["v"].iat[k]
        cells[place, : len(v)] = v
    first = {"n": rows["n"].to_numpy()[order], "ids": ids[order], "labels": rows["label"].to_numpy()[order]}
    if "positives" in rows:
        wanted = [(place, k, *pair) for place, i in enumerate(order) for k, pair in enumerate(zip(rows["positives"].iat[i], rows["scores"].iat[i], strict=True))]
        first |= dict(zip(("at", "place", "positive_id", "positive_score"), map(list, zip(*wanted, strict=True)), strict=True))
    out = [dict.fromkeys(BLOCK_COLUMNS) | {"part": int(rows["part"].iat[0]), on_side: int(rows["block"].iat[0]), "others": int(rows["others"].iat[0]), "chunk": c, "cells": cells[:, c * width : (c + 1) * width].tobytes()} for c in range(chunks)]
    out[0] |= first
    return pd.DataFrame(out, columns=["part", on_side, "others", "chunk", "cells", *BLOCK_COLUMNS])


def blocks(rows: DataFrame, side: str, width: int, chunks: int) -> DataFrame:
    """Packs rows that know their part, the number of blocks of it (``own``) and of the other side's (``others``).

    Each chunk is copied to the pairs of blocks it has a share in, as in a multiply over a grid of tasks.
    """
    other = "b" if side == "a" else "a"
    dealt = rows.where("own > 0 AND others > 0").withColumn("block", F.expr("pmod(xxhash64(n), own)").cast("int"))
    pack = lambda group: _pack(group, width, chunks, side)
    packed = dealt.groupBy("part", "block").applyInPandas(pack, f"part int, {side} int, others int, chunk int, cells binary, {BLOCK}")
    return packed.withColumn(other, F.explode(F.expr("sequence(0, others - 1)"))).drop("others")


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact int64 ``a @ b.T``; by way of float64 where no sum can leave the whole numbers that it holds."""
    most = max(int(a.max(initial=0)), -int(a.min(initial=0))) * max(int(b.max(initial=0)), -int(b.min(initial=0))) * a.shape[1]
    if most < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    with np.errstate(over="ignore"):
        return a @ b.T


TILE = KEYS + "tile binary, " + ", ".join(f"{side}_{c}" for side in "ab" for c in BLOCK.split(", "))


def tiles(anchors: DataFrame, rows: DataFrame, width: int) -> DataFrame:
    """The tile that each chunk of dimensions adds to each pair of blocks; chunk 0 also says what the blocks hold."""
    keys = ["part", "a", "b", "chunk"]
    names = [x.split(" ")[0] for x in TILE.split(", ")]

    def multiply(key: tuple, a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if a.empty or b.empty:
            return pd.DataFrame(columns=names)
        x, y = (np.frombuffer(side["cells"].iat[0], np.int64).reshape(-1, width) for side in (a, b))
        about = [frame[c].iat[0] for frame in (a, b) for c in BLOCK_COLUMNS]
        return pd.DataFrame([[*key, product(x, y).tobytes(), *about]], columns=names)

    return anchors.groupBy(*keys).cogroup(rows.groupBy(*keys)).applyInPandas(multiply, TILE)


def _summed(group: pd.DataFrame) -> tuple[np.ndarray, pd.Series]:
    """The scores of a pair of blocks, and what chunk 0 says of both."""
    first = group[group["chunk"] == 0].iloc[0]
    total = np.zeros((len(first["a_ids"]), len(first["b_ids"])), np.int64)
    for tile in group["tile"]:
        total += np.frombuffer(tile, np.int64).reshape(total.shape)
    return total, first


def _best(scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest scores, the earlier of equal ones first."""
    if len(scores) > 4 * k:
        at = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
        return at[np.argsort(-scores[at], kind="stable")[:k]]
    return np.argsort(-scores, kind="stable")[:k]


def _positives(group: pd.DataFrame) -> pd.DataFrame:
    total, first = _summed(group)
    out = []
    for at, n in enumerate(first["a_n"]):
        others = np.flatnonzero(first["b_n"] != n)
        out += [(n, first["b_ids"][k], total[at, k]) for k in others[_best(total[at, others], POSITIVES)]]
    return pd.DataFrame(out, columns=["n", "positive_id", "score"])


def _negatives(group: pd.DataFrame) -> pd.DataFrame:
    total, first = _summed(group)
    out = []
    for at, place, positive, score in zip(first["a_at"], first["a_place"], first["a_positive_id"], first["a_positive_score"], strict=True):
        row, low, high = total[at], -(-LOW * int(score) // 100), HIGH * int(score) // 100
        fit = np.flatnonzero((row >= low) & (row <= high) & (first["b_labels"] != first["a_labels"][at]))
        out += [(first["a_n"][at], place, first["a_ids"][at], positive, score, first["b_ids"][k], row[k]) for k in fit[_best(row[fit], NEGATIVES)]]
    return pd.DataFrame(out, columns=["n", "place", "anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"])


def _first(df: DataFrame, keys: list[str], score: str, tie: str, k: int, rank: str) -> DataFrame:
    """The first k rows of each key; tasks keep their own first k before the shuffle."""
    order = Window.partitionBy(*keys).orderBy(F.desc(score), tie)
    return df.withColumn(rank, F.row_number().over(order)).where(F.col(rank) <= k)


def positives_of(rows: DataFrame, width: int, chunks: int) -> DataFrame:
    """(n, place, positive_id, score): the first rows of each anchor's label, ``n`` being the anchor's row."""
    sizes = rows.groupBy("label").agg(
        F.ceil(F.count("*") / ROWS).cast("int").alias("row_blocks"), F.ceil(F.count_if(F.col("vec_id") % ANCHOR_EVERY == 0) / ANCHORS).cast("int").alias("anchor_blocks")
    )
    known = rows.join(sizes, "label").withColumn("part", F.col("label"))
    a = known.where(F.col("vec_id") % ANCHOR_EVERY == 0).withColumnsRenamed({"anchor_blocks": "own", "row_blocks": "others"})
    b = known.withColumnsRenamed({"row_blocks": "own", "anchor_blocks": "others"})
    parts = tiles(blocks(a, "a", width, chunks), blocks(b, "b", width, chunks), width)
    found = parts.groupBy("part", "a", "b").applyInPandas(_positives, "n long, positive_id long, score long")
    return _first(found, ["n"], "score", "positive_id", POSITIVES, "place")


def mine(embeddings: DataFrame) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)."""
    rows = usable(embeddings)
    dims, count = rows.agg(F.max(F.size("v")), F.count("*")).first()
    width = max(DIMS, -(-(dims or 0) // CHUNKS))
    chunks = max(1, -(-(dims or 0) // width))
    chosen = positives_of(rows, width, chunks).groupBy("n").agg(F.array_sort(F.collect_list(F.struct("place", "positive_id", "score"))).alias("p"))
    anchors = materialize(rows.join(chosen, "n").select("n", "vec_id", "label", "v", F.col("p.positive_id").alias("positives"), F.col("p.score").alias("scores")))
    own, others = -(-anchors.count() // ANCHORS), -(-count // ROWS)
    a = anchors.withColumns({"part": F.lit(0), "own": F.lit(own), "others": F.lit(others)})
    b = rows.withColumns({"part": F.lit(0), "own": F.lit(others), "others": F.lit(own)})
    parts = tiles(blocks(a, "a", width, chunks), blocks(b, "b", width, chunks), width)
    found = parts.groupBy("part", "a", "b").applyInPandas(_negatives, "n long, place int, anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long")
    best = _first(found, ["n", "place"], "negative_score", "negative_id", NEGATIVES, "rank")
    known = lambda c: F.when(F.col(c) != NO_ID, F.col(c)).alias(c)
    return best.select("anchor_id", known("positive_id"), "rank", known("negative_id"), "positive_score", "negative_score")
