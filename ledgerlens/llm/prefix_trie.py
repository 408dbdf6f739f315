"""Prefix trie of rebuilt conversations, with sums over subtrees by heavy-path decomposition.

A node is a distinct sequence of first turns. It is known by its depth and by 128 bits, the exclusive or of a hash of
each (place, turn), so a prefix's key follows from running aggregates and no conversation is gathered into one row.

Subtree sums take no step for each depth. The child with most members is the heavy one, so a light child has at most
half of its parent's members and a conversation of n crosses at most log2(n) light edges. Each leaf ends one heavy path;
the path's head is the last light node that the leaf's conversation passes. Totals of paths rise from light heads to the
parents of these, a round for each number of light edges, and one suffix sum along all paths then gives every node's sum.

Handling: rows with a null conv_id belong to no conversation; a null role or text is empty; null turns come first; rows
of one conversation with the same turn are ordered by role, then by a hash of the text; equal rows are turns of their
own. Conversations without turns after rebuilding are members of the root alone. An empty table gives no nodes. Other
columns of the input are not read, so their names don't matter. Texts of any length are hashed whole. Long conversations
and paths are cut into chunks of ``CHUNK`` turns whose totals are added, so none needs to fit in one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, text_of, words_of

#: Turns of one conversation, or nodes of one path, that are summed together.
CHUNK = 4096
#: Conversations that share a first conversation, and the most turns they take from it.
GROUP, MOST_SHARED = 20, 3
NODE = ["depth", "x", "y"]
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def _before(df: DataFrame, keys: list[str], by: Column, sums: dict[str, Column]) -> DataFrame:
    """For each group, what the groups of the same keys that come before it hold together."""
    window = Window.partitionBy(*keys).orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumns({name: total.over(window) for name, total in sums.items()})


def placed(conversations: DataFrame) -> DataFrame:
    """Each turn as (c, pos, a, b, words): its place from 0 and a digest of 128 bits of role and text.

    Ranges of (conversation, turn) are sorted apart, so that even one endless conversation is dealt out; what earlier
    ranges hold of a conversation is added to the places of the later one.
    """
    role, text = text_of("role"), text_of("text")
    turns = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("c"), F.col("turn").alias("turn"), role.alias("role"), F.xxhash64(role, text, F.lit(1)).alias("a"),
        F.xxhash64(F.lit(2), text, role).alias("b"), F.size(words_of(text)).cast("long").alias("words"),
    )
    order = ["turn", "role", "a", "b"]
    parts = materialize(turns.repartitionByRange("c", *order).withColumn("part", F.spark_partition_id()))
    counts = parts.groupBy("c", "part").agg(F.count("*").alias("n"))
    before = _before(counts, ["c"], F.col("part"), {"before": F.sum("n")}).where("before > 0").select("c", "part", "before")
    at = F.row_number().over(Window.partitionBy("c", "part").orderBy(*order)) - 1
    out = parts.withColumn("at", at).join(before, ["c", "part"], "left")
    return out.select("c", (F.col("at") + F.coalesce("before", F.lit(0))).cast("long").alias("pos"), "a", "b", "words")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns of the rebuilt conversations, and each conversation with its length.

    Conversation c takes the first h turns of c - c % 20, or as many as that has, then its own turns after its first h.
    """
    convs = turns.groupBy("c").agg(F.count("*").alias("n")).withColumns({"h": F.crc32(F.col("c").cast("string")) % (MOST_SHARED + 1), "first": F.expr(f"c - c % {GROUP}")})
    lengths = convs.select(F.col("c").alias("first"), F.col("n").alias("there"))
    convs = materialize(
        convs.join(lengths, "first", "left").withColumn("got", F.least("h", F.coalesce("there", F.lit(0))))
        .withColumn("length", F.col("got") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).select("c", "first", "h", "got", "length")
    )
    short = convs.where("got < h").select("c", (F.col("h") - F.col("got")).alias("lacking"))
    own = turns.where(F.col("pos") >= F.crc32(F.col("c").cast("string")) % (MOST_SHARED + 1)).join(short, "c", "left")
    own = own.select("c", (F.col("pos") - F.coalesce("lacking", F.lit(0))).alias("pos"), "a", "b", "words")
    shared = turns.where(f"pos < {MOST_SHARED} AND c % {GROUP} = 0").withColumnRenamed("c", "first")
    taken = convs.where("h > 0").join(shared, "first").where("pos < h").select("c", "pos", "a", "b", "words")
    return own.unionByName(taken), convs.select("c", "length")


def prefixes(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """A row for each conversation and depth: (c, depth, x, y) with the parent's key (px, py) and the last turn's words."""
    each = turns.withColumns({"u": F.xxhash64("a", "b", "pos", F.lit(3)), "v": F.xxhash64(F.lit(4), "pos", "b", "a"), "chunk": F.expr(f"pos div {CHUNK}")})
    totals = each.groupBy("c", "chunk").agg(F.expr("bit_xor(u)").alias("u"), F.expr("bit_xor(v)").alias("v"))
    before = _before(totals, ["c"], F.col("chunk"), {"bu": F.expr("bit_xor(u)"), "bv": F.expr("bit_xor(v)")}).where("chunk > 0").select("c", "chunk", "bu", "bv")
    running = Window.partitionBy("c", "chunk").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    here = each.withColumns({"ru": F.expr("bit_xor(u)").over(running), "rv": F.expr("bit_xor(v)").over(running)}).join(before, ["c", "chunk"], "left")
    key = {"x": F.col("ru").bitwiseXOR(F.coalesce("bu", F.lit(0))), "y": F.col("rv").bitwiseXOR(F.coalesce("bv", F.lit(0)))}
    deep = here.withColumns(key).select("c", (F.col("pos") + 1).alias("depth"), "x", "y", F.expr("x ^ u").alias("px"), F.expr("y ^ v").alias("py"), "words")
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    return deep.unionByName(convs.select("c", zero.alias("depth"), zero.alias("x"), zero.alias("y"), none.alias("px"), none.alias("py"), zero.alias("words")))


def _ends(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """SHA-256 over each node's conversations, of rows sorted by node and conversation; one id is held at a time."""
    node, digest = None, None
    for batch in batches:
        keys, ids, done = batch[NODE].to_numpy(), batch["c"].to_numpy(), []
        starts = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(axis=1)])
        for lo, hi in zip(starts, [*starts[1:], len(ids)], strict=True):
            text = ",".join(map(str, ids[lo:hi].tolist())).encode()
            if node is not None and (keys[lo] == node).all():
                digest.update(b"," + text)
                continue
            if node is not None:
                done.append((*node.tolist(), digest.hexdigest()))
            node, digest = keys[lo].copy(), hashlib.sha256(text)
        yield pd.DataFrame(done, columns=[*NODE, "ends_sha256"])
    if node is not None:
        yield pd.DataFrame([(*node.tolist(), digest.hexdigest())], columns=[*NODE, "ends_sha256"])


def ends(rows: DataFrame, convs: DataFrame) -> DataFrame:
    """For each node at which conversations end, the digest of their ids in order."""
    last = rows.select("c", *NODE).join(convs.select("c", F.col("length").alias("depth")), ["c", "depth"]).select(*NODE, "c")
    schema = "depth long, x long, y long, ends_sha256 string"
    return last.repartition(*NODE).sortWithinPartitions(*NODE, "c").mapInPandas(_ends, schema)


def nodes_of(rows: DataFrame) -> DataFrame:
    """Nodes with members, children, parent's conversation, and whether they are their parent's heavy child."""
    bare = materialize(rows.groupBy(*NODE).agg(F.min("c").alias("conv_id"), F.count("*").alias("n_convs"), F.max("px").alias("px"), F.max("py").alias("py"), F.max("words").alias("words")))
    largest = F.max_by(F.struct("x", "y"), F.struct("n_convs", -F.col("conv_id"))).alias("heavy")
    below = bare.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("px").alias("x"), F.col("py").alias("y")).agg(F.count("*").alias("n_children"), largest)
    full = bare.join(below, NODE, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)).cast("long"))
    # a parent may have any number of children: rows of the large side of this join are split when it is skewed
    parent = full.where("n_children > 0").select((F.col("depth") + 1).alias("depth"), F.col("x").alias("px"), F.col("y").alias("py"), F.col("conv_id").alias("parent_conv_id"), F.col("heavy").alias("chosen"))
    light = F.coalesce((F.col("chosen.x") != F.col("x")) | (F.col("chosen.y") != F.col("y")), F.lit(True))
    return full.drop("heavy").join(parent, ["depth", "px", "py"], "left").withColumn("light", light).drop("chosen")


def paths_of(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """The heavy path of each node, named by the conversation that ends it, and the light edges above the path."""
    leaves = nodes.where("n_children = 0").select(F.col("conv_id").alias("c"))
    walks = materialize(rows.select("c", *NODE).join(leaves, "c"))
    heads = walks.where("depth > 0").join(nodes.where("depth > 0 AND light").select(*NODE), NODE).groupBy("c").agg(F.max("depth").alias("head"), F.count("*").alias("level"))
    own = walks.join(heads, "c", "left").where("depth >= coalesce(head, 0)")
    return own.select(*NODE, F.col("c").alias("path"), F.coalesce("level", F.lit(0)).alias("level"), (F.col("depth") == F.coalesce("head", F.lit(0))).alias("is_head"))


def path_totals(nodes: DataFrame, sums: list[str]) -> DataFrame:
    """Sums over each path with all that hangs below it, for paths other than the root's, and the node each hangs from."""
    own = nodes.groupBy("path", "level").agg(*(F.sum(s).alias(s) for s in sums))
    tops = nodes.where("is_head AND depth > 0").select("path", (F.col("depth") - 1).alias("depth"), F.col("px").alias("x"), F.col("py").alias("y"))
    above = tops.join(nodes.select(*NODE, F.col("path").alias("above")), NODE)
    paths = materialize(own.join(above, "path"))
    most = paths.agg(F.max("level")).first()[0] or 0
    done, out = None, []
    for level in range(most, 0, -1):
        now = paths.where(F.col("level") == level)
        if done is not None:
            added = done.groupBy(F.col("above").alias("path")).agg(*(F.sum(s).alias(f"more_{s}") for s in sums))
            now = now.join(added, "path", "left").withColumns({s: F.col(s) + F.coalesce(f"more_{s}", F.lit(0)) for s in sums}).select(*paths.columns)
        done = materialize(now)
        out.append(done)
    total = paths.limit(0)
    for part in out:
        total = total.unionByName(part)
    return total


def subtree_sums(nodes: DataFrame, sums: list[str]) -> DataFrame:
    """``nodes`` with each of ``sums`` taken over the node's subtree."""
    hung = path_totals(nodes, sums).groupBy(*NODE).agg(*(F.sum(s).alias(f"more_{s}") for s in sums))
    here = nodes.join(hung, NODE, "left").withColumns({s: F.col(s) + F.coalesce(f"more_{s}", F.lit(0)) for s in sums} | {"chunk": F.expr(f"depth div {CHUNK}")}).drop(*(f"more_{s}" for s in sums))
    here = materialize(here)
    totals = here.groupBy("path", "chunk").agg(*(F.sum(s).alias(s) for s in sums))
    later = _before(totals, ["path"], F.desc("chunk"), {f"late_{s}": F.sum(s) for s in sums}).where(f"late_{sums[0]} IS NOT NULL").drop(*sums)
    down = Window.partitionBy("path", "chunk").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    run = here.withColumns({s: F.sum(s).over(down) for s in sums}).join(later, ["path", "chunk"], "left")
    return run.withColumns({s: F.col(s) + F.coalesce(f"late_{s}", F.lit(0)) for s in sums}).drop(*(f"late_{s}" for s in sums))


def trie(conversations: DataFrame) -> DataFrame:
    """One row for each node: (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256)."""
    turns, convs = rebuilt(materialize(placed(conversations)))
    rows = materialize(prefixes(turns, convs))
    nodes = materialize(nodes_of(rows))
    own = {"n_leaves": (F.col("n_children") == 0).cast("long"), "saved_tokens": (F.col("n_convs") - 1) * F.col("words")}
    on_paths = materialize(nodes.join(paths_of(rows, nodes), NODE).withColumns(own))
    summed = subtree_sums(on_paths, list(own)).join(ends(rows, convs), NODE, "left")
    return summed.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(EMPTY_SHA)).alias("ends_sha256"))
