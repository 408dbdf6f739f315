"""Features of subgraph members, and labelled pairs made of them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.scalars import cosine, sides
from ..sources.store import written
from . import encoding

#: Members of a pair: the prefix of their columns, and the column with their address.
PLACES = (("X", "x"), ("SubX", "subx"))


def subgraph_logs(sub: DataFrame, logs: DataFrame) -> DataFrame:
    """Priced log entries of each subgraph's edges; ``sub`` has ``center, f, t``."""
    return sub.withColumnRenamed("center", "sg").join(logs.where("usd IS NOT NULL"), ["f", "t"]).select("sg", "f", "t", "tok", "ts", "amt", "usd")


def first_claim(sub: DataFrame) -> DataFrame:
    """Each edge only in the first subgraph that has it, by name."""
    return sub.groupBy("f", "t").agg(F.min("center").alias("center")).select("center", "f", "t")


def token_usd(logs: DataFrame, tokens: DataFrame, side: str) -> DataFrame:
    """``sg, address, token, usd``: mean value by edge and token, then the sum over edges of each listed token.

    ``side`` names the end that has the feature; tokens that are not listed count as ``other_token``.
    """
    means = logs.groupBy("sg", "f", "t", "tok").agg(F.avg("usd").alias("m"))
    named = means.join(tokens.select("tok", F.col("tok").alias("known")), "tok", "left")
    out = named.groupBy("sg", F.col(side).alias("address"), F.coalesce("known", F.lit("other_token")).alias("token"))
    # summed as whole ten-thousandths, so that the order of the rows doesn't show
    return out.agg((F.sum(F.floor(F.col("m") * 10000 + 0.5)).cast("double") / 10000.0).alias("usd"))


def hours(logs: DataFrame, side: str) -> DataFrame:
    """``sg, address, time``: entries in each hour of the day, UTC, as 24 numbers from one pass."""
    hour = F.expr("(ts % 86400) div 3600")
    counts = [F.count_if(hour == h).alias(f"h{h}") for h in range(24)]
    return logs.groupBy("sg", F.col(side).alias("address")).agg(*counts).select("sg", "address", F.array(*(f"h{h}" for h in range(24))).alias("time"))


def add24(a: Column, b: Column) -> Column:
    """Sum of two histograms, element by element; missing elements and histograms count as 0."""
    return F.transform(F.sequence(F.lit(0), F.lit(23)), lambda i: F.coalesce(F.get(a, i), F.lit(0)) + F.coalesce(F.get(b, i), F.lit(0)))


def merge(sent: DataFrame, received: DataFrame) -> DataFrame:
    """Members of either table with both histograms added; ``sg, address, time, in_from, in_to``."""
    a = sent.select("sg", "address", F.col("time").alias("a"))
    b = received.select("sg", "address", F.col("time").alias("b"))
    met = a.join(b, ["sg", "address"], "full_outer")
    return met.select("sg", "address", add24(F.col("a"), F.col("b")).alias("time"), F.col("a").isNotNull().alias("in_from"), F.col("b").isNotNull().alias("in_to"))


def members(logs: DataFrame) -> DataFrame:
    """What ``merge`` gives of the ``hours`` of both sides, in one pass where a subgraph's entries are."""
    sg, hour = F.col("sg"), F.expr("(ts % 86400) div 3600")
    dealt = logs.select("sg", "f", "t", hour.alias("hour")).repartition("sg")
    f, t, h = F.col("f"), F.col("t"), F.col("hour")
    both = sides(dealt, sg=(sg, sg), address=(f, t), hour=(h, h), sends=(F.lit(True), F.lit(False)))
    counts = [F.count_if(F.col("hour") == k).alias(f"h{k}") for k in range(24)]
    found = both.groupBy("sg", "address").agg(*counts, F.bool_or("sends").alias("in_from"), F.bool_or(~F.col("sends")).alias("in_to"))
    return found.select("sg", "address", F.array(*(f"h{k}" for k in range(24))).alias("time"), "in_from", "in_to")


def attach_embeddings(features: DataFrame, embeddings: DataFrame) -> DataFrame:
    """With the member's embedding, or null; an embedding without a subgraph serves every subgraph."""
    general = embeddings.where("sg IS NULL").select("address", F.col("embedding").alias("general"))
    own = embeddings.where("sg IS NOT NULL")
    met = features.join(own, ["sg", "address"], "left").join(general, "address", "left")
    return met.withColumn("embedding", F.coalesce("embedding", "general")).drop("general")


def pairs(features: DataFrame) -> DataFrame:
    """``sg, x, subx``: the centre with each other member; a subgraph without its centre takes its first member."""
    of = W.partitionBy("sg")
    centre = F.coalesce(F.max(F.when(F.col("address") == F.col("sg"), F.col("address"))).over(of), F.min("address").over(of))
    return features.select("sg", "address", centre.alias("x")).where("address <> x").select("sg", "x", F.col("address").alias("subx"))


def label(rows: DataFrame, reuse: DataFrame) -> DataFrame:
    """With ``label``, true where the pair shares a deposit wallet."""
    known = reuse.select(F.col("x_address").alias("x"), F.col("subx_address").alias("subx"), F.lit(True).alias("known")).distinct()
    return rows.join(known, ["x", "subx"], "left").withColumn("label", F.coalesce("known", F.lit(False))).drop("known")


def long_features(rows: DataFrame, tokens: DataFrame, side: str = "From", keep: tuple[str, ...] = ()) -> DataFrame:
    """``sg, x, subx, feature, usd``: token values of both members, with the prefix of their place in the pair and ``side``.

    Tokens that have a column ``side`` of their own go by that, so values of several sides meet the pairs in one join.
    Columns ``keep`` of the pairs come last.
    """
    own = tokens if "side" in tokens.columns else tokens.withColumn("side", F.lit(side))
    place = sides(rows, sg=(F.col("sg"), F.col("sg")), x=(F.col("x"), F.col("x")), subx=(F.col("subx"), F.col("subx")), place=tuple(F.lit(p) for p, _ in PLACES), address=tuple(F.col(c) for _, c in PLACES), **{c: (F.col(c), F.col(c)) for c in keep})
    return place.join(own, ["sg", "address"]).select("sg", "x", "subx", F.concat("place", F.lit("_"), "side", F.lit("_"), "token").alias("feature"), "usd", *keep)


def with_hours(rows: DataFrame, members: DataFrame) -> DataFrame:
    """With the 24 hours of both members of a pair, ``X_Time_<hour>`` and ``SubX_Time_<hour>``."""
    for place, c in PLACES:
        hours = members.select("sg", F.col("address").alias(c), *(F.coalesce(F.get("time", h), F.lit(0)).cast("double").alias(f"{place}_Time_{h}") for h in range(24)))
        rows = rows.join(hours, ["sg", c], "left")
    return rows


def pair_table(
    rows: DataFrame, sent: DataFrame, received: DataFrame, members: DataFrame, embeddings: DataFrame | None = None, most: int = encoding.MOST, name: Callable[[Column], Column] = lambda c: c
) -> DataFrame:
    """Labelled pairs with everything known of both members, as a wide table whose token columns are found in the data.

    ``sent`` and ``received`` are token values by member, ``members`` has the 24 hours. Names begin with the member's
    place: ``X_From_<token>``, ``X_To_<token>``, ``X_Time_<hour>``, ``X_Kind`` (the first letter of the address), and the
    same for ``SubX``; with ``embeddings`` (address, embedding) also ``Similarity``, their cosine. ``name`` gives the
    address of what stands for it in the columns.
    """
    keys = ["sg", "x", "subx"]
    both = sent.withColumn("side", F.lit("From")).unionByName(received.withColumn("side", F.lit("To")))
    long = written(long_features(rows, both))
    wide = with_hours(rows, members)
    for place, c in PLACES:
        wide = wide.withColumn(f"{place}_Kind", F.substring(name(F.col(c)), 1, 1))
        if embeddings is not None:
            wide = wide.join(embeddings.select(F.col("address").alias(c), F.col("embedding").alias(f"_{place}")), c, "left")
    if embeddings is not None:
        wide = wide.withColumn("Similarity", F.coalesce(cosine(*(F.col(f"_{place}") for place, _ in PLACES)), F.lit(0.0))).drop(*(f"_{place}" for place, _ in PLACES))
    return encoding.pivoted(wide.select(*rows.columns, *(c for c in wide.columns if c not in rows.columns)), keys, long, "feature", "usd", most=most)


def numbered(df: DataFrame, *order: Column | str) -> DataFrame:
    """With ``place`` from 0 in the given total order, counted by ranges and never gathered in one task.

    The ranges come from a sample, but a row's place doesn't depend on where they end.
    """
    ranged = df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id())
    cut = written(ranged)
    before = cut.groupBy("_range").count().select("_range", (F.sum("count").over(W.orderBy("_range")) - F.col("count")).alias("_before"))
    within = F.row_number().over(W.partitionBy("_range").orderBy(*order)) - 1
    return cut.withColumn("_within", within).join(F.broadcast(before), "_range").withColumn("place", F.col("_before") + F.col("_within")).drop("_range", "_before", "_within")


def ahead(df: DataFrame, keys: list[str], order: list[str], reach: int, width: int = 8192) -> DataFrame:
    """With ``ahead``: up to ``reach`` rows of the same ``keys`` that follow in a total order, as an array of structs.

    Rows are numbered by keys and order and cut into blocks of ``width``; the first rows of a block come with the
    block before too. So a key that holds most rows is spread over as many tasks as it needs.
    """
    rows = numbered(df, *keys, *order).withColumn("_block", F.floor(F.col("place") / width))
    early = rows.where((F.col("place") % width < reach) & (F.col("_block") > 0)).withColumns({"_block": F.col("_block") - 1, "_own": F.lit(False)})
    both = rows.withColumn("_own", F.lit(True)).unionByName(early)
    w = W.partitionBy("_block").orderBy("place")
    same = lambda x: F.when(F.struct(*(x[k] for k in keys)).eqNullSafe(F.struct(*keys)), x)
    after = F.array_compact(F.array(*(same(F.lead(F.struct(*df.columns), d).over(w)) for d in range(1, reach + 1))))
    return both.withColumn("ahead", after).where("_own").select(*df.columns, "ahead")


#: Ranges of the first bits of a hash, of which counts reach the driver.
RANGES = 4096


def among_first(rows: DataFrame, k: int, text: Column, *order: str) -> Column:
    """Whether a row is one of the first ``k`` by the MD5 of ``text``, then by the columns ``order``, which tell rows apart.

    Rows are counted by ranges of the hash, and the last of the first is looked up in its range, so nothing is shuffled
    but counts. Where rows that are equal in all of it stand on the border, all of them are among the first.
    """
    h = F.md5(text)
    at = F.conv(F.substring(h, 1, 3), 16, 10).cast("int")
    left = k
    for r in sorted(rows.groupBy(at.alias("at")).count().collect()):  # RANGES rows at most
        if left <= 0:
            break
        if left <= r["count"]:
            last = rows.where(at == r["at"]).select(F.unhex(h).alias("h"), *order).orderBy("h", *order).offset(left - 1).limit(1).first()
            return F.struct(F.unhex(h).alias("h"), *order) <= F.struct(F.lit(bytes(last.h)).alias("h"), *(F.lit(last[c]).cast(rows.schema[c].dataType).alias(c) for c in order))
        left -= r["count"]
    return F.lit(k > 0)


def split_by_address(rows: DataFrame, ratio: float, seed: str = "42", name: Callable[[Column], Column] = lambda c: c) -> DataFrame:
    """With ``part``: train for the pairs of the first share of centres in hash order, one at least and not all.

    ``name`` gives the address of what stands for it in ``x``. Pairs without a centre are left out.
    """
    centres = written(rows.select("x").where("x IS NOT NULL").distinct())
    n = centres.count()
    first = among_first(centres, max(1, min(n - 1, int(n * ratio))), F.concat(F.lit(seed), name(F.col("x"))), "x")
    return rows.where("x IS NOT NULL").withColumn("part", F.when(first, "train").otherwise("test"))


def split_balanced(rows: DataFrame, ratio: float, seed: str = "42", name: Callable[[Column], Column] = lambda c: c) -> DataFrame:
    """With ``part``: as many rows of either label train, by hash; all others test.

    Where a label has no rows, or too few for any to train, the first share of all rows in hash order trains. Rows are
    read some times over, ``sg``, ``x`` and ``subx`` tell them apart, and ``name`` gives the address of what stands for it there.
    """
    pos, neg = rows.agg(F.count_if("label"), F.count_if(~F.col("label"))).first()
    share = min(1.0, max(0.0, ratio))
    each, keys = int(min(pos, neg) * share), ["sg", "x", "subx"]
    text = F.concat_ws("|", F.lit(seed), *(name(F.col(c)) for c in keys))
    if each:
        first = F.when(F.col("label"), among_first(rows.where("label"), each, text, *keys)).otherwise(among_first(rows.where("NOT label"), each, text, *keys))
    else:
        first = among_first(rows, int((pos + neg) * share), text, *keys)
    return rows.withColumn("part", F.when(first, "train").otherwise("test"))
