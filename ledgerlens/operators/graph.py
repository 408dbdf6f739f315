"""The transfer graph: admission, priced logs, vertices, degrees, pruning, tags, traversal, components.

Edges are kept as flat logs, one row for each (f, t, tok, ts); ``f`` sends to ``t``. All operators take and return
DataFrames, and choose among ties by a total order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.scalars import sides

DAY = 86400
Cut = Callable[[DataFrame], DataFrame]


def admit(transfers: DataFrame, hot: DataFrame, burn: DataFrame) -> DataFrame:
    """Without transfers from hot or burn wallets and to burn wallets; those to hot wallets stay."""
    to = burn.select(F.col("address").alias("t"))
    kept = transfers.join(to, "t", "left_anti").join(to.withColumnRenamed("t", "f"), "f", "left_anti")
    return kept.join(hot.select(F.col("address").alias("f")), "f", "left_anti").select(*transfers.columns)


def price(transfers: DataFrame, prices: DataFrame) -> DataFrame:
    """With ``usd``, the amount at the price of exactly that day; null without one, or where it is 0."""
    day = (F.expr(f"ts div {DAY}") * DAY).alias("day")
    priced = transfers.withColumn("day", day).join(prices, ["tok", "day"], "left")
    return priced.withColumn("usd", F.when(F.col("px") != 0, F.col("amt") * F.col("px"))).drop("px", "day")


def daily_prices(logs: DataFrame) -> DataFrame:
    """The last logged price of each token and day."""
    return logs.groupBy("tok", (F.expr(f"ts div {DAY}") * DAY).alias("day")).agg(F.max_by("px", F.struct("ts", "px")).alias("px"))


def fold_logs(transfers: DataFrame, order: tuple[str, ...]) -> DataFrame:
    """One log entry for each (f, t, tok, ts); of several transfers the last by ``order`` counts, they don't add up."""
    keys, values = ["f", "t", "tok", "ts"], [c for c in ("amt", "usd") if c in transfers.columns]
    dealt = transfers if transfers.isStreaming else transfers.repartition("f", "t")  # sorted once, where they meet
    return dealt.groupBy(*keys).agg(F.max_by(F.struct(*values), F.struct(*order)).alias("v")).select(*keys, *(f"v.{c}" for c in values))


def edges_of(logs: DataFrame) -> DataFrame:
    return logs.groupBy("f", "t").agg(F.min("ts").alias("oldest"), F.max("ts").alias("newest"))


def ends_of(transfers: DataFrame, hot: DataFrame) -> DataFrame:
    """``address, ts, hot, deposit`` of both ends of each transfer: receivers that are hot, and senders to them, which are deposit wallets."""
    flagged = transfers.join(hot.select(F.col("address").alias("t"), F.lit(True).alias("is_hot")).distinct(), "t", "left")
    no, is_hot, ts = F.lit(False), F.coalesce("is_hot", F.lit(False)), F.col("ts")
    return sides(flagged, address=(F.col("f"), F.col("t")), ts=(ts, ts), hot=(no, is_hot), deposit=(is_hot, no))


def vertices_of(transfers: DataFrame, hot: DataFrame) -> DataFrame:
    """Last transfer and tags of each address."""
    ends = ends_of(transfers, hot)
    return ends.groupBy("address").agg(F.max("ts").alias("last_transfer_at"), F.bool_or("hot").alias("hot_wallet"), F.bool_or("deposit").alias("deposit_wallet"))


def degrees(edges: DataFrame) -> DataFrame:
    """Distinct receivers and senders of each address."""
    one, none = F.lit(1), F.lit(0)
    ends = sides(edges, address=(F.col("f"), F.col("t")), s=(one, none), r=(none, one))
    return ends.groupBy("address").agg(F.sum("s").alias("number_sent"), F.sum("r").alias("number_received"))


def vertices_with_degrees(edges: DataFrame, hot: DataFrame) -> DataFrame:
    """Last transfer, tags and degrees of each address, from its edges in one pass."""
    flagged = edges.join(hot.select(F.col("address").alias("t"), F.lit(True).alias("is_hot")).distinct(), "t", "left").withColumn("is_hot", F.coalesce("is_hot", F.lit(False)))
    no, is_hot, ts, one, none = F.lit(False), F.col("is_hot"), F.col("newest"), F.lit(1), F.lit(0)
    ends = sides(flagged, address=(F.col("f"), F.col("t")), ts=(ts, ts), h=(no, is_hot), d=(is_hot, no), s=(one, none), r=(none, one))
    return ends.groupBy("address").agg(
        F.max("ts").alias("last_transfer_at"), F.bool_or("h").alias("hot_wallet"), F.bool_or("d").alias("deposit_wallet"), F.sum("s").alias("number_sent"), F.sum("r").alias("number_received")
    )


def incident(edges: DataFrame) -> DataFrame:
    """Each edge from both of its ends: ``a`` is here, ``o`` the other end."""
    f, t = F.col("f"), F.col("t")
    return sides(edges, a=(f, t), o=(t, f), f=(f, f), t=(t, t))


def edges_to_prune(edges: DataFrame, border: int) -> DataFrame:
    """Edges with entries before ``border``, or of unknown age."""
    return edges.where((F.coalesce("oldest", F.lit(0)) == 0) | (F.col("oldest") < border))


def vertices_to_prune(vertices: DataFrame, border: int) -> DataFrame:
    """Vertices without a transfer since ``border``; an unknown time is before any other."""
    return vertices.where(F.coalesce("last_transfer_at", F.lit(-1)) < border)


def prune_vertices(vertices: DataFrame, logs: DataFrame, border: int) -> tuple[DataFrame, DataFrame]:
    """Without old vertices and all edges at them."""
    old = vertices_to_prune(vertices, border).select("address")
    kept = vertices.join(old, "address", "left_anti")
    edges = logs.join(old.withColumnRenamed("address", "f"), "f", "left_anti").join(old.withColumnRenamed("address", "t"), "t", "left_anti")
    return kept, edges


def prune_logs(logs: DataFrame, border: int) -> DataFrame:
    """Log entries since ``border``; edges without any are gone with them."""
    return logs.where(F.col("ts") >= border)


def to_refresh(vertices: DataFrame, start: int) -> DataFrame:
    """Vertices whose degrees count anew: not hot, bot or contract, and not updated since ``start``."""
    tagged = F.coalesce("hot_wallet", F.lit(False)) | F.coalesce("bot", F.lit(False)) | F.coalesce("contract", F.lit(False))
    return vertices.where(~tagged & (F.col("last_updated_at").isNull() | (F.col("last_updated_at") < start)))


def tag_bots(vertices: DataFrame, contracts: DataFrame, limit: int = 900) -> DataFrame:
    """Senders to more than ``limit`` addresses become contracts or bots, and lose their count."""
    flags = contracts.groupBy("address").agg(F.bool_or("is_contract").alias("is_contract"))
    met = vertices.join(flags, "address", "left").withColumn("busy", F.coalesce(F.col("number_sent") > limit, F.lit(False)))
    is_contract = F.coalesce("is_contract", F.lit(False))
    return met.withColumns(
        {"bot": F.col("busy") & ~is_contract, "contract": F.col("busy") & is_contract, "number_sent": F.when(~F.col("busy"), F.col("number_sent"))}
    ).drop("busy", "is_contract")


def dangling(vertices: DataFrame) -> DataFrame:
    """Vertices that neither sent nor received; an unknown count is not 0."""
    return vertices.where("number_sent = 0 AND number_received = 0")


def prune_graph(vertices: DataFrame, logs: DataFrame, contracts: DataFrame, border: int, limit: int = 900) -> tuple[DataFrame, DataFrame]:
    """The whole prune: old vertices, old entries, fresh degrees, tags, then vertices without edges."""
    kept, left = prune_vertices(vertices, logs, border)
    left = prune_logs(left, border)
    fresh = kept.join(degrees(edges_of(left)), "address", "left").na.fill(0, ["number_sent", "number_received"])
    tagged = tag_bots(fresh, contracts, limit)
    gone = dangling(tagged).select("address")
    return tagged.join(gone, "address", "left_anti"), left


def two_hop(centres: DataFrame, edges: DataFrame, vertices: DataFrame, degree: DataFrame, most: int = 100, bots: DataFrame | None = None) -> DataFrame:
    """``center, f, t``: edges at the centre whose other end is not hot (nor a bot), and edges of those other ends
    that are not too busy. The cap on degree holds before the second join, so a neighbour adds less than 2 * most."""
    centre = centres.select(F.col("center").alias("address"), F.lit(True).alias("centre")).distinct()
    calm = (F.col("number_sent") < most) & (F.col("number_received") < most)
    known = vertices.where("NOT hot_wallet").select("address").distinct().join(degree.groupBy("address").agg(F.bool_or(calm).alias("calm")), "address", "left")
    known = known.select("address", F.coalesce("calm", F.lit(False)).alias("calm"), F.lit(True).alias("plain"))
    tags = known.join(centre, "address", "full_outer").select("address", *(F.coalesce(c, F.lit(False)).alias(c) for c in ("calm", "plain", "centre")))
    if bots is not None:  # they are no first neighbours
        tags = tags.join(bots.select("address", F.lit(True).alias("bot")).distinct(), "address", "left").withColumn("first", F.col("bot").isNull()).drop("bot")
    else:
        tags = tags.withColumn("first", F.lit(True))
    # ends without a tag are hot and no centres: nothing goes on from them or to them
    f, t = F.col("f"), F.col("t")
    around = sides(edges, h=(f, t), x=(t, f), sent=(F.lit(True), F.lit(False)))
    ends = tags.where("plain OR centre").select(F.col("address").alias("x"), F.col("plain").alias("p"), F.col("centre").alias("c"))
    hubs = tags.where("plain AND first").select(F.col("address").alias("h"), "calm")
    met = around.join(ends, "x").select("h", "x", "sent", "p", "c").join(hubs, "h")
    edge = lambda h, x, sent: (F.when(sent, h).otherwise(x).alias("f"), F.when(sent, x).otherwise(h).alias("t"))
    busy = met.where("c AND NOT calm").select(F.col("x").alias("center"), *edge(F.col("h"), F.col("x"), F.col("sent")))
    # both caps bound the members of a list
    near = met.where("calm").groupBy("h").agg(F.collect_list(F.struct("x", "sent", "p", "c")).alias("n")).where(F.exists("n", lambda e: e["c"]))
    near = near.select("h", "n", F.explode(F.array_distinct(F.transform(F.filter("n", lambda e: e["c"]), lambda e: e["x"]))).alias("center"))
    near = near.select("h", "center", F.explode(F.filter("n", lambda e: e["p"] | (e["x"] == F.col("center")))).alias("e"))
    near = near.select("center", *edge(F.col("h"), F.col("e.x"), F.col("e.sent")))
    return busy.union(near).distinct()


#: What an address has to do with another one: it receives from it, sends to it, or sends to it as to a hot wallet, or to
#: a hot wallet that is a burn wallet too, which is no edge.
RECEIVES, SENDS, SENDS_HOT, SENDS_BURNT = 0, 1, 2, 3


def dealings(transfers: DataFrame, hot: DataFrame, burn: DataFrame) -> DataFrame:
    """``h, x, kind, sent, received, deposit``: each pair of an address ``h`` that isn't hot and one it deals with, once.

    ``sent`` and ``received`` are the degrees of ``h``, and ``deposit`` is whether it sends to a hot wallet. Transfers are
    dealt by ``h`` once, and everything that is asked of an address follows where its pairs are. Who reads the pairs
    several times must use a degree or ``deposit`` each time: filters then stay above the exchange, and all read one.
    """
    hot_to = hot.select(F.col("address").alias("t"), F.lit(True).alias("hot")).distinct()
    burn_to = burn.select(F.col("address").alias("t"), F.lit(True).alias("burnt")).distinct()
    out = hot.select(F.col("address").alias("f")).union(burn.select(F.col("address").alias("f"))).distinct()
    met = transfers.select("f", "t").where("f IS NOT NULL AND t IS NOT NULL").join(out, "f", "left_anti").join(hot_to, "t", "left").join(burn_to, "t", "left")
    kind = F.when(F.col("hot").isNull(), SENDS).when(F.col("burnt").isNull(), SENDS_HOT).otherwise(SENDS_BURNT).cast("byte")
    kept = met.where("hot OR burnt IS NULL").select("f", "t", kind.alias("kind"))
    f, t, own = F.col("f"), F.col("t"), F.col("kind")
    both = sides(kept, h=(f, t), x=(t, f), kind=(own, F.when(own == SENDS, F.lit(RECEIVES).cast("byte")))).where("kind IS NOT NULL AND h IS NOT NULL")
    once, at = both.repartition("h").distinct(), W.partitionBy("h")
    sent, received, deposit = F.count_if(own.isin(SENDS, SENDS_HOT)).over(at), F.count_if(own == RECEIVES).over(at), F.max(own).over(at) >= SENDS_HOT
    return once.select("h", "x", "kind", sent.alias("sent"), received.alias("received"), deposit.alias("deposit"))


def reached(dealt: DataFrame, most: int = 100) -> DataFrame:
    """``center, f, t`` of ``two_hop`` around each sender to a deposit wallet, from ``dealings``; some come more than once.

    A centre tells its neighbours of itself, and they answer with their own edges unless they are busy, so only centres
    and what they reach are shuffled.
    """
    users = dealt.where((F.col("kind") == RECEIVES) & F.col("deposit")).select(F.col("x").alias("h")).distinct()
    plain = dealt.where(F.col("kind").isin(RECEIVES, SENDS) & (F.col("sent") + F.col("received") > 0))
    sends = F.col("kind") == SENDS
    edge = lambda h, x: (F.when(sends, h).otherwise(x).alias("f"), F.when(sends, x).otherwise(h).alias("t"))
    first = plain.join(users, "h")
    told = first.select(F.col("x").alias("h"), F.col("h").alias("center")).repartition("h").distinct()
    calm = plain.where((F.col("sent") < most) & (F.col("received") < most))
    second = calm.join(told, "h").where("x <> center")
    return first.select(F.col("h").alias("center"), *edge(F.col("h"), F.col("x"))).union(second.select("center", *edge(F.col("h"), F.col("x"))))


def preprocess(sub: DataFrame, most: int = 200) -> DataFrame:
    """``center, x_address, num_address, members, num_edges`` of the subgraphs of up to ``most`` members.

    Edges without an end don't count. ``x_address`` is the centre's own address: the column of that name where the
    subgraphs have one and it isn't null, else the centre.
    """
    own = F.coalesce("x_address", "center") if "x_address" in sub.columns else F.col("center")
    edges = sub.where("f IS NOT NULL AND t IS NOT NULL").withColumn("x_address", own)
    ends = edges.select("center", F.explode(F.array("f", "t")).alias("a")).distinct()
    small = ends.groupBy("center").agg(F.count("*").alias("num_address")).where(F.col("num_address") <= most)
    members = ends.join(small, "center").groupBy("center", "num_address").agg(F.array_sort(F.collect_list("a")).alias("members"))
    sizes = edges.groupBy("center").agg(F.count("*").alias("num_edges"), F.min("x_address").alias("x_address"))
    return members.join(sizes, "center").select("center", "x_address", "num_address", "members", "num_edges")


def components(edges: DataFrame, cut: Cut, key: list[str] | None = None) -> DataFrame:
    """``address, component`` (with the columns ``key`` before): the smallest address that edges lead to.

    In each round every address joins the one of its neighbours and itself that comes first by a hash, and edges go on
    between those joined, each once; so what a round reads shrinks by a share, whatever the order of the addresses.
    ``cut`` ends the lineage of each round.
    """
    key = key or []
    left, joined, turn = cut(edges.where("f IS NOT NULL AND t IS NOT NULL").select(*key, F.col("f").alias("a"), F.col("t").alias("o")).distinct()), [], 0
    while not joined or not left.isEmpty():
        a, o = F.col("a"), F.col("o")
        ends = sides(left, **{k: (F.col(k), F.col(k)) for k in key}, address=(a, o), via=(o, a))
        rank = lambda c, turn=turn: F.xxhash64(F.lit(turn), c)
        first = ends.groupBy(*key, "address").agg(F.min_by("via", rank("via")).alias("via"))
        first = cut(first.select(*key, "address", F.when(rank("via") < rank("address"), F.col("via")).otherwise(F.col("address")).alias("via")))
        joined.append(first)
        for end in ("a", "o"):
            left = left.join(first.select(*key, F.col("address").alias(end), F.col("via").alias(f"{end}_via")), [*key, end]).drop(end)
        left = cut(left.where("a_via <> o_via").select(*key, F.least("a_via", "o_via").alias("a"), F.greatest("a_via", "o_via").alias("o")).distinct())
        turn += 1
    labels = joined.pop()
    while joined:
        later = labels.select(*key, F.col("address").alias("via"), F.col("via").alias("root"))
        labels = cut(joined.pop().join(later, [*key, "via"], "left").select(*key, "address", F.coalesce("root", "via").alias("via")))
    least = labels.groupBy(*key, "via").agg(F.min("address").alias("component"))
    return labels.join(least, [*key, "via"]).select(*key, "address", "component")
