"""Exchange deposit wallets, their users, and pairs of users that share one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .graph import RECEIVES, SENDS_HOT


def excluded(hot: DataFrame, burn: DataFrame) -> DataFrame:
    return hot.select("address").union(burn.select("address")).distinct()


def senders(transfers: DataFrame, receivers: DataFrame) -> DataFrame:
    """``f, t`` of the transfers to any of ``receivers``; none, where there are no receivers."""
    return transfers.select("f", "t").join(receivers.select(F.col("address").alias("t")).distinct(), "t", "left_semi").select("f", "t")


def exchange_deposits(transfers: DataFrame, hot: DataFrame, burn: DataFrame) -> DataFrame:
    """``address, exchange``: who has sent to a hot wallet of which exchange, without hot and burn wallets."""
    sent = transfers.select("f", "t").join(hot.select(F.col("address").alias("t"), "exchange"), "t")
    return sent.select(F.col("f").alias("address"), "exchange").distinct().join(excluded(hot, burn), "address", "left_anti")


def by_address(deposits: DataFrame) -> DataFrame:
    """``address, exchanges``: the sorted set of exchanges that each wallet deposits to."""
    return deposits.select("address", "exchange").distinct().groupBy("address").agg(F.array_sort(F.collect_list("exchange")).alias("exchanges"))


def deposit_users(transfers: DataFrame, deposits: DataFrame, hot: DataFrame, burn: DataFrame) -> DataFrame:
    """``deposit, usr``: who has sent to a deposit wallet; neither end is a hot or burn wallet."""
    out, no = excluded(hot, burn), senders(transfers, deposits).distinct()
    no = no.join(out.select(F.col("address").alias("f")), "f", "left_anti").join(out.select(F.col("address").alias("t")), "t", "left_anti")
    return no.select(F.col("t").alias("deposit"), F.col("f").alias("usr"))


def qualified(vertices: DataFrame, most_sent: int = 3, most_received: int = 20) -> DataFrame:
    """Deposit wallets that send to few exchanges and receive from few users."""
    return vertices.where(F.col("deposit_wallet") & (F.col("number_sent") < most_sent) & (F.col("number_received") < most_received))


def users_by_edges(edges: DataFrame, deposits: DataFrame) -> DataFrame:
    return edges.join(deposits.select(F.col("address").alias("t")), "t", "left_semi").select(F.col("t").alias("deposit"), F.col("f").alias("usr"))


def single_deposit(users: DataFrame) -> DataFrame:
    """Rows of users with one deposit wallet. The users are counted first, so a busy one is never gathered."""
    return users.groupBy("usr").agg(F.count("*").alias("n"), F.first("deposit").alias("deposit")).where("n < 2").select("deposit", "usr")


def without_bots(users: DataFrame, degree: DataFrame, most_sent: int = 100) -> DataFrame:
    sent = degree.select(F.col("address").alias("usr"), "number_sent")
    return users.join(sent, "usr", "left").where(F.coalesce("number_sent", F.lit(0)) < most_sent).select("deposit", "usr")


def sharing_users(dealt: DataFrame, most_sent: int = 3, most_received: int = 20, bot_sent: int = 100) -> DataFrame:
    """``deposit, usr`` of the users of one qualified deposit that are no bots, from ``graph.dealings``.

    As ``qualified``, ``users_by_edges``, ``single_deposit`` and ``without_bots`` give, but all degrees are known where
    the pairs are, so only the users of qualified deposits are shuffled.
    """
    deposit_wallet = F.bool_or(F.col("kind") == SENDS_HOT).over(W.partitionBy("h"))
    few = (F.col("sent") < most_sent) & (F.col("received") < most_received)
    users = dealt.withColumn("wallet", deposit_wallet).where(F.col("wallet") & few & (F.col("kind") == RECEIVES)).select(F.col("h").alias("deposit"), F.col("x").alias("usr"))
    calm = dealt.where(F.col("sent") < bot_sent).select(F.col("h").alias("usr")).distinct()
    return single_deposit(users).join(calm, "usr").select("deposit", "usr")


def reuse_pairs(users: DataFrame) -> DataFrame:
    """Ordered pairs of different users of one deposit wallet; ``qualified`` bounds the users of each."""
    a, b = users.select("deposit", F.col("usr").alias("x_address")), users.select("deposit", F.col("usr").alias("subx_address"))
    return a.join(b, "deposit").where("x_address <> subx_address").select("x_address", "subx_address", F.col("deposit").alias("deposit_address"))
