"""Exchange deposits, their users and the pairs that share one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..fixtures import Relations
from ..operators import deposits
from .graph import dealings, degree, edges, links, vertices_with_degree
from .registry import query
from .scan import users


@query("SELECT address FROM excl", coded=True)
def excluded_wallets(r: Relations) -> DataFrame:
    return deposits.excluded(r.hot(), r.burn())


@query("SELECT address, exchange FROM dep", coded=True)
def exchange_deposit_wallets(r: Relations) -> DataFrame:
    return deposits.exchange_deposits(links(r), r.hot(), r.burn())


@query("SELECT address, string_agg(exchange, ',' ORDER BY exchange) AS exchanges, count(*) AS n FROM dep GROUP BY address", coded=True)
def exchanges_by_deposit(r: Relations) -> DataFrame:
    """The set of exchanges of each deposit wallet, as one row; there are no more than exchanges."""
    found = deposits.exchange_deposits(links(r.share()), r.hot(), r.burn())
    return deposits.by_address(found).select("address", F.array_join("exchanges", ",").alias("exchanges"), F.size("exchanges").cast("long").alias("n"))


@query("SELECT deposit, count(*) AS num_users, min(usr) AS first_user, max(usr) AS last_user FROM du GROUP BY deposit", coded=True)
def deposit_users(r: Relations) -> DataFrame:
    return users(r.share()).groupBy("deposit").agg(F.count("*").alias("num_users"), F.min("usr").alias("first_user"), F.max("usr").alias("last_user"))


@query("SELECT deposit, count(*) AS num_users, 0 AS updating FROM du GROUP BY deposit", coded=True)
def num_users(r: Relations) -> DataFrame:
    """Counts from the pairs themselves, and the mark of a running update cleared."""
    counts = users(r.share()).groupBy("deposit").agg(F.count("*").alias("num_users"))
    return counts.withColumn("updating", F.lit(0))


@query("SELECT DISTINCT usr FROM du", coded=True)
def flatten_users(r: Relations) -> DataFrame:
    return users(r.share()).select("usr").distinct()


def parts(r: Relations) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Edges, degrees and qualified deposits, from one pass over the transfers."""
    return edges(r.share()), degree(r), deposits.qualified(vertices_with_degree(r))


@query("SELECT address, CAST(number_sent AS BIGINT) AS number_sent, CAST(number_received AS BIGINT) AS number_received FROM vd WHERE deposit_wallet AND number_sent < 3 AND number_received < 20", coded=True)
def qualified_deposits(r: Relations) -> DataFrame:
    return parts(r)[2].select("address", "number_sent", "number_received")


@query("SELECT deposit, usr FROM due", coded=True)
def deposit_user_edges(r: Relations) -> DataFrame:
    e, _, q = parts(r)
    return deposits.users_by_edges(e, q)


@query("SELECT deposit, usr FROM single", coded=True)
def single_deposit_users(r: Relations) -> DataFrame:
    e, _, q = parts(r)
    return deposits.single_deposit(deposits.users_by_edges(e, q))


@query("SELECT deposit, usr FROM nonbot", coded=True)
def non_bot_users(r: Relations) -> DataFrame:
    e, d, q = parts(r)
    return deposits.without_bots(deposits.single_deposit(deposits.users_by_edges(e, q)), d)


def reuse(r: Relations) -> DataFrame:
    return deposits.reuse_pairs(r.kept("sharing_users", lambda: deposits.sharing_users(dealings(r))))


@query("SELECT x_address, subx_address, deposit_address FROM pairs", coded=True)
def deposit_reuse_pairs(r: Relations) -> DataFrame:
    return reuse(r)


@query("SELECT count(DISTINCT deposit) AS deposits, count(DISTINCT usr) AS users, count(*) AS n FROM due", coded=True)
def reuse_stats(r: Relations) -> DataFrame:
    e, _, q = parts(r)
    return deposits.users_by_edges(e, q).agg(F.count_distinct("deposit").alias("deposits"), F.count_distinct("usr").alias("users"), F.count("*").alias("n"))
