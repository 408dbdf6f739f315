"""The transfer graph: building, pruning, traversal."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..codes import address
from ..fixtures import BORDER, BOT_SENT, LAST, Relations
from ..operators import deposits, graph
from ..sources.store import written
from .registry import query


def admitted(r: Relations) -> DataFrame:
    make = lambda: graph.admit(r.transfers(), r.hot(), r.burn())
    return make() if r.coded else r.kept("admitted", make)


def links(r: Relations) -> DataFrame:
    """All pairs of a sender and a receiver with the times of their first and last transfer."""
    return r.kept("links", lambda: graph.edges_of(r.transfers()))


def logs(r: Relations) -> DataFrame:
    """Priced once they are folded, as entries of one key have one price."""
    return graph.price(graph.fold_logs(admitted(r), LAST), r.prices()).select("f", "t", "tok", "ts", "amt", "usd")


def log_keys(r: Relations) -> DataFrame:
    """What tells log entries apart; it needs neither prices nor the last of the transfers."""
    return admitted(r).select("f", "t", "tok", "ts").distinct()


def edges(r: Relations) -> DataFrame:
    """The edges alone need neither prices nor the fold, and are admitted as their transfers are."""
    return r.kept("edges", lambda: graph.admit(links(r), r.hot(), r.burn()))


def newest(r: Relations) -> DataFrame:
    """The last entry alone of each edge: where it is gone by age, all are."""
    return edges(r).select("f", "t", F.col("newest").alias("ts"))


def vertices(r: Relations) -> DataFrame:
    return vertices_with_degree(r).select("address", "last_transfer_at", "hot_wallet", "deposit_wallet")


def degree(r: Relations) -> DataFrame:
    return vertices_with_degree(r).select("address", "number_sent", "number_received")


def vertices_with_degree(r: Relations) -> DataFrame:
    return r.kept("vertices", lambda: graph.vertices_with_degrees(edges(r), r.hot()))


def dealings(r: Relations) -> DataFrame:
    return graph.dealings(r.transfers(), r.hot(), r.burn())


def reached(r: Relations) -> DataFrame:
    """The subgraphs as they are found, where edges may repeat."""
    return graph.reached(dealings(r))


def subgraphs(r: Relations) -> DataFrame:
    """Around each user of an exchange deposit, dealt by edges as the log is."""
    return r.kept("subgraphs", lambda: reached(r).repartition("f", "t").distinct())


def by_centre(r: Relations) -> DataFrame:
    """The same, dealt by their centres."""
    return reached(r).repartition("center").distinct()


def subgraphs_without(r: Relations, bots: DataFrame) -> DataFrame:
    """Around each user of an exchange deposit, without the neighbours that are ``bots``."""
    t = links(r.share())
    found = deposits.exchange_deposits(t, r.hot(), r.burn()).select("address").distinct()
    centres = deposits.deposit_users(t, found, r.hot(), r.burn()).select(F.col("usr").alias("center")).distinct()
    return graph.two_hop(centres, edges(r), vertices(r), degree(r), bots=bots)


@query("SELECT leg, f, t, tok, ts, amt FROM adm", coded=True)
def graph_admission(r: Relations) -> DataFrame:
    return admitted(r).select("leg", "f", "t", "tok", "ts", "amt")


@query("SELECT f, t, tok, ts, amt, usd FROM priced", coded=True)
def priced_transfers(r: Relations) -> DataFrame:
    return graph.price(admitted(r), r.prices()).select("f", "t", "tok", "ts", "amt", "usd")


@query("SELECT tok, day, px FROM (SELECT tok, ts // 86400 * 86400 AS day, px, row_number() OVER (PARTITION BY tok, ts // 86400 ORDER BY ts DESC, px DESC) AS k FROM plog) WHERE k = 1")
def price_daily(r: Relations) -> DataFrame:
    return graph.daily_prices(r.price_logs())


@query("SELECT f, t, tok, ts, amt, usd FROM logs", coded=True)
def edge_logs(r: Relations) -> DataFrame:
    return logs(r)


@query("SELECT address, last_transfer_at, hot_wallet, deposit_wallet FROM vert", coded=True)
def build_vertices(r: Relations) -> DataFrame:
    return vertices(r)


@query("SELECT address, CAST(number_sent AS BIGINT) AS number_sent, CAST(number_received AS BIGINT) AS number_received FROM deg", coded=True)
def degrees(r: Relations) -> DataFrame:
    return degree(r)


@query("SELECT a, o, f, t FROM inc", coded=True)
def neighbours(r: Relations) -> DataFrame:
    return graph.incident(edges(r))


@query(f"SELECT f, t, oldest FROM edges WHERE coalesce(oldest, 0) = 0 OR oldest < {BORDER}", coded=True)
def edges_to_prune(r: Relations) -> DataFrame:
    return graph.edges_to_prune(edges(r), BORDER).select("f", "t", "oldest")


@query(f"SELECT address, last_transfer_at FROM vert WHERE coalesce(last_transfer_at, -1) < {BORDER}", coded=True)
def vertices_to_prune(r: Relations) -> DataFrame:
    return graph.vertices_to_prune(vertices(r), BORDER).select("address", "last_transfer_at")


@query(f"SELECT (SELECT count(*) FROM vert WHERE last_transfer_at < {BORDER}) AS vertices, (SELECT count(*) FROM edges WHERE oldest < {BORDER}) AS edges", coded=True)
def prune_counts(r: Relations) -> DataFrame:
    r.share("edges")
    v = graph.vertices_to_prune(vertices(r), BORDER).select(F.lit("v").alias("kind"))
    e = graph.edges_to_prune(edges(r), BORDER).select(F.lit("e").alias("kind"))
    return v.union(e).agg(F.count_if(F.col("kind") == "v").alias("vertices"), F.count_if(F.col("kind") == "e").alias("edges"))


@query(f"SELECT l.f, l.t, l.tok, l.ts FROM logs l WHERE l.f IN (SELECT address FROM vert WHERE last_transfer_at >= {BORDER}) AND l.t IN (SELECT address FROM vert WHERE last_transfer_at >= {BORDER})", coded=True)
def prune_vertices(r: Relations) -> DataFrame:
    r.share("vertices")
    # pruned before they are told apart, as all entries of an edge stay or go together
    return graph.prune_vertices(vertices(r), admitted(r).select("f", "t", "tok", "ts"), BORDER)[1].distinct()


@query(f"SELECT f, t, count(*) AS n, min(ts) AS oldest FROM logs WHERE ts >= {BORDER} GROUP BY f, t", coded=True)
def prune_edge_logs(r: Relations) -> DataFrame:
    return graph.prune_logs(log_keys(r), BORDER).groupBy("f", "t").agg(F.count("*").alias("n"), F.min("ts").alias("oldest"))


_MARKED = f"""SELECT v.address, hot_wallet, number_sent > {BOT_SENT} AND NOT coalesce(is_contract, false) AS bot,
  number_sent > {BOT_SENT} AND coalesce(is_contract, false) AS contract,
  CASE WHEN number_sent > {BOT_SENT} THEN NULL ELSE CAST(number_sent AS BIGINT) END AS number_sent, CAST(number_received AS BIGINT) AS number_received
  FROM vd v LEFT JOIN contracts c ON v.address = c.address"""


@query(_MARKED, coded=True)
def tag_bots(r: Relations) -> DataFrame:
    return graph.tag_bots(vertices_with_degree(r), r.contracts(), BOT_SENT).select("address", "hot_wallet", "bot", "contract", "number_sent", "number_received")


@query(f"SELECT address FROM ({_MARKED}) x JOIN vert v USING (address) WHERE NOT (x.hot_wallet OR bot OR contract) AND last_transfer_at < {BORDER}", coded=True)
def vertices_to_refresh(r: Relations) -> DataFrame:
    tagged = graph.tag_bots(vertices_with_degree(r), r.contracts(), BOT_SENT).withColumn("last_updated_at", F.col("last_transfer_at"))
    return graph.to_refresh(tagged, BORDER).select("address")


@query(f"""SELECT address FROM vert WHERE address NOT IN (SELECT f FROM logs WHERE ts >= {BORDER} UNION SELECT t FROM logs WHERE ts >= {BORDER})""", coded=True)
def dangling_vertices(r: Relations) -> DataFrame:
    r.share("edges")
    left = graph.degrees(graph.edges_of(graph.prune_logs(newest(r), BORDER)))
    fresh = vertices(r).join(left, "address", "left").na.fill(0, ["number_sent", "number_received"])
    return graph.dangling(fresh).select("address")


@query(f"""WITH young AS (SELECT address, hot_wallet FROM vert WHERE last_transfer_at >= {BORDER}),
left_logs AS (SELECT * FROM logs WHERE ts >= {BORDER} AND f IN (SELECT address FROM young) AND t IN (SELECT address FROM young)),
left_edges AS (SELECT DISTINCT f, t FROM left_logs),
n AS (SELECT address, sum(s) AS s, sum(r) AS r FROM (SELECT f AS address, 1 AS s, 0 AS r FROM left_edges UNION ALL SELECT t, 0, 1 FROM left_edges) GROUP BY address)
SELECT y.address, s > {BOT_SENT} AND NOT coalesce(is_contract, false) AS bot, s > {BOT_SENT} AND coalesce(is_contract, false) AS contract,
  CASE WHEN s > {BOT_SENT} THEN NULL ELSE CAST(s AS BIGINT) END AS number_sent, CAST(r AS BIGINT) AS number_received
FROM young y JOIN n USING (address) LEFT JOIN contracts c ON y.address = c.address""", coded=True)
def prune_graph(r: Relations) -> DataFrame:
    r.share("edges", "vertices")
    kept, _ = graph.prune_graph(vertices(r), newest(r), r.contracts(), BORDER, BOT_SENT)
    return kept.select("address", "bot", "contract", "number_sent", "number_received")


@query("SELECT center, f, t FROM sub", coded=True)
def two_hop_subgraph(r: Relations) -> DataFrame:
    return subgraphs(r)


@query(f"""WITH bots AS (SELECT address FROM vd JOIN contracts USING (address) WHERE number_sent > {BOT_SENT} UNION SELECT address FROM vd WHERE number_sent > {BOT_SENT}),
first AS (SELECT * FROM hop1 WHERE o NOT IN (SELECT address FROM bots))
SELECT DISTINCT center, f, t FROM (SELECT center, f, t FROM first UNION ALL SELECT h.center, i.f, i.t FROM first h JOIN deg d ON h.o = d.address AND d.number_sent < 100 AND d.number_received < 100 JOIN inc i ON h.o = i.a JOIN vert v ON i.o = v.address WHERE NOT v.hot_wallet)""", coded=True)
def two_hop_without_bots(r: Relations) -> DataFrame:
    """First neighbours that send to many addresses are left out, contracts or not."""
    tagged = graph.tag_bots(vertices_with_degree(r.share()), r.contracts(), BOT_SENT)
    return subgraphs_without(r, tagged.where("bot OR contract").select("address"))


@query("""WITH v AS (SELECT center, f AS a FROM sub UNION SELECT center, t FROM sub),
n AS (SELECT center, count(*) AS num_address, string_agg(a, ',' ORDER BY a) AS members FROM v GROUP BY center HAVING count(*) <= 200)
SELECT center, center AS x_address, num_address, members, count(*) AS num_edges FROM n JOIN sub USING (center) GROUP BY ALL""", coded=True)
def subgraph_preprocess(r: Relations) -> DataFrame:
    """Subgraphs of up to 200 members with the list of these; the cap holds before the list is made."""
    return graph.preprocess(by_centre(r)).withColumn("members", F.array_join(F.transform("members", address), ","))


_REACH = """e AS (SELECT DISTINCT deposit AS a, usr AS b FROM du UNION SELECT DISTINCT usr, deposit FROM du),
reach AS (SELECT a, a AS b FROM e UNION SELECT reach.a, e.b FROM reach JOIN e ON reach.b = e.a)"""


@query(f"WITH {_REACH} SELECT a AS address, min(b) AS component FROM reach GROUP BY a", coded=True)
def components(r: Relations) -> DataFrame:
    t = links(r.share())
    found = deposits.exchange_deposits(t, r.hot(), r.burn()).select("address").distinct()
    users = deposits.deposit_users(t, found, r.hot(), r.burn())
    return graph.components(users.select(F.col("deposit").alias("f"), F.col("usr").alias("t")), written)


@query(f"WITH {_REACH} SELECT component, count(*) AS size FROM (SELECT a, min(b) AS component FROM reach GROUP BY a) GROUP BY component ORDER BY size DESC, component", coded=True)
def component_sizes(r: Relations) -> DataFrame:
    """The largest components first."""
    return components(r).groupBy("component").agg(F.count("*").alias("size")).orderBy(F.desc("size"), "component")
