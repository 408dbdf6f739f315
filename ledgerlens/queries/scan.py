"""Scans, sources and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..codes import named
from ..fixtures import BORDER, LAST, Relations, concat, seconds
from ..functions import chains
from ..operators import deposits, features, graph
from ..sources import layout, scans, store
from ..sources.store import shared_path, written
from .graph import edges, links, logs, vertices, vertices_with_degree
from .registry import query


def token_transfers(r: Relations) -> DataFrame:
    return r.transfers().withColumn("block_number", F.expr("l_orderkey div 10"))


@query("SELECT l_orderkey // 10 AS block_number, f, t, tok, amt FROM tf, (SELECT min(l_orderkey // 10) AS lo, max(l_orderkey // 10) AS hi FROM lineitem) WHERE l_orderkey // 10 BETWEEN lo + 1 AND hi - 1")
def scan_token_transfers(r: Relations) -> DataFrame:
    """A range with both of its ends, here all blocks but the first and the last."""
    low, high = scans.ends(r.t("lineitem").select(F.expr("l_orderkey div 10").alias("block_number")), "block_number")
    return scans.in_range(token_transfers(r), "block_number", low + 1, high - 1).select("block_number", "f", "t", "tok", "amt")


_LAID = "SELECT *, CASE WHEN length(from_address) % 2 = 0 THEN '0x1' ELSE '0x38' END AS chain_id FROM txs"


def laid(r: Relations) -> str:
    """Where the transactions stand, laid out by chain and bucket."""
    path, chain = shared_path(r.spark), F.when(F.length("from_address") % 2 == 0, chains.chain_id("ethereum")).otherwise(chains.chain_id("bsc"))
    layout.write(r.transactions().withColumn("chain_id", chain), path)
    return path


@query(f"WITH l AS ({_LAID}) SELECT hash, block_number, from_address, chain_id, block_number // 1000 AS bucket FROM l WHERE chain_id = '0x38' AND block_number // 1000 = (SELECT max(block_number) // 1000 FROM txs)")
def scan_bucket(r: Relations) -> DataFrame:
    """One bucket of one chain, of which alone the folder is read."""
    last = scans.ends(r.transactions().select("block_number"), "block_number")[1] // layout.WIDTH
    rows = layout.bucket(r.spark, laid(r), last, chains.chain_id("bsc"))
    return rows.select("hash", "block_number", "from_address", "chain_id", F.col("bucket").cast("long").alias("bucket"))


@query(f"WITH l AS ({_LAID}) SELECT hash, block_number, chain_id FROM l WHERE block_number IN (SELECT number FROM oblocks WHERE timestamp >= (SELECT max(timestamp) - 86400 * 30 FROM oblocks))")
def scan_at_blocks(r: Relations) -> DataFrame:
    """Transactions of the blocks of the last 30 days, whose buckets select the folders."""
    blocks = r.order_blocks()
    last = scans.ends(blocks, "timestamp")[1]
    recent = blocks.where(F.col("timestamp") >= last - 86400 * 30).select(F.col("number").alias("block_number"))
    return layout.at_blocks(r.spark.read.parquet(laid(r)), recent).select("hash", "block_number", "chain_id")


@query("SELECT 'orders' AS name, count(*) AS n, min(o_orderkey) AS low, max(o_orderkey) AS high FROM orders UNION ALL SELECT 'lineitem', count(*), min(l_partkey), max(l_partkey) FROM lineitem UNION ALL SELECT 'events', count(*), min(event_id), max(event_id) FROM events")
def metadata_counts(r: Relations) -> DataFrame:
    """Counts and ends from the files' footers."""
    keys = {"orders": "o_orderkey", "lineitem": "l_partkey", "events": "event_id"}
    found = [(name, *map(int, layout.from_footers(r.spark, f"{r.dir}/{name}.parquet", key))) for name, key in keys.items()]
    return r.spark.createDataFrame(found, "name string, n long, low long, high long")


@query("SELECT number, timestamp FROM blocks WHERE number BETWEEN (SELECT min(number) + 1 FROM blocks) AND (SELECT max(number) - 1 FROM blocks)")
def scan_blocks(r: Relations) -> DataFrame:
    low, high = scans.ends(r.blocks(), "number")
    return scans.in_range(r.blocks(), "number", low + 1, high - 1).select("number", "timestamp")


@query("SELECT DISTINCT f, t FROM tf WHERE t IN (SELECT address FROM hot)", coded=True)
def senders_token(r: Relations) -> DataFrame:
    return deposits.senders(r.transfers(), r.hot()).distinct()


@query("SELECT from_address AS f, to_address AS t FROM txs WHERE to_address IN (SELECT 'c' || c_custkey FROM customer WHERE c_nationkey < 5)")
def senders_native(r: Relations) -> DataFrame:
    receivers = r.t("customer").where("c_nationkey < 5").select(concat("c", F.col("c_custkey")).alias("address"))
    return deposits.senders(r.transactions().select(F.col("from_address").alias("f"), F.col("to_address").alias("t")), receivers)


@query("SELECT address, last_transfer_at FROM vert WHERE address IN (SELECT address FROM contracts)", coded=True)
def addresses_by_list(r: Relations) -> DataFrame:
    return scans.by_list(vertices(r), r.contracts(), "address", ["address", "last_transfer_at"])


@query("SELECT address, last_transfer_at, number_sent, number_received FROM vd WHERE deposit_wallet", coded=True)
def addresses_by_flag(r: Relations) -> DataFrame:
    return scans.by_flag(vertices_with_degree(r), "deposit_wallet", ["address", "last_transfer_at", "number_sent", "number_received"])


@query(f"SELECT address, last_transfer_at FROM vert WHERE NOT hot_wallet AND last_transfer_at > {BORDER}", coded=True)
def recent_non_hot(r: Relations) -> DataFrame:
    return scans.recent_not_hot(vertices(r), BORDER).select("address", "last_transfer_at")


@query("SELECT (SELECT count(*) FROM vert) AS vertices, (SELECT count(*) FROM edges) AS edges")
def graph_counts(r: Relations) -> DataFrame:
    ends = edges(r).select("f", "t", F.explode(F.array("f", "t")).alias("address")).withColumn("edge", F.concat_ws(">", "f", "t"))
    # both counts from one pass: addresses and edges are folded by key first, so neither is gathered
    one = ends.select(F.inline(F.array(F.struct(F.lit("v").alias("kind"), F.col("address").alias("key")), F.struct(F.lit("e").alias("kind"), F.col("edge").alias("key"))))).distinct()
    return one.agg(F.count_if(F.col("kind") == "v").alias("vertices"), F.count_if(F.col("kind") == "e").alias("edges"))


@query("SELECT address, address IN (SELECT address FROM vert) AS present FROM contracts", coded=True)
def names_existing(r: Relations) -> DataFrame:
    known = vertices(r).select("address", F.lit(True).alias("present"))
    return r.contracts().select("address").join(known, "address", "left").select("address", F.coalesce("present", F.lit(False)).alias("present"))


@query("SELECT min(last_transfer_at) AS first_at, max(last_transfer_at) AS last_at FROM vert", coded=True)
def min_max_field(r: Relations) -> DataFrame:
    return vertices(r).agg(F.min("last_transfer_at").alias("first_at"), F.max("last_transfer_at").alias("last_at"))


@query("SELECT address, exchange FROM (SELECT DISTINCT address, exchange FROM dep) ORDER BY address, exchange LIMIT 50 OFFSET 100")
def paged_scan(r: Relations) -> DataFrame:
    found = deposits.exchange_deposits(r.transfers(), r.hot(), r.burn())
    return found.orderBy("address", "exchange").offset(100).limit(50)


@query("SELECT deposit, usr FROM du", coded=True)
def deposit_users_scan(r: Relations) -> DataFrame:
    return users(r).select("deposit", "usr")


def users(r: Relations) -> DataFrame:
    t = links(r.share())
    found = deposits.exchange_deposits(t, r.hot(), r.burn()).select("address").distinct()
    return deposits.deposit_users(t, found, r.hot(), r.burn())


@query("SELECT p.tok, p.day, p.px FROM price p WHERE p.tok IN (SELECT tok FROM toks) AND px IS NOT NULL")
def price_logs(r: Relations) -> DataFrame:
    return scans.by_list(r.prices().where("px IS NOT NULL"), top(r), "tok", ["tok", "day", "px"])


def top(r: Relations, n: int = 5) -> DataFrame:
    """The most common tokens, ties by name: a report of the top ``n``."""
    return r.t("part").groupBy(F.col("p_brand").alias("tok")).count().orderBy(F.desc("count"), "tok").limit(n).select("tok")


@query("SELECT tok FROM toks")
def top_tokens(r: Relations) -> DataFrame:
    return top(r)


@query("SELECT p_brand AS tok, max(p_type) AS market_id FROM part WHERE p_type IS NOT NULL GROUP BY p_brand")
def token_ids(r: Relations) -> DataFrame:
    return r.t("part").where("p_type IS NOT NULL").groupBy(F.col("p_brand").alias("tok")).agg(F.max("p_type").alias("market_id"))


@query("SELECT event_id, user_id, event_type FROM events WHERE event_id >= (SELECT min(event_id) + 1 FROM events) AND event_id < (SELECT max(event_id) FROM events)")
def range_scan(r: Relations) -> DataFrame:
    """A range without its end."""
    low, high = scans.ends(r.t("events"), "event_id")
    return r.t("events").where((F.col("event_id") >= low + 1) & (F.col("event_id") < high)).select("event_id", "user_id", "event_type")


@query("SELECT event_id, user_id FROM events ORDER BY event_id LIMIT 100")
def parallel_scan_limit(r: Relations) -> DataFrame:
    return scans.page(r.t("events").select("event_id", "user_id"), "event_id", 0, 100)


@query("SELECT event_id, user_id FROM events, (SELECT min(event_id) AS lo, max(event_id) AS hi FROM events) WHERE event_id > lo + 10 AND event_id < hi ORDER BY event_id")
def resume_slice(r: Relations) -> DataFrame:
    """All that a slice has left after the key at which a run stopped."""
    low, high = scans.ends(r.t("events"), "event_id")
    return scans.slice_after(r.t("events").select("event_id", "user_id"), "event_id", low + 10, high)


@query("SELECT DISTINCT center AS sg, f, t FROM sub", coded=True)
def subgraph_edges(r: Relations) -> DataFrame:
    from .graph import subgraphs

    return subgraphs(r).withColumnRenamed("center", "sg")


@query("SELECT v.address, coalesce(c.is_contract, false) AS is_contract FROM vert v LEFT JOIN contracts c USING (address)", coded=True)
def contract_flags(r: Relations) -> DataFrame:
    flags = r.contracts()
    return vertices(r).select("address").join(flags, "address", "left").select("address", F.coalesce("is_contract", F.lit(False)).alias("is_contract"))


@query("SELECT DISTINCT hash, block_number, from_address, to_address FROM txs WHERE block_number >= (SELECT min(block_number) + 1 FROM txs) AND block_number < (SELECT max(block_number) FROM txs) AND (from_address IN (SELECT 'c' || c_custkey FROM customer WHERE c_nationkey < 5) OR to_address IN (SELECT 'c' || c_custkey FROM customer WHERE c_nationkey < 5))")
def related_transactions(r: Relations) -> DataFrame:
    wallets = r.t("customer").where("c_nationkey < 5").select(concat("c", F.col("c_custkey")).alias("address"))
    low, high = scans.ends(r.transactions(), "block_number")
    return scans.related(r.transactions(), wallets, low + 1, high).select("hash", "block_number", "from_address", "to_address")


@query("SELECT hash, block_number, f, t, amt FROM native")
def native_transfers(r: Relations) -> DataFrame:
    return scans.native_transfers(r.transactions(), r.receipts())


@query("SELECT n.hash, n.block_number, f, t, amt, b.timestamp AS ts FROM native n JOIN oblocks b ON n.block_number = b.number")
def transfers_with_ts(r: Relations) -> DataFrame:
    return scans.with_time(scans.native_transfers(r.transactions(), r.receipts()), r.order_blocks())


@query("SELECT 'native' AS source, f, t, 'native' AS tok, amt FROM native UNION ALL SELECT 'token', f, t, tok, amt FROM tf")
def all_transfers(r: Relations) -> DataFrame:
    native = scans.native_transfers(r.transactions(), r.receipts()).select("f", "t", F.lit("native").alias("tok"), "amt")
    return scans.sources(["native", "token"], native=native, token=r.transfers().select("f", "t", "tok", "amt"))


@query("SELECT f, t, tok, ts, amt FROM logs")
def csv_roundtrip(r: Relations) -> DataFrame:
    # folded as numbers, written as addresses
    entries = logs(Relations(r.spark, r.dir, True))
    return store.csv_copy(named(entries.select("f", "t", "tok", "ts", "amt")))


# Upserts: the old table is what was seen before the border, the patch what came since.


@query(f"""SELECT address, coalesce(n.ts, o.ts) AS last_transfer_at, o.ts AS first_batch_at FROM
  (SELECT f AS address, max(ts) AS ts FROM adm WHERE ts < {BORDER} GROUP BY f) o FULL JOIN
  (SELECT f AS address, max(ts) AS ts FROM adm WHERE ts >= {BORDER} GROUP BY f) n USING (address)""")
def upsert_set(r: Relations) -> DataFrame:
    admitted = graph.admit(r.transfers(), r.hot(), r.burn()).select(F.col("f").alias("address"), "ts")
    at = lambda df: df.groupBy("address").agg(F.max("ts").alias("last_transfer_at"))
    old = at(admitted.where(F.col("ts") < BORDER)).withColumn("first_batch_at", F.col("last_transfer_at"))
    return store.upsert_set(old, at(admitted.where(F.col("ts") >= BORDER)), "address")


@query("SELECT t AS deposit, count(DISTINCT tok)::BIGINT AS n, min(tok) AS first_tok, max(tok) AS last_tok FROM adm WHERE leg = 0 GROUP BY t")
def upsert_add_to_set(r: Relations) -> DataFrame:
    admitted = graph.admit(r.transfers(), r.hot(), r.burn()).where("leg = 0").select(F.col("t").alias("deposit"), "tok", "ts")
    half = lambda rule: admitted.where(rule).groupBy("deposit").agg(F.collect_set("tok").alias("toks"))
    both = store.upsert_add_to_set(half(F.expr("ts % 2 = 0")), half(F.expr("ts % 2 = 1")), "deposit", ["toks"])
    return both.select("deposit", F.size("toks").cast("long").alias("n"), F.array_min("toks").alias("first_tok"), F.array_max("toks").alias("last_tok"))


@query("""SELECT 'c' || c_custkey AS address, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_mktsegment END AS segment,
  CASE WHEN c_custkey % 2 = 0 THEN c_acctbal + 1 ELSE c_acctbal END AS balance, CASE WHEN c_custkey % 2 = 0 THEN c_name || ',' || 'x' ELSE c_name END AS tags FROM customer""")
def upsert_flatten_merge(r: Relations) -> DataFrame:
    c, key = r.t("customer"), F.col("c_custkey")
    old = c.select(concat("c", key).alias("address"), F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("balance"), F.array("c_name").alias("tags"))
    patch = c.where("c_custkey % 2 = 0 OR c_custkey % 3 = 0").select(
        concat("c", key).alias("address"), F.lit(None).cast("string").alias("segment"), F.when(key % 2 == 0, F.col("c_acctbal") + 1).alias("balance"),
        F.when(key % 2 == 0, F.array(F.lit("x"), F.lit(""))).alias("tags"), F.when(key % 3 == 0, F.array(F.lit("segment"))).alias("cleared"),
    )
    return store.upsert_merge(old, patch, "address", ("tags",)).withColumn("tags", F.array_join("tags", ","))


@query("SELECT address, last_transfer_at, hot_wallet, deposit_wallet FROM vert", coded=True)
def merge_vertices(r: Relations) -> DataFrame:
    admitted = graph.admit(r.transfers(), r.hot(), r.burn())
    old, new = (graph.vertices_of(admitted.where(rule), r.hot()) for rule in (F.col("ts") < BORDER, F.col("ts") >= BORDER))
    return store.merge_vertices(old, new)


@query(f"""SELECT f, t, tok, ts, amt, CASE WHEN ts < {BORDER} THEN -1.0 ELSE usd END AS usd FROM logs""", coded=True)
def merge_edges(r: Relations) -> DataFrame:
    """All entries since the border upon older ones, on some of which they fall: old entries that no new one has stay, and equal keys take the new values."""
    folded = written(logs(r))
    old = folded.where(F.col("ts") < BORDER + 86400 * 45).withColumn("usd", F.lit(-1.0))
    return store.merge_logs(old, folded.where(F.col("ts") >= BORDER))


@query("SELECT CAST(json_extract_string(props, '$.k') AS VARCHAR) AS k, count(*) AS n FROM events GROUP BY 1")
def json_props(r: Relations) -> DataFrame:
    return r.t("events").groupBy(F.get_json_object("props", "$.k").alias("k")).agg(F.count("*").alias("n"))


@query("SELECT b.number, b.timestamp FROM blocks b")
def block_times(r: Relations) -> DataFrame:
    return r.t("events").groupBy(seconds("ts").alias("timestamp")).agg(F.min("event_id").alias("number")).select("number", "timestamp")


@query("SELECT CAST(ntile AS INT) AS bucket, min(address) AS low, max(address) AS high, count(*) AS n FROM (SELECT address, ntile(8) OVER (ORDER BY address) AS ntile FROM vert) GROUP BY 1")
def auto_buckets(r: Relations) -> DataFrame:
    placed = features.numbered(vertices(r).select("address"), "address")
    n = F.broadcast(placed.agg(F.count("*").alias("total")))
    small, extra = F.expr("total div 8"), F.expr("total % 8")
    cut = extra * (small + 1)
    number = F.when(F.col("place") < cut, F.expr("place div (total div 8 + 1)")).otherwise(extra + F.expr("(place - (total % 8) * (total div 8 + 1)) div greatest(total div 8, 1)"))
    return placed.join(n).groupBy((number + 1).cast("int").alias("bucket")).agg(F.min("address").alias("low"), F.max("address").alias("high"), F.count("*").alias("n"))


@query("""SELECT CAST(greatest(1, least(10, 1 + (timestamp - lo) * 10 // (hi + 1 - lo))) AS INT) AS slice, count(*) AS n
  FROM blocks, (SELECT min(timestamp) AS lo, max(timestamp) AS hi FROM blocks) GROUP BY 1""")
def time_slices(r: Relations) -> DataFrame:
    blocks = r.blocks()
    ends = F.broadcast(blocks.agg(F.min("timestamp").alias("lo"), F.max("timestamp").alias("hi")))
    return blocks.join(ends).groupBy(F.expr("cast(1 + (timestamp - lo) * 10 div (hi + 1 - lo) as int)").alias("slice")).agg(F.count("*").alias("n"))
