"""Scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..fixtures import Relations, seconds
from ..functions import chains, scalars, schedule
from ..operators import features
from ..sources import store
from .registry import query

_T = "(SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS t FROM events)"


def times(r: Relations) -> DataFrame:
    return r.t("events").select("event_id", seconds("ts").alias("t"))


@query(f"""SELECT event_id, t // 86400 * 86400 AS day, t // 900 * 900 AS quarter, t // 86400 = (t + 50000) // 86400 AS same_day, t % 86400 // 3600 AS hour,
  strftime(make_timestamp(t * 1000000), '%Y-%m-%d %H:%M:%S') AS written FROM {_T}""")
def fn_time(r: Relations) -> DataFrame:
    t = F.col("t")
    return times(r).select(
        "event_id", scalars.round_to(t).alias("day"), scalars.round_to(t, 900).alias("quarter"), (scalars.div(t, 86400) == scalars.div(t + 50000, 86400)).alias("same_day"),
        scalars.hour_of(t).alias("hour"), F.from_unixtime(t, "yyyy-MM-dd HH:mm:ss").alias("written"),
    )


def _ladder(d: str, past: bool) -> str:
    ago = " ago" if past else ""
    one = {"few": "just now", "minute": "a minute ago", "hour": "an hour ago", "day": "yesterday"} if past else {"few": "few seconds", "minute": "minute", "hour": "hour", "day": "24 hours"}
    return f"""CASE WHEN {d} < 0 THEN '' WHEN {d} < 10 THEN '{one["few"]}' WHEN {d} < 60 THEN {d} || ' seconds{ago}' WHEN {d} < 120 THEN '{one["minute"]}'
  WHEN {d} < 3600 THEN {d} // 60 || ' minutes{ago}' WHEN {d} < 7200 THEN '{one["hour"]}' WHEN {d} < 86400 THEN {d} // 3600 || ' hours{ago}' WHEN {d} < 172800 THEN '{one["day"]}'
  WHEN {d} < 604800 THEN {d} // 86400 || ' days{ago}' WHEN {d} < 2678400 THEN {d} // 604800 || ' weeks{ago}' WHEN {d} < 31536000 THEN {d} // 2592000 || ' months{ago}' ELSE {d} // 31536000 || ' years{ago}' END"""


@query(f"SELECT event_id, {_ladder('d', True)} AS age, {_ladder('d', False)} AS span FROM (SELECT event_id, (event_id * event_id) % 100000000 - 5 AS d FROM events)")
def fn_pretty(r: Relations) -> DataFrame:
    d = (F.col("event_id") * F.col("event_id")) % 100000000 - 5
    return r.t("events").select("event_id", scalars.in_words(d).alias("age"), scalars.in_words(d, scalars.DURATIONS).alias("span"))


@query(f"SELECT event_id, (t + 3600) // 3600 * 3600 + 60 AS due FROM {_T}")
def fn_window(r: Relations) -> DataFrame:
    return times(r).select("event_id", scalars.window_end(F.col("t"), 3600, 60).alias("due"))


@query("SELECT '0x1_' || lower(c_name) || '_' || c_custkey AS key, '0x1' AS chain_id, CAST(c_custkey AS VARCHAR) AS tail, lower(c_name) AS address FROM customer")
def fn_keys(r: Relations) -> DataFrame:
    keys = r.t("customer").select(F.concat_ws("_", F.lit("0x1"), F.lower("c_name"), F.col("c_custkey").cast("string")).alias("key"))
    return keys.select("key", F.split_part("key", F.lit("_"), F.lit(1)).alias("chain_id"), scalars.last_part(F.col("key")).alias("tail"), F.split_part("key", F.lit("_"), F.lit(2)).alias("address"))


@query("SELECT hash, block_number AS from_hex, TRY_CAST(value AS BIGINT) AS small_value FROM txs")
def fn_parse(r: Relations) -> DataFrame:
    t = r.transactions().withColumn("hex", F.concat(F.lit("0x"), F.lower(F.hex("block_number"))))
    return t.select("hash", scalars.from_hex(F.col("hex")).alias("from_hex"), F.col("value").try_cast("long").alias("small_value"))


@query("""SELECT p_partkey, low, least(low + 9, p_size + p_partkey % 50) AS high FROM (SELECT p_partkey, p_size, unnest(range(CAST(p_size AS BIGINT), p_size + p_partkey % 50 + 1, 10)) AS low FROM part)""")
def fn_batches(r: Relations) -> DataFrame:
    low = F.col("p_size").cast("long")
    return r.t("part").select("p_partkey", F.inline(scalars.batches(low, low + F.col("p_partkey") % 50, 10)))


@query("SELECT user_id, event_id, lead(event_id) OVER (PARTITION BY user_id ORDER BY event_id) AS next_id FROM events QUALIFY next_id IS NOT NULL")
def fn_pairwise(r: Relations) -> DataFrame:
    rows = features.ahead(r.t("events").select("user_id", "event_id"), ["user_id"], ["event_id"], 1)
    return rows.select("user_id", "event_id", F.get("ahead", 0)["event_id"].alias("next_id")).where("next_id IS NOT NULL")


@query("""SELECT c_custkey, '{"k":' || c_custkey || CASE WHEN c_acctbal >= 0 THEN ',"s":"' || c_mktsegment || '"' ELSE '' END || '}' AS doc FROM customer""")
def fn_dropnull(r: Relations) -> DataFrame:
    c = r.t("customer")
    return c.select("c_custkey", F.to_json(F.struct(F.col("c_custkey").alias("k"), F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment")).alias("s"))).alias("doc"))


@query("SELECT p_partkey, 2::BIGINT AS n, round(CAST(p_retailprice AS DECIMAL(10,2))::DOUBLE + 0.5, 6) AS total FROM part")
def fn_embedding_parse(r: Relations) -> DataFrame:
    text = F.concat(F.lit("["), F.col("p_retailprice").cast("decimal(10,2)").cast("string"), F.lit(" x7 0.5 12]"))
    parsed = r.t("part").select("p_partkey", scalars.floats(text).alias("v"))
    return parsed.select("p_partkey", F.size("v").cast("long").alias("n"), F.round(F.aggregate("v", F.lit(0.0), lambda a, x: a + x), 6).alias("total"))


@query("""SELECT name, base || CASE WHEN k > 1 THEN '__' || (k - 1) ELSE '' END AS column_name FROM (SELECT name, base, row_number() OVER (PARTITION BY base ORDER BY name) AS k
  FROM (SELECT DISTINCT name, regexp_replace(name, '[^\\w]', '_', 'g') AS base FROM (SELECT p_type AS name FROM part UNION ALL SELECT replace(p_type, ' ', '-') FROM part)))""")
def fn_sanitize(r: Relations) -> DataFrame:
    types = r.t("part").select(F.col("p_type").alias("name"))
    names = types.union(types.select(F.replace("name", F.lit(" "), F.lit("-")))).distinct().withColumn("base", scalars.sanitised(F.col("name")))
    k = F.row_number().over(W.partitionBy("base").orderBy("name"))
    return names.withColumn("k", k).select("name", F.concat("base", F.when(F.col("k") > 1, F.concat(F.lit("__"), (F.col("k") - 1).cast("string"))).otherwise("")).alias("column_name"))


@query("""SELECT vec_id, next_id, round(list_dot_product(e, f) / sqrt(list_dot_product(e, e)) / sqrt(list_dot_product(f, f)), 6) AS similarity
FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e, lead(vec_id) OVER w AS next_id, CAST(lead(embedding) OVER w AS DOUBLE[]) AS f FROM embeddings WINDOW w AS (PARTITION BY label ORDER BY vec_id)) WHERE next_id IS NOT NULL""")
def cosine(r: Relations) -> DataFrame:
    rows = features.ahead(r.t("embeddings").select("label", "vec_id", "embedding"), ["label"], ["vec_id"], 1)
    pairs = rows.select("vec_id", F.get("ahead", 0)["vec_id"].alias("next_id"), "embedding", F.get("ahead", 0)["embedding"].alias("other")).where("next_id IS NOT NULL")
    return pairs.select("vec_id", "next_id", F.round(scalars.cosine(F.col("embedding"), F.col("other")), 6).alias("similarity"))


@query("""SELECT o_orderkey, TRY_CAST(replace(CASE o_orderkey % 5 WHEN 0 THEN o_orderkey || ',500.5' WHEN 1 THEN 'abc' WHEN 2 THEN '' WHEN 3 THEN NULL ELSE '-' || o_orderkey END, ',', '') AS DOUBLE) AS value FROM orders""")
def numeric_coercion(r: Relations) -> DataFrame:
    k = F.col("o_orderkey")
    text = F.when(k % 5 == 0, F.concat(k.cast("string"), F.lit(",500.5"))).when(k % 5 == 1, "abc").when(k % 5 == 2, "").when(k % 5 == 4, F.concat(F.lit("-"), k.cast("string")))
    return r.t("orders").select("o_orderkey", scalars.number(text).alias("value"))


@query("""WITH p AS (SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS k FROM events)
SELECT a.event_type AS left_type, b.event_type AS right_type, CAST(b.k - a.k AS INT) AS distance, count(*) AS n FROM p a JOIN p b ON a.user_id = b.user_id AND b.k - a.k BETWEEN 1 AND 10 GROUP BY ALL""")
def cooccurrence(r: Relations) -> DataFrame:
    rows = features.ahead(r.t("events").select("user_id", "event_id", "event_type"), ["user_id"], ["event_id"], 10)
    spread = rows.select(F.col("event_type").alias("left_type"), F.posexplode("ahead").alias("place", "right")).select("left_type", F.col("right.event_type").alias("right_type"), (F.col("place") + 1).alias("distance"))
    return spread.groupBy("left_type", "right_type", "distance").agg(F.count("*").alias("n"))


@query("""SELECT o_orderkey, name, chain_id, abi, floor(age / block_seconds)::BIGINT AS blocks
FROM (SELECT o_orderkey, (o_custkey % 7)::INT AS place, floor(epoch(o_orderdate))::BIGINT - (SELECT min(floor(epoch(o_orderdate))::BIGINT) FROM orders) AS age FROM orders) o
JOIN (VALUES (0, 'bsc', '0x38', 3.0::DOUBLE, 'bep20_abi'), (1, 'ethereum', '0x1', 12, 'erc20_abi'), (2, 'fantom', '0xfa', 1, 'erc20_abi'), (3, 'polygon', '0x89', 2, 'erc20_abi'), (4, 'arbitrum', '0xa4b1', 0.3, 'erc20_abi'), (5, 'optimism', '0xa', NULL, 'erc20_abi'), (6, 'avalanche', '0xa86a', 2, 'erc20_abi')) v(place, name, chain_id, block_seconds, abi) USING (place)""")
def chain_table(r: Relations) -> DataFrame:
    """Orders by chain: the chain's number and interface, and how many of its blocks came since the first order."""
    names = F.array(*(F.lit(row[0]) for row in chains.CHAINS))
    orders = r.t("orders").select("o_orderkey", F.get(names, (F.col("o_custkey") % len(chains.CHAINS)).cast("int")).alias("name"), seconds("o_orderdate").alias("at"))
    first = orders.agg(F.min("at")).first()[0]
    met = orders.join(chains.chains(r.spark), "name")
    return met.select("o_orderkey", "name", "chain_id", "abi", F.floor((F.col("at") - F.lit(first)) / F.col("block_seconds")).alias("blocks"))


@query("""SELECT l_orderkey, l_linenumber, n AS chain, CASE n WHEN 'bsc' THEN '0x38' WHEN 'ethereum' THEN '0x1' ELSE '0x89' END AS chain_id,
  CASE WHEN n = 'bsc' THEN '' ELSE n || '_' END || 'blockchain_etl' AS chain_schema FROM (SELECT *, CASE l_suppkey % 4 WHEN 0 THEN 'bsc' WHEN 1 THEN 'ethereum' WHEN 2 THEN 'polygon' END AS n FROM lineitem) WHERE n IS NOT NULL""")
def transfers_by_chain(r: Relations) -> DataFrame:
    """Transfers with their chain and its schema; those of a chain that isn't supported go."""
    k = F.col("l_suppkey") % 4
    named = F.when(k == 0, "bsc").when(k == 1, "ethereum").otherwise("polygon")
    rows = r.t("lineitem").where(k < 3).select("l_orderkey", "l_linenumber", named.alias("chain"))
    return chains.with_chain(rows, F.col("chain")).select("l_orderkey", "l_linenumber", "chain", "chain_id", "chain_schema")


@query("SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN 'cex_hot_wallet' WHEN 1 THEN 'cex_deposit_wallet,cex_hot_wallet' ELSE '' END AS tags FROM customer")
def wallet_tags(r: Relations) -> DataFrame:
    """Tags that aren't known are ignored, and repeats are added once."""
    k = F.col("c_custkey") % 3
    given = F.when(k == 0, F.array(F.lit("cex_hot_wallet"), F.lit("whale"), F.lit("cex_hot_wallet"))).when(k == 1, F.array(F.lit("cex_deposit_wallet"), F.lit("cex_hot_wallet"))).otherwise(F.array(F.lit("dust")))
    return r.t("customer").select("c_custkey", F.array_join(chains.known_tags(given), ",").alias("tags"))


@query("SELECT event_id, coalesce(c = -32603 OR c BETWEEN -32099 AND -32000, false) AS retriable FROM (SELECT event_id, CASE WHEN event_id % 10 = 0 THEN NULL WHEN event_id % 10 = 1 THEN -32603 ELSE -31900 - event_id % 300 END AS c FROM events)")
def fn_codes(r: Relations) -> DataFrame:
    k = F.col("event_id") % 10
    code = F.when(k == 1, -32603).when(k != 0, -31900 - F.col("event_id") % 300)
    return r.t("events").select("event_id", chains.retriable(code).alias("retriable"))


@query(f"""SELECT event_id, CASE WHEN first <= until THEN (until - first) // 3600 + 1 ELSE 0 END AS n, CASE WHEN first <= until THEN first + (until - first) // 3600 * 3600 END AS last_end
FROM (SELECT event_id, (t + 3600) // 3600 * 3600 + 60 AS first, t + event_id % 20000 AS until FROM {_T})""")
def fn_schedule(r: Relations) -> DataFrame:
    """How many windows of an hour, a minute late, are due within some time, and where the last ends."""
    due = schedule.ends(F.col("t"), 3600, 60, F.col("t") + F.col("event_id") % 20000)
    return times(r).select("event_id", due.alias("due")).select("event_id", F.size("due").cast("long").alias("n"), F.when(F.size("due") > 0, F.element_at("due", -1)).alias("last_end"))


@query(f"SELECT event_id, t - 1209600 AS low, t - 86400 AS high, CAST(epoch(date_trunc('month', make_timestamp((t + 25200) * 1000000)) + INTERVAL 1 MONTH) AS BIGINT) + 5400 - 25200 AS due FROM {_T}")
def fn_monthly(r: Relations) -> DataFrame:
    low, high = schedule.monthly_window(F.col("t"))
    return times(r).select("event_id", low.alias("low"), high.alias("high"), schedule.next_month(F.col("t")).alias("due"))


@query("SELECT c_custkey, c_name AS \"who.name\", c_mktsegment AS \"who.at.segment\", c_acctbal AS balance FROM customer")
def fn_flatten(r: Relations) -> DataFrame:
    c = r.t("customer")
    nested = c.select("c_custkey", F.struct(F.col("c_name").alias("name"), F.struct(F.col("c_mktsegment").alias("segment")).alias("at")).alias("who"), F.col("c_acctbal").alias("balance"))
    return store.flattened(nested)
