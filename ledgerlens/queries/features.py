"""Features of subgraph members and the labelled pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..codes import address
from ..fixtures import Relations, concat, wallet_of
from ..functions.scalars import cosine
from ..operators import embedding, features
from ..sources.store import written
from .graph import by_centre, logs, reached, subgraphs
from .registry import query
from .reuse import reuse
from .scan import top


def entries(r: Relations) -> DataFrame:
    """Written only where a query shares them because it reads them twice."""
    return r.kept("entries", lambda: features.subgraph_logs(subgraphs(r), logs(r)))


@query("SELECT sg, f, t, tok, ts, amt, usd FROM sublogs", coded=True)
def subgraph_edge_logs(r: Relations) -> DataFrame:
    return entries(r)


@query("SELECT min(center) AS center, f, t FROM sub GROUP BY f, t", coded=True)
def edge_first_claim(r: Relations) -> DataFrame:
    return features.first_claim(reached(r))  # repeats change no first claim


_MEMBERS = "v AS (SELECT center, f AS a FROM sub UNION SELECT center, t FROM sub)"


def walks(r: Relations) -> DataFrame:
    return r.kept("walks", lambda: embedding.walks(subgraphs(r) if "subgraphs" in r.shared else by_centre(r)))


@query(f"WITH {_MEMBERS}, n AS (SELECT center, count(*) AS n FROM v GROUP BY center) SELECT center AS sg, CAST(s AS INT) AS seed, a AS start, 2 * least(40, n) - 1 AS steps, true AS closed FROM v JOIN n USING (center), range(4) AS r(s)", coded=True)
def diffusion_walks(r: Relations) -> DataFrame:
    """What any walk over a connected subgraph has, whichever way it went: its length, and both ends at its start."""
    closed = (F.get("walk", 0) == F.col("start")) & (F.element_at("walk", -1) == F.col("start"))
    return walks(r).select("sg", "seed", "start", F.size("walk").cast("long").alias("steps"), closed.alias("closed"))


def vectors(r: Relations) -> DataFrame:
    return r.share("subgraphs", "walks", "vectors").kept("vectors", lambda: embedding.embed(walks(r)))


@query(f"WITH {_MEMBERS} SELECT DISTINCT center AS sg, a AS address, 24 AS n, true AS found, 'diff2vec' AS model, '0x1' AS chain_id, 2 AS radius FROM v", coded=True)
def node_embeddings(r: Relations) -> DataFrame:
    """Every member of every subgraph with its vector and what it was made by."""
    r.share("subgraphs")
    some = F.exists("embedding", lambda x: x != 0)
    return embedding.exported(subgraphs(r), vectors(r), "Ethereum").select("sg", "address", F.size("embedding").alias("n"), some.alias("found"), "model", "chain_id", "radius")


@query(f"WITH {_MEMBERS} SELECT count(DISTINCT a) AS addresses, (SELECT count(*) FROM (SELECT DISTINCT f, t FROM sub WHERE f <> t)) AS edges, true AS nearer FROM v", coded=True)
def embedding_nearness(r: Relations) -> DataFrame:
    """Ends of an edge have nearer vectors, on the mean over all edges, than each start with the end of another edge."""
    v = vectors(r)
    ends = written(subgraphs(r).where("f <> t").select("f", "t").distinct())
    side = lambda c: v.select(F.col("address").alias(c), F.col("embedding").alias(f"{c}_v"))
    known = written(ends.join(side("f"), "f").join(side("t"), "t"))
    # every edge's end by turns in hash order goes to the start of the edge before it
    placed = features.numbered(known.withColumn("h", F.xxhash64("f", "t")), "h", "f", "t")
    moved = placed.select((F.col("place") - 1).alias("place"), F.col("t_v").alias("other_v"))
    near = placed.join(moved, "place", "left").agg(F.count("*").alias("edges"), (F.avg(cosine(F.col("f_v"), F.col("t_v"))) > F.avg(cosine(F.col("f_v"), F.col("other_v")))).alias("nearer"))
    return near.select(F.lit(v.count()).cast("long").alias("addresses"), "edges", "nearer")


@query("SELECT sg, address, token, usd FROM ffrom", coded=True)
def token_usd_features(r: Relations) -> DataFrame:
    return features.token_usd(entries(r), top(r), "f")


@query("SELECT sg, f AS address, ts % 86400 // 3600 AS hour, count(*) AS n FROM sublogs GROUP BY ALL", coded=True)
def hour_histogram(r: Relations) -> DataFrame:
    spread = features.hours(entries(r), "f").select("sg", "address", F.posexplode("time").alias("hour", "n"))
    return spread.where("n > 0").select("sg", "address", F.col("hour").cast("long").alias("hour"), "n")


@query("""SELECT sg, address, 'token' AS kind, token AS name, usd AS value FROM ffrom UNION ALL
SELECT sg, f, 'hour', CAST(ts % 86400 // 3600 AS VARCHAR), CAST(count(*) AS DOUBLE) FROM sublogs GROUP BY ALL""", coded=True)
def time_amount_features(r: Relations) -> DataFrame:
    e = entries(r.share("entries"))
    tokens = features.token_usd(e, top(r), "f").select("sg", "address", F.lit("token").alias("kind"), F.col("token").alias("name"), F.col("usd").alias("value"))
    time = features.hours(e, "f").select("sg", "address", F.posexplode("time").alias("hour", "n")).where("n > 0")
    return tokens.unionByName(time.select("sg", "address", F.lit("hour").alias("kind"), F.col("hour").cast("string").alias("name"), F.col("n").cast("double").alias("value")))


@query("SELECT sg, address, token, usd FROM fto", coded=True)
def features_to_fixed(r: Relations) -> DataFrame:
    """The receiving side keyed by the receiver."""
    return features.token_usd(entries(r), top(r), "t")


@query("SELECT sg, address, token, usd FROM ffrom", coded=True)
def features_to_literal(r: Relations) -> DataFrame:
    """The receiving side as the same record as the sending one, keyed by the sender."""
    return features.token_usd(entries(r), top(r), "f")


def merged(r: Relations) -> DataFrame:
    return r.kept("merged", lambda: features.members(entries(r)))


@query("SELECT sg, address, in_from, in_to FROM merged", coded=True)
def merge_from_to(r: Relations) -> DataFrame:
    return merged(r).select("sg", "address", "in_from", "in_to")


@query("SELECT sg, address, hour, count(*) AS n FROM (SELECT sg, f AS address, ts % 86400 // 3600 AS hour FROM sublogs UNION ALL SELECT sg, t, ts % 86400 // 3600 FROM sublogs) GROUP BY ALL", coded=True)
def time_sum(r: Relations) -> DataFrame:
    spread = merged(r).select("sg", "address", F.posexplode("time").alias("hour", "n"))
    return spread.where("n > 0").select("sg", "address", F.col("hour").cast("long").alias("hour"), "n")


def embeddings(r: Relations) -> DataFrame:
    """Vectors of the members' wallets in every month: those with odd numbers hold in their own subgraph only."""
    odd = F.col("vec_id") % 2 == 1
    wallets = r.t("embeddings").select(F.when(odd, concat("p", F.col("vec_id"))).otherwise(concat("c", F.col("vec_id"))).alias("wallet"), odd.alias("own"), "embedding")
    members = merged(r.share("merged")).select("address", wallet_of("address", r.coded).alias("wallet")).distinct()
    return members.join(wallets, "wallet").select(F.when(F.col("own"), F.col("address")).alias("sg"), "address", "embedding")


@query("""WITH e AS (SELECT CASE WHEN vec_id % 2 = 1 THEN 'p' ELSE 'c' END || vec_id AS wallet, vec_id % 2 = 1 AS own, embedding[1] AS x FROM embeddings)
SELECT m.sg, m.address, round(CAST(e.x AS DOUBLE), 6) AS first_value FROM merged m LEFT JOIN e ON regexp_replace(m.address, 'm[0-9]{6}$', '') = e.wallet AND (NOT e.own OR m.address = m.sg)""", coded=True)
def attach_embeddings(r: Relations) -> DataFrame:
    met = features.attach_embeddings(merged(r.share("merged")).select("sg", "address"), embeddings(r))
    return met.select("sg", "address", F.round(F.get("embedding", 0).cast("double"), 6).alias("first_value"))


@query("SELECT sg, address FROM merged WHERE address NOT IN (SELECT address FROM contracts WHERE is_contract)", coded=True)
def filter_contracts(r: Relations) -> DataFrame:
    return merged(r).select("sg", "address").join(r.contracts().where("is_contract").select("address"), "address", "left_anti")


@query("SELECT sg, x, subx FROM tp", coded=True)
def build_pairs(r: Relations) -> DataFrame:
    return features.pairs(merged(r))


def labelled(r: Relations) -> DataFrame:
    return r.kept("labelled", lambda: features.label(features.pairs(merged(r)), reuse(r)))


@query("SELECT sg, x, subx, label FROM lp", coded=True)
def label_pairs(r: Relations) -> DataFrame:
    return labelled(r).select("sg", "x", "subx", "label")


@query("SELECT label, count(*) AS n FROM lp GROUP BY label", coded=True)
def label_counts(r: Relations) -> DataFrame:
    return labelled(r).groupBy("label").agg(F.count("*").alias("n"))


@query("SELECT DISTINCT lp.sg, x, subx, label FROM lp JOIN ffrom f ON lp.sg = f.sg AND (f.address = lp.x OR f.address = lp.subx) WHERE x <> '' AND subx <> ''", coded=True)
def dedupe_pairs(r: Relations) -> DataFrame:
    """Pairs come once for each token value of either member, and are kept once."""
    r.share("entries")
    pairs = labelled(r).where((address(F.col("x")) != "") & (address(F.col("subx")) != ""))
    rows = features.long_features(pairs, features.token_usd(entries(r), top(r), "f"), keep=("label",))
    return rows.groupBy("sg", "x", "subx").agg(F.max("label").alias("label"))


@query("""SELECT p.sg, p.x, p.subx, 'X_From_' || token AS feature, usd FROM tp p JOIN ffrom f ON p.sg = f.sg AND p.x = f.address
UNION ALL SELECT p.sg, p.x, p.subx, 'SubX_From_' || token, usd FROM tp p JOIN ffrom f ON p.sg = f.sg AND p.subx = f.address""", coded=True)
def pair_features_long(r: Relations) -> DataFrame:
    e = entries(r.share("entries"))
    pairs = features.pairs(merged(r))
    return features.long_features(pairs, features.token_usd(e, top(r), "f"))


@query("""WITH c AS (SELECT x, row_number() OVER (ORDER BY md5('42' || x), x) AS k, count(*) OVER () AS n FROM (SELECT DISTINCT x FROM lp))
SELECT sg, lp.x, subx, label, CASE WHEN k <= greatest(1, least(n - 1, CAST(floor(n * 0.9) AS BIGINT))) THEN 'train' ELSE 'test' END AS part FROM lp JOIN c USING (x)""", coded=True)
def split_by_address(r: Relations) -> DataFrame:
    return features.split_by_address(labelled(r.share("labelled")), 0.9, name=address).select("sg", "x", "subx", "label", "part")


@query("""WITH n AS (SELECT CAST(floor(min(c) * 0.9) AS BIGINT) AS n FROM (SELECT count(*) AS c FROM lp GROUP BY label))
SELECT sg, x, subx, label, CASE WHEN row_number() OVER (PARTITION BY label ORDER BY md5('42|' || sg || '|' || x || '|' || subx), sg, x, subx) <= n.n THEN 'train' ELSE 'test' END AS part FROM lp, n""", coded=True)
def split_balanced(r: Relations) -> DataFrame:
    return features.split_balanced(labelled(r.share("labelled")), 0.9, name=address).select("sg", "x", "subx", "label", "part")
