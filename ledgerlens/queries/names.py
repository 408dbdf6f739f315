"""Names of addresses."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..fixtures import Relations, concat, wallet_of
from ..operators import names
from .graph import vertices
from .registry import query


@query("""WITH g AS (SELECT node, max(name) AS name, max(block_number) AS block_number FROM nev WHERE event_type = 'NAMEREGISTERED' GROUP BY node),
c AS (SELECT node, max(name) AS name, arg_max(new_address, block_number) AS new_address, max(block_number) AS block_number FROM nev WHERE event_type = 'ADDRESSCHANGED' GROUP BY node)
SELECT node, CASE WHEN g.block_number IS NOT NULL THEN 'registered' ELSE 'leftover' END AS kind, coalesce(g.name, c.name) AS name, c.new_address,
  greatest(g.block_number, c.block_number) AS block_number FROM g FULL JOIN c USING (node)""")
def ens_merge(r: Relations) -> DataFrame:
    return names.merge_events(r.name_events())


@query("""SELECT a.node, a.block_number AS claimed_at, min(b.block_number) AS named_at FROM nev a JOIN nev b ON a.node = b.node AND b.block_number > a.block_number
WHERE a.event_type = 'REVERSECLAIMED' AND b.event_type = 'RVERSENAMESET' GROUP BY ALL""")
def ens_reverse(r: Relations) -> DataFrame:
    return names.reverse_records(r.name_events())


_REGISTERED = "(SELECT DISTINCT 'c' || substr(node, 2) AS wallet, name FROM nev WHERE event_type = 'NAMEREGISTERED')"


def registered(r: Relations) -> DataFrame:
    return r.name_events().where("event_type = 'NAMEREGISTERED'").select(concat("c", F.substring("node", 2, 20)).alias("wallet"), "name").distinct()


@query(f"SELECT v.address, 'first,' || n.name AS names FROM vert v JOIN {_REGISTERED} n ON regexp_replace(v.address, 'm[0-9]{{6}}$', '') = n.wallet")
def ens_enrich(r: Relations) -> DataFrame:
    """A wallet's name holds in every month in which the wallet occurs."""
    held = vertices(r).select("address", wallet_of("address").alias("wallet"), F.array(F.lit("first")).alias("names"))
    return names.enrich(held, registered(r), "wallet").select("address", F.array_join("names", ",").alias("names"))


@query(f"SELECT v.address, 'first' AS names, n.name IS NOT NULL AS had_name FROM vert v LEFT JOIN {_REGISTERED} n ON regexp_replace(v.address, 'm[0-9]{{6}}$', '') = n.wallet")
def ens_forget(r: Relations) -> DataFrame:
    """What enriching has added is gone again, and nothing else."""
    held = vertices(r).select("address", wallet_of("address").alias("wallet"), F.array(F.lit("first")).alias("names"))
    named = held.drop("names").join(registered(r), "wallet", "left").withColumn("names", F.when(F.col("name").isNotNull(), F.array(F.lit("first"), F.col("name"))).otherwise(F.array(F.lit("first"))))
    left = names.forget(named.withColumnRenamed("name", "had"), registered(r), "wallet")
    return left.select("address", F.array_join("names", ",").alias("names"), F.col("had").isNotNull().alias("had_name"))


@query()
def ens_namehash(r: Relations) -> DataFrame:
    return names.with_namehash(r.name_events().select("name").distinct())
