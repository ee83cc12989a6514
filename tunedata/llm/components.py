"""Connected components of an edge table by alternating large and small stars.

Every step is a join with a per-node minimum and a distinct, so no node's
neighbours are gathered in one place. Minima are pre-aggregated before the
shuffle; in the join a node's edges are dealt over ``SALTS`` tasks, and since
both sides are plain shuffles, AQE splits a node with very many edges further.
Each round is cut from its lineage by a checkpoint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunedata.session import materialize


# Tasks over which the edges of one node are dealt in a join.
SALTS = 4


def salted_join(rows: DataFrame, per_key: DataFrame, key: str, spread: str) -> DataFrame:
    """``rows`` joined with ``per_key`` (one row a key) on ``key``; the rows of one key are dealt by
    ``spread`` over SALTS tasks."""
    salt = F.pmod(F.xxhash64(spread), F.lit(SALTS)).cast("int")
    each = F.explode(F.array(*[F.lit(i) for i in range(SALTS)]))
    return rows.withColumn("_salt", salt).join(per_key.withColumn("_salt", each), [key, "_salt"]).drop("_salt")


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``node, component`` for every node of ``edges`` (``u, v`` of one type; direction,
    repeats, loops and rows with nulls do not matter); ``component`` is the smallest node
    that can be reached. Nodes that only have loops are left out, an empty table gives
    no rows."""
    e = materialize(edges.select("u", "v").filter("u <> v").distinct())
    before = _signature(e)
    for _ in range(max_rounds):
        if not before[0]:
            return e.select(F.col("u").alias("node"), F.col("v").alias("component"))
        both = e.union(e.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (salted_join(both, least, "u", "v").filter("v > u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (salted_join(large, low, "u", "v")
                 .select(F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")),
                                           F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
                 .select("e.*").filter("u <> v").distinct())
        e = materialize(small)
        after = _signature(e)
        if after == before:
            stars = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
            return stars.union(stars.select("component", "component").distinct())
        before = after
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
