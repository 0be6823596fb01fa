"""Connected components of an edge table, by joins and minima only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart.llm.storage import materialize


def components(edges: DataFrame) -> DataFrame:
    """node and component (the least node reachable) of every node of ``edges`` (a, b: long).

    Rounds of two steps: every node links its greater neighbours to the least
    node it knows, then itself and its lesser neighbours. The edges end as stars
    around the least nodes. No neighbour list is ever gathered; a node with very
    many edges is only a minimum and a join, which may be split.
    """

    def state(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    def large(e: DataFrame) -> DataFrame:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        return both.join(least, "a").where("b > a and b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()

    def small(e: DataFrame) -> DataFrame:
        down = e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        linked = down.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        return linked.unionByName(least.select("a", F.col("m").alias("b"))).distinct()

    current = materialize(edges.select("a", "b").where("a <> b").distinct(), "components")
    before = None
    now = state(current)
    while now != before and now[0]:
        before = now
        current = materialize(small(large(current)), "components")
        now = state(current)
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
