"""Connected components of a table of links by alternating stars, without gathering any neighbourhood."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hammerprice.llm.columns import written


def _least(edges: DataFrame) -> DataFrame:
    """Each node's least neighbour, itself included; a written table, so that a join with a hub can be split."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    return written(least.select("u", F.least("u", "m").alias("m")), "least")


def _large_star(edges: DataFrame) -> DataFrame:
    both = written(edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))), "edges")
    linked = both.join(_least(both), "u").where("v > u")
    return linked.select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = written(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    least = _least(down)
    linked = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return linked.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(links: DataFrame, left: str, right: str) -> DataFrame:
    """`node` and `component` (least node reachable) of every node that has a link to another one."""
    edges = links.select(F.col(left).cast("long").alias("u"), F.col(right).cast("long").alias("v")).where("u <> v")
    edges = written(edges.distinct(), "edges")
    before, state = None, _state(edges)
    while state != before and state[0]:
        edges = written(_small_star(_large_star(edges)), "stars")
        before, state = state, _state(edges)
    leaves = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return leaves.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
