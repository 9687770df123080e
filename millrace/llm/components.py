"""Connected components of a graph given by its edges, as repeated joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from millrace.llm.common import keep


def _smallest(edges: DataFrame) -> DataFrame:
    """``u, low``: the smallest of a node and its neighbours ``v``."""
    return edges.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("low"))


def _hang(edges: DataFrame) -> DataFrame:
    """Hang the neighbours ``v`` of each ``u`` and ``u`` itself on the smallest of them."""
    low = _smallest(edges).withColumnRenamed("u", "w")
    met = edges.join(low, edges["u"] == low["w"])
    return met.select(F.explode(F.array(
        F.struct(F.col("v").alias("u"), F.col("low").alias("v")),
        F.struct(F.col("u"), F.col("low").alias("v")),
    )).alias("e")).select("e.*").filter("u <> v").distinct()


def _hang_larger(edges: DataFrame) -> DataFrame:
    """Hang the larger neighbours of each node on the smallest node around it."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = _smallest(both).withColumnRenamed("u", "w")
    met = both.join(low, both["u"] == low["w"]).filter("v > u")
    return met.select(F.col("v").alias("u"), F.col("low").alias("v")).filter("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` of all nodes but the smallest of each component.

    ``edges`` has two columns of numbers. Steps hang larger neighbours and then smaller ones
    on the smallest node in sight until every node hangs on the smallest of its component; a
    hub's edges are rows of a join, not a group in memory.
    """
    a, b = edges.columns
    now = keep(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
               .filter("u <> v").distinct(), "edges")
    mark = _mark(now)
    while True:
        now = keep(_hang(_hang_larger(now)), "edges")
        last, mark = mark, _mark(now)
        if mark == last:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component"))


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(
        F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u"))
    ).first())
