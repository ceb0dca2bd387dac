"""Connected components of a stored graph, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import materialize


def _print(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _with_least(edges: DataFrame) -> DataFrame:
    """Each edge (u, v) with ``m``, the least of u and all neighbours that the edges give it."""
    least = edges.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return edges.join(least, "u")


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``root`` for every node of the edges (``u``, ``v``); the root is the component's least node.

    Each round points a node's larger neighbours at its least one (large star),
    then its smaller ones (small star), and stores the edges, so a lost executor
    costs one round. Least values are combined before the shuffle and rows meet
    them in a join whose hot keys adaptive execution can split; no neighbourhood
    is ever gathered. Rounds end when the edges no longer change, after about
    log(n) of them. Loops and repeated edges change nothing; without edges there are no rows.
    """
    now = materialize(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    seen = _print(now)
    while seen[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _with_least(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        starred = _with_least(large.filter("u > v"))
        small = starred.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            starred.select("u", F.col("m").alias("v"))).distinct()
        now = materialize(small, "edges")
        before, seen = seen, _print(now)
        if seen == before:
            break
    roots = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
