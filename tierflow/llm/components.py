"""Connected components of a graph given by edges, as iterated joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.llm.common import discard, stored


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for each node of ``edges`` (a, b): the smallest node that
    can be reached.

    Alternates two steps until nothing changes, which takes a number of rounds
    logarithmic in the size of a component: each node links its larger neighbours
    to its smallest neighbour, then each node links its smaller neighbours to the
    smallest of them. The smallest neighbour is a pre-aggregated minimum, and the
    join that hands it out is one that adaptive execution can split, so a node
    with very many neighbours does not end up in one task. Each round is stored
    in the shared folder. Loops, repeated edges and either direction are allowed;
    edges with a null end are ignored.
    """
    larger, smaller = F.greatest("a", "b"), F.least("a", "b")
    proper = edges.filter("a <> b").select(larger.alias("a"), smaller.alias("b")).distinct()
    current = stored(proper, "components")
    state = _state(current)
    while state[0]:
        following = stored(_small_star(_large_star(current)), "components")
        changed = _state(following)
        discard(current)
        current = following
        if changed == state:
            break
        state = changed
    stars = current.groupBy("a").agg(F.min("b").alias("component")).withColumnRenamed("a", "node")
    centres = current.select(F.col("b").alias("node")).distinct()
    return stars.unionByName(centres.withColumn("component", F.col("node")))


def _state(edges: DataFrame) -> tuple:
    """Number of edges and a sum that tells edge sets apart."""
    mixed = F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))
    return tuple(edges.agg(F.count(F.lit(1)), mixed).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    linked = both.filter("b > a").join(least, "a")
    return linked.select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    moved = edges.join(least, "a").filter("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.unionByName(least.select("a", F.col("least").alias("b"))).distinct()
