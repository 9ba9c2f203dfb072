"""Connected components of an edge list, by joins that stay proportional to it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.session import reliable_checkpoint


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """One star step over ``(a, b)`` with ``a > b``: each node hands its smallest
    neighbour (itself included) to its larger or to its smaller neighbours.

    The smallest neighbour is aggregated in every task before the shuffle, and
    the join is between plain shuffles, so that hub nodes can be split.
    """
    both = edges if not larger else edges.union(edges.select(F.col("b"), F.col("a"))).toDF("a", "b")
    least = both.groupBy(F.col("a").alias("n")).agg(F.least(F.min("b"), F.first("a")).alias("m"))
    met = both.join(least, (F.col("a") == F.col("n")) & (F.xxhash64("a") == F.xxhash64("n")))
    if larger:
        moved = met.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        moved = met.select(F.col("b").alias("a"), F.col("m").alias("b")).union(
            least.select("n", "m")
        )
    return moved.where("a > b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node with an edge ``(a, b)``; the component
    is its smallest node.

    Large-star and small-star steps alternate until every node points at the
    root of its component: O(log^2 n) rounds in theory, three or four here.
    Each round is a stored table, so a lost executor costs no more than a
    round. Self loops and NULL ends are dropped; no edges give no rows.
    """
    current = reliable_checkpoint(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .where("a > b")
        .distinct()
    )
    while True:
        grown = reliable_checkpoint(_star(_star(current, True), False))
        if grown.exceptAll(current).isEmpty() and current.exceptAll(grown).isEmpty():
            break
        current = grown
    roots = grown.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return grown.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
