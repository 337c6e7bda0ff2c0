"""Connected components by alternating large and small stars, in joins and grouped minima.

No neighbourhood is collected: each round a node learns the least of its neighbours by an aggregate, and its edges are
moved there by a join, which Spark may split where a node has very many edges. Rounds are cut by checkpoints.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.operators.joins import settled


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def components(edges: DataFrame) -> DataFrame:
    """`edges` (a, b) of longs, in any direction, repeats and loops allowed: (node, root), root the least node reached.

    Only nodes with an edge to another node have a row.
    """
    edges = settled(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = _state(edges)
    while state[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # settled first: Spark splits a node with very many edges only where both sides of a join come from an exchange
        least = settled(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")))
        # every larger neighbour moves to the least one
        large = edges.select(F.col("b").alias("a"), F.col("a").alias("far")).join(least, "a").select(F.col("far").alias("a"), F.col("m").alias("b")).distinct()
        large = settled(large)
        # every node, and its smaller neighbours, move to the least of these
        least = settled(large.groupBy("a").agg(F.min("b").alias("m")))
        moved = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        small = settled(moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct())
        before, state = state, _state(small)
        edges = small
        if state == before:
            break
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
