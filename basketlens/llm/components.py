"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.session import stored


def connected(edges: DataFrame, name: str = "components", most_rounds: int = 60) -> DataFrame:
    """(node, component) for the nodes of ``edges`` (a, b); the component is its smallest node.

    A large-star step hangs every larger neighbour of a node on the smallest one of its
    neighbourhood, a small-star step every smaller neighbour and the node itself; repeated in turn, every
    component becomes a star around its smallest node in a few rounds. A node's minimum is
    a partial aggregate and is joined back from a table, so that a hub with any number of
    neighbours is no single task's group and its rows can be split in the join.

    Self-edges and repeated edges are harmless; edges with a null end are left out. No edges give no rows.
    """
    known = edges.where("a is not null and b is not null and a <> b")
    links = stored(known.select(F.greatest("a", "b").alias("child"), F.least("a", "b").alias("parent")).distinct(), name)
    if links.isEmpty():
        return links.select(F.col("child").alias("node"), F.col("parent").alias("component"))
    state = None
    for _ in range(most_rounds):
        both = links.select(F.col("child").alias("node"), F.col("parent").alias("other")).union(
            links.select(F.col("parent").alias("node"), F.col("child").alias("other"))
        )
        lowest = both.groupBy("node").agg(F.least(F.min("other"), F.min("node")).alias("low"))
        lowest = stored(lowest, name)
        large = stored(
            links.join(lowest, F.col("parent") == F.col("node")).select("child", F.col("low").alias("parent")).distinct(), name
        )
        lowest = stored(large.groupBy("child").agg(F.min("parent").alias("low")), name)
        hung = large.join(lowest.withColumnRenamed("child", "node"), F.col("child") == F.col("node"))
        small = hung.where("parent <> low").select(F.col("parent").alias("child"), F.col("low").alias("parent"))
        links = stored(small.union(lowest.select("child", F.col("low").alias("parent"))).distinct(), name)
        before, state = state, links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("child", "parent"))).first()
        if state == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    roots = links.select("parent").distinct()
    return links.select(F.col("child").alias("node"), F.col("parent").alias("component")).union(
        roots.select(F.col("parent").alias("node"), F.col("parent").alias("component"))
    )
