"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultline.session import materialize


def _star(pairs: DataFrame) -> DataFrame:
    """(n, m): every neighbour of a node and the node's smallest neighbour."""
    least = pairs.groupBy("a").agg(F.min("b").alias("m"))
    return pairs.join(least, "a")


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``edges(a, b)`` -> ``(node, root)`` with the smallest node of each component.

    Nodes without an edge do not appear. Self loops, repeated and reversed edges are
    allowed; rows with a null end are ignored. Each round is written to the shared
    folder, so a lost executor costs one round. Minima are combined before the shuffle.
    """
    ends = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    state = materialize(ends.distinct(), name)
    before = None
    while True:
        mark = state.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark[0] == 0 or mark == before:
            return state.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                state.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        before = mark
        both = state.unionByName(state.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = (_star(both).where("b > a")
                 .select(F.col("b").alias("a"), F.least("a", "m").alias("b")).where("a <> b").distinct())
        large = materialize(large, name)
        small = _star(large).select(F.explode(F.array(F.struct("a", F.col("m").alias("b")),
                                                      F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("p"))
        state = materialize(small.select("p.a", "p.b").where("a <> b").distinct(), name)
