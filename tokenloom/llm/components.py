"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed


def components(edges: DataFrame) -> DataFrame:
    """node, root: each node of the edges (a, b) with the least node of its component.

    Every round replaces the edges by stars around smaller nodes, written to the
    shared folder, until a round changes nothing; edges to a root stay.
    """
    stars = checkpointed(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    mark = _mark(stars)
    while True:
        both = stars.unionByName(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.unionByName(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()
        small = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(small, "a")
        stars = checkpointed(
            joined.select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(small.select("a", F.col("m").alias("b"))).where("a <> b").distinct()
        )
        before, mark = mark, _mark(stars)
        if before == mark:
            break
    roots = stars.select("b").distinct()
    return stars.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        roots.select(F.col("b").alias("node"), F.col("b").alias("root"))
    )


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())
