"""Connected components by alternating large and small stars, each round a written table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carespark.llm.common import write_stage


def _summary(edges: DataFrame) -> tuple:
    r = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
    return r[0], r[1]


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); root is the smallest node of its component.

    Edges with a null end or equal ends are left out; repeated edges count once.
    Each round joins edges to the least neighbour of their ends: a hub's edges
    split like any skewed join side, its minimum is combined before the shuffle."""
    e = edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    e = write_stage(e, "edges")
    before = _summary(e)
    while before[0]:
        both = e.unionAll(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = write_stage(large, "large-star")
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        e = write_stage(small.unionAll(low.select("a", F.col("m").alias("b"))).distinct(), "small-star")
        now = _summary(e)
        if now == before:
            break
        before = now
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(
        e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
