"""Connected components of an edge table by alternating large-star and small-star steps.

Each step is a grouped minimum (combined before the shuffle) and a join back, so a node with any
number of neighbours costs no task more than its share; the edges are written to the shared
folder after each round. No edge, node or component passes through the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martwright.llm.common import written


def components(edges: DataFrame) -> DataFrame:
    """Rows (node, root) for every node of the edges (a, b); root is the component's least node."""
    now = written(_downward(edges.select(F.col("a").alias("u"), F.col("b").alias("v"))), "edges")
    before = None
    while (mark := _fingerprint(now)) != before:
        before = mark
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = _downward(
            both.filter(F.col("v") > F.col("u")).join(least, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
        )
        large = written(large, "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        hooked = large.join(least, "u").filter(F.col("v") > F.col("m"))
        now = written(
            _downward(
                hooked.select(F.col("v").alias("u"), F.col("m").alias("v"))
                .unionByName(least.select("u", F.col("m").alias("v")))
            ),
            "small-star",
        )
    roots = now.select(F.col("v").alias("node")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        roots.withColumn("root", F.col("node"))
    )


def _downward(edges: DataFrame) -> DataFrame:
    """Each edge once, from the larger to the smaller node."""
    return (
        edges.filter(F.col("u") != F.col("v"))
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct()
    )


def _fingerprint(edges: DataFrame) -> tuple:
    """Number of edges and a sum over their hashes: equal when nothing changed."""
    mixed = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    return tuple(edges.agg(F.count("*"), mixed).first())
