"""Connected components of a link table, by alternating large-star and small-star steps.

Every step is a pre-aggregated minimum per node and a join back on the node;
no node's links are gathered in one place. Each round is written to the shared
folder, so lineage stays short and a lost executor costs one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.stage import written


def _least(links: DataFrame) -> DataFrame:
    """(u, v, m): each link with the smallest neighbour of u."""
    return links.join(links.groupBy("u").agg(F.min("v").alias("m")), "u")


def components(spark: SparkSession, links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of ``links``; root is the smallest node of its component.

    Links may repeat and run either way; links of a node with itself and nulls are ignored.
    """
    ends = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u > v").distinct()
    state, seen = written(spark, ends, "links"), None
    while True:
        both = state.unionByName(state.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _least(both).where("v > u").select(F.col("v").alias("u"), F.least("m", "u").alias("v")).distinct()
        small = _least(large)
        small = small.select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                                               F.struct("u", F.col("m").alias("v")))).alias("e")).select("e.*")
        state = written(spark, small.where("u > v").distinct(), "links")
        now = state.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1_000_003), F.sum(F.xxhash64("v", "u") % 999_983)).first()
        if now == seen:
            break
        seen = now
    rooted = state.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return rooted.unionByName(state.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
