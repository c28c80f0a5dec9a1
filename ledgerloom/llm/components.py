"""Connected components of links, by alternating large-star and small-star steps."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def written(df: DataFrame, folder: str, name: str) -> DataFrame:
    """``df`` written below ``folder``, which all executors share, and read back: its plan ends there."""
    path = f"{folder}/{name}-{uuid.uuid4().hex[:8]}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _largest_first(edges: DataFrame) -> DataFrame:
    return edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return row[0], row[1] or 0


def components(spark: SparkSession, edges: DataFrame, folder: str) -> DataFrame:
    """(node, component) of every node of ``edges (u bigint, v bigint)``; component is the smallest node reachable.

    Each step points nodes at the smallest node they know of. Stars turn into forests of small depth, so the
    steps grow with the logarithm of the longest chain; each one is written to ``folder``. Edges without links
    between different nodes give no rows.
    """
    edges = written(_largest_first(edges), folder, "edges")
    state = _state(edges)
    while True:
        # Large star: all greater neighbours of a node move to the least node among it and its neighbours.
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # The least neighbours are written: read back, they meet the edges in a join whose sides Spark can split,
        # and the edges of one hub are not one task's work.
        least = written(both.groupBy("u").agg(F.min("v").alias("least")).select("u", F.least("u", "least").alias("least")),
                        folder, "least")
        moved = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("least").alias("v"))
        large = written(_largest_first(moved), folder, "large")
        # Small star: a node and its smaller neighbours move to the least of them.
        least = large.groupBy("u").agg(F.min("v").alias("least"))
        moved = large.join(least, "u").select(F.col("v").alias("u"), F.col("least").alias("v"))
        edges = written(_largest_first(moved.unionByName(least.select("u", F.col("least").alias("v")))),
                        folder, "small")
        now = _state(edges)
        if now == state:
            break
        state = now
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
