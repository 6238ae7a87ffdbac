"""Connected components of an edge table by alternating large and small stars, in DataFrame joins.

No neighbourhood is gathered: a node's least neighbour is a partial aggregate, dealt anew for the join with the edges,
so that Spark can split a hub's edges over tasks. Every round is written to the shared folder, so the lineage stays short and a lost executor loses nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import apart, delete_path, scratch_path, written


def _large(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(apart("u").alias("w"), F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, F.col("u") == F.col("w")).select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m")).select(apart("u").alias("w"), "m")
    joined = edges.join(least, F.col("u") == F.col("w"))
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").unionByName(least.select(F.col("w").alias("u"), F.col("m").alias("v")))


def components(edges: DataFrame, tag: str = "components") -> DataFrame:
    """(u, v), any order and repeats -> (node, root): every node that has an edge to another, and the least node of
    its component; the root itself is left out."""
    ends = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    spark = edges.sparkSession
    path, mark = scratch_path(spark, tag), None
    now = written(ends, path)
    while True:
        before, path = path, scratch_path(spark, tag)
        now = written(_small(_large(now).distinct()).distinct(), path)
        delete_path(spark, before)  # nothing reads the round before any more
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen[0] == 0 or tuple(seen) == mark:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = tuple(seen)
