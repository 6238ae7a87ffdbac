"""The crawl frontier, level by level in the order of discovery, and the generators of further pages."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from . import scratch, tables


class Seen:
    """What a walk has met, by level, in a table that is bucketed by key: a level's keys are dealt to the buckets and met with
    what lies there, so what was seen before is read where it is and isn't shuffled. drop() takes the table's name away;
    its files go with the folder."""

    def __init__(self, spark: SparkSession, key: str, folder: str | None = None):
        self.spark, self.key, self.folder = spark, key, folder or scratch.path(spark, "seen")
        self.table = f"alluvium_seen_{uuid.uuid4().hex}"
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))

    def add(self, rows: DataFrame, level: int, dealt: bool = False) -> int:
        """Adds the rows, which have the key and further columns, as a level; returns their number, counted on the way. Rows
        that were just grouped by the key are dealt to the buckets already, so a task writes its own ones."""
        n = Observation()
        rows = rows.withColumn("level", F.lit(level))
        rows = (rows if dealt else rows.repartition(self.buckets, self.key)).observe(n, F.count("*").alias("n"))
        rows.write.format("parquet").partitionBy("level").bucketBy(self.buckets, self.key).option("path", self.folder).option("compression", "zstd").mode("append").saveAsTable(self.table)
        return n.get["n"]

    def rows(self, level: int | None = None) -> DataFrame:
        found = self.spark.table(self.table)
        return found if level is None else found.where(F.col("level") == level)

    def unseen(self, rows: DataFrame) -> DataFrame:
        return rows.join(self.rows().select(self.key), self.key, "left_anti")

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")


def reachable(edges: DataFrame, seeds: DataFrame, max_pages: int = -1, max_levels: int | None = None, ordered: bool = False) -> DataFrame:
    """(node, level) of all nodes reached from the seeds over (src, dst); with max_levels none beyond. Cyclic links end
    because seen nodes drop out. The result is a scan of what was written level by level, so it needs no lineage.

    With a cap, or ordered, also rank, from 1: the order of discovery, in which the first max_pages nodes stay. Seeds go by
    `place`; a node goes by the first of its parents that was discovered, and by the place of its link in it, so edges
    have a column `place` too. Of links to one node with equal places any counts.
    """
    spark, capped = edges.sparkSession, max_pages >= 0
    ordered = ordered or capped
    seen = Seen(spark, "node")
    none = F.lit(0).cast("long")
    first = seeds.select("node", none.alias("parent"), F.col("place").cast("long").alias("place")) if ordered else seeds.select("node")
    level, done, more = 0, 0, _met(first, ordered)
    while True:
        if ordered:
            more = tables.ranked(more, ["parent", "place"], "rank", start=done).select("node", "rank")
            if capped:
                more = more.where(F.col("rank") <= max_pages)
        n = seen.add(more, level, dealt=not ordered)
        done += n
        if n == 0 or (capped and done >= max_pages) or (max_levels is not None and level >= max_levels):
            break
        now = seen.rows(level)
        links = now.join(edges, now["node"] == edges["src"])
        cols = [F.col("rank").alias("parent"), F.col("place").cast("long").alias("place")] if ordered else []
        more = seen.unseen(_met(links.select(F.col("dst").alias("node"), *cols), ordered))
        level += 1
    found = seen.rows()
    seen.drop()
    names = "node long, rank long, level int" if ordered else "node long, level int"
    return spark.read.schema(names.replace("node long", f"node {found.schema['node'].dataType.simpleString()}")).parquet(seen.folder).select("node", "level", *(["rank"] if ordered else []))


def _met(rows: DataFrame, ordered: bool) -> DataFrame:
    """Each node once, with its first discovery."""
    if not ordered:
        return rows.distinct()
    return rows.groupBy("node").agg(F.min(F.struct("parent", "place")).alias("by")).select("node", "by.*")


def pages_after_first(total: Column, page: Column) -> Column:
    """Pages 2..total, from the first page only."""
    return F.when((page == 1) & (total >= 2), F.sequence(F.lit(2), total)).otherwise(F.array().cast("array<int>"))


def offsets_by_count(count: Column, skip: Column, size: int) -> Column:
    """size, 2 * size, ... below count, from the first page only."""
    return F.when((skip == 0) & (count > size), F.sequence(F.lit(size), count - 1, F.lit(size))).otherwise(F.array().cast("array<int>"))


def offset_if_full(offset: Column, got: Column, size: int) -> Column:
    return F.when(got >= size, F.array(offset + size)).otherwise(F.array().cast("array<int>"))


def speculative_offsets(offset: Column, got: Column, size: int, concurrency: int, ceiling: int) -> Column:
    """The next `concurrency` offsets of a full page, within the feed's ceiling."""
    ahead = F.transform(F.sequence(F.lit(1), F.lit(concurrency)), lambda k: offset + k * size)
    return F.when(got >= size, F.filter(ahead, lambda o: o + size <= ceiling)).otherwise(F.array().cast("array<int>"))
