"""Shared pieces: scratch tables in the cluster's checkpoint folder, word classes, packed buckets."""

from __future__ import annotations

import atexit

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import scratch

#: A word is a run of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"

_written: list[tuple[SparkSession, str]] = []


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A fresh path in the shared folder; it goes when the driver's Python ends."""
    path = scratch.path(spark, tag)
    _written.append((spark, path))
    return path


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write df to the shared folder as Parquet and read it back: cuts the lineage, and a lost executor loses nothing."""
    return written(df, scratch_path(df.sparkSession, tag))


def written(df: DataFrame, path: str) -> DataFrame:
    """df written to a scratch path and read back."""
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def delete_path(spark: SparkSession, path: str) -> None:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


@atexit.register
def _clean() -> None:
    for spark, path in _written:
        try:
            delete_path(spark, path)
        except Exception:  # noqa: BLE001  the session may have ended already
            return


def shuffle_partitions(spark: SparkSession) -> int:
    """The cluster's setting for how many parts a shuffle has; packed buckets follow it so that a bucket fits a task."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


def text_of(col: str = "text") -> Column:
    """The text, a null one as the empty string."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def keyed(docs: DataFrame, *others: str) -> DataFrame:
    """doc_id, text_key, text and the other named columns only, so that clashing names never meet.

    A document is known by (doc_id, xxhash64 of its text): rows repeated in full share the key and get the
    same result, rows that repeat only the doc_id stay apart.
    """
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(text_of()).alias("text_key"),
        text_of().alias("text"),
        *[F.col(c).alias(c) for c in others],
    )


def apart(col: str) -> Column:
    """The column as an expression of its own, so that a join on what was grouped by it deals both sides anew. Spark
    splits a join's hot key only where each side comes straight from an exchange of the join."""
    return F.when(F.col(col).isNotNull(), F.col(col))


def broadcast_if_small(df: DataFrame, rows: int, limit: int = 100_000) -> DataFrame:
    """A broadcast hint only behind a check of the size; otherwise Spark chooses at run time."""
    return F.broadcast(df) if rows <= limit else df


def each_copy(df: DataFrame, count: str, name: str, chunk: int = 1 << 16) -> DataFrame:
    """`count` rows for each row, numbered from 0 in `name`; made chunk by chunk, so no array grows with the count."""
    n, part = F.col(count), F.col("__part")
    parts = df.withColumn("__part", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((n - 1) / chunk))))
    return parts.withColumn(name, F.explode(F.sequence(part * chunk, F.least(n, (part + 1) * chunk) - 1))).drop("__part")
