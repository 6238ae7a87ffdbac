"""Scratch tables in the shared folder that the cluster names in spark.checkpoint.dir."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
_own: dict[str, str] = {}


def path(spark: SparkSession, tag: str) -> str:
    """A fresh folder; where none is named, a local run makes one of its own and any other master is an error."""
    base = spark.conf.get(CHECKPOINT_KEY, None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"{CHECKPOINT_KEY} must name a folder that the driver and all executors share")
        app = spark.sparkContext.applicationId
        if app not in _own:
            _own[app] = "file://" + tempfile.mkdtemp(prefix="alluvium-core-")
        base = _own[app]
    return f"{base.rstrip('/')}/alluvium/{spark.sparkContext.applicationId}/{tag}-{uuid.uuid4().hex}"


def written(df: DataFrame, tag: str) -> DataFrame:
    """df written to a scratch table and read again: made once, however often it is used, and kept if an executor is lost."""
    where = path(df.sparkSession, tag)
    df.write.option("compression", "zstd").parquet(where)
    return df.sparkSession.read.schema(df.schema).parquet(where)
