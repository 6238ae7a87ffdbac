"""Parquet tables of a store: appended, replaced as a whole by a new version, or grown by versions.

Claims are files that must be created exclusively. HDFS and local file systems do that; on an object store whose creation
isn't exclusive, two writers at once may both win, so loads of one source there must not overlap."""

from __future__ import annotations

import time
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import LoadError
from . import scratch

STALE_MS = 24 * 3600 * 1000


def _folder(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _folder(spark, path)
    return fs.exists(p)


def empty(spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([], schema.replace(" NOT NULL", ""))


def read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The appended table; without rows where it isn't there yet. A column that only says in which folder a row lies isn't
    part of it."""
    plain = schema.replace(" NOT NULL", "")
    if not exists(spark, path):
        return empty(spark, plain)
    return spark.read.schema(plain).parquet(path).select(*empty(spark, plain).columns)


#: Rows to a task of costly work on each row: a task's length follows from it and not from the table.
SPREAD_ROWS = 200_000


def spread(rows: DataFrame) -> DataFrame:
    """A scan of fewer splits than cores, or of larger ones than SPREAD_ROWS, dealt anew before costly work on each row; any other as it is.

    For scans and what has no shuffle in it, whose rows are counted by the files' footers. Spark can't split a file within a row
    group, and rows that lie small in a file may be long in the work."""
    cores, splits = rows.sparkSession.sparkContext.defaultParallelism, rows.rdd.getNumPartitions()
    tasks = max(cores, -(-rows.count() // SPREAD_ROWS))
    return rows.repartition(tasks) if splits < tasks else rows


def space(spark: SparkSession, store: str, source: str) -> int:
    """The number of the source's own space of ids in this store, claimed at its first use.

    A number is a file that is created exclusively and holds the source's name, so two sources never get the same one."""
    fs, folder = _folder(spark, f"{store}/spaces")
    fs.mkdirs(folder)
    jvm = spark._jvm
    while True:
        taken = sorted(int(s.getPath().getName()) for s in fs.listStatus(folder) if s.getPath().getName().isdigit())
        for n in taken:
            stream = fs.open(jvm.org.apache.hadoop.fs.Path(folder, str(n)))
            try:
                name = jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
            finally:
                stream.close()
            if name == source:
                return n
        n = taken[-1] + 1 if taken else 0
        try:
            out = fs.create(jvm.org.apache.hadoop.fs.Path(folder, str(n)), False)
        except Py4JJavaError:
            if not exists(spark, f"{store}/spaces/{n}"):
                raise
            continue  # another source was faster
        try:
            out.write(bytearray(source.encode()))
        finally:
            out.close()


def _versions(spark: SparkSession, path: str) -> list[int]:
    fs, p = _folder(spark, path)
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    whole = [n for n in names if n.startswith("v") and n[1:].isdigit() and exists(spark, f"{path}/{n}/_SUCCESS")]
    return sorted(int(n[1:]) for n in whole)


def version(spark: SparkSession, path: str) -> int:
    """The number of the table's last whole version, 0 if it has none."""
    return max(_versions(spark, path), default=0)


def current(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The last whole version of a replaced table."""
    found = _versions(spark, path)
    return spark.read.schema(schema.replace(" NOT NULL", "")).parquet(f"{path}/v{found[-1]}") if found else empty(spark, schema)


def all_versions(spark: SparkSession, path: str, schema: str, after: int = 0) -> DataFrame:
    """All rows of a table that grows by versions, or those of the versions after a number."""
    found = [n for n in _versions(spark, path) if n > after]
    return spark.read.schema(schema.replace(" NOT NULL", "")).parquet(*[f"{path}/v{n}" for n in found]) if found else empty(spark, schema)


#: Of a table that is about to be published: rule, rows, for each rule how many rows break it.
Check = Callable[[DataFrame], DataFrame]


def add_version(rows: DataFrame, path: str, base: int, check: Check | None = None) -> None:
    """Writes rows as the version after `base`, the one that the caller has read. Whoever comes second, having read the
    same one, fails and changes nothing: the version's claim is a file that is created exclusively. A claim that a dead
    writer left counts for STALE_MS.

    With a check the rows are written aside, where no reader looks, and checked there; a version that breaks a rule is an
    error that names the rules, and the version before stays the current one. A whole one takes its place by one rename."""
    spark = rows.sparkSession
    fs, folder = _folder(spark, path)
    fs.mkdirs(folder)
    claim = spark._jvm.org.apache.hadoop.fs.Path(folder, f"_claim-v{base + 1}")
    if version(spark, path) != base:
        raise LoadError(f"{path}: another run has written since version {base} was read")
    if fs.exists(claim) and fs.getFileStatus(claim).getModificationTime() < time.time() * 1000 - STALE_MS:
        fs.delete(claim, False)
    if not fs.createNewFile(claim):
        raise LoadError(f"{path}: another run is writing version {base + 1}")
    try:
        if version(spark, path) != base:
            raise LoadError(f"{path}: another run has written since version {base} was read")
        if check is None:
            rows.write.mode("overwrite").option("compression", "zstd").parquet(f"{path}/v{base + 1}")
        else:
            _checked(rows, path, base + 1, check)
    finally:
        fs.delete(claim, False)


def _checked(rows: DataFrame, path: str, number: int, check: Check) -> None:
    spark, aside = rows.sparkSession, f"{path}/_aside-v{number}"
    fs, at = _folder(spark, aside)
    rows.write.mode("overwrite").option("compression", "zstd").parquet(aside)
    try:
        broken = check(spark.read.schema(rows.schema).parquet(aside)).where("rows > 0").collect()  # a row a rule
        if broken:
            raise LoadError(f"{path}: version {number} isn't published: " + ", ".join(f"{r['rule']} ({r['rows']} rows)" for r in broken))
        to = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/v{number}")
        fs.delete(to, True)  # what a dead writer left without its mark
        if not fs.rename(at, to):
            raise LoadError(f"{path}: version {number} can't be put in its place")
    finally:
        fs.delete(at, True)


def replace(rows: DataFrame, path: str, base: int, keep: int = 2, check: Check | None = None) -> None:
    """Writes the next version beside the others, so rows may come from the current one; old versions go."""
    spark = rows.sparkSession
    add_version(rows, path, base, check)
    fs, _ = _folder(spark, path)
    for old in _versions(spark, path)[:-keep]:
        fs.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/v{old}"), True)


def new_batch(spark: SparkSession, path: str) -> int:
    """A number that no other writer of the table gets: a file that is created exclusively."""
    fs, folder = _folder(spark, f"{path}/_batches")
    fs.mkdirs(folder)
    while True:
        n = max([int(s.getPath().getName()) for s in fs.listStatus(folder) if s.getPath().getName().isdigit()], default=-1) + 1
        if fs.createNewFile(spark._jvm.org.apache.hadoop.fs.Path(folder, str(n))):
            return n


def whole_batches(spark: SparkSession, path: str) -> list[int]:
    """The batches of the table that were written to their end."""
    fs, p = _folder(spark, path)
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    return sorted(int(n[6:]) for n in names if n.startswith("batch=") and n[6:].isdigit() and exists(spark, f"{path}/{n}/_SUCCESS"))


def parts(spark: SparkSession, path: str) -> list[str]:
    """The folders of a table that is kept by source."""
    fs, p = _folder(spark, path)
    return sorted(s.getPath().toString() for s in fs.listStatus(p) if s.isDirectory()) if fs.exists(p) else []


def numbered(rows: DataFrame, by: list[str], name: str, start: Column | None = None, buckets: int | None = None) -> DataFrame:
    """Rows with numbers after `start`, gapless: numbered within hash buckets of `by`, each bucket after those before it,
    so no task holds all rows. `by` must name rows uniquely for reruns to agree. rows are read twice, so costly ones should be
    written before. Buckets follow the cluster's number of shuffle partitions, 256 at least."""
    buckets = buckets or max(256, 4 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))
    dealt = rows.withColumn("_bucket", F.pmod(F.xxhash64(*by), F.lit(buckets)))
    sizes = dealt.groupBy("_bucket").count().selectExpr("_bucket", "coalesce(sum(count) OVER (ORDER BY _bucket ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS _before")
    nth = F.expr(f"row_number() OVER (PARTITION BY _bucket ORDER BY {', '.join(by)})")
    number = F.col("_before") + F.col("_nth") + (start if start is not None else F.lit(0))
    return dealt.withColumn("_nth", nth).join(F.broadcast(sizes), "_bucket").withColumn(name, number.cast("bigint")).drop("_bucket", "_nth", "_before")


def ranked(rows: DataFrame, by: list[str], name: str, start: int = 0) -> DataFrame:
    """Rows numbered after `start`, gapless, in the order of `by`: range-sorted and written once, then each sorted part goes on
    from the rows of the parts before it, of which the driver gets one number a part. `by` must name rows uniquely for
    reruns to agree."""
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    dealt = rows.repartitionByRange(parts, *by).sortWithinPartitions(*by)
    placed = scratch.written(dealt.withColumns({"_part": F.spark_partition_id(), "_nth": F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)}), "ranked")
    before, found = start, {}
    for r in sorted(placed.groupBy("_part").count().collect()):
        found[r["_part"]] = before
        before += r["count"]
    if not found:
        return placed.withColumn(name, F.lit(0).cast("bigint")).drop("_part", "_nth")
    offset = F.create_map(*[F.lit(x) for k, v in found.items() for x in (k, v)])[F.col("_part")]
    return placed.withColumn(name, (offset + F.col("_nth") + 1).cast("bigint")).drop("_part", "_nth")
