"""Table operators: equality scan, append with defaults, upserts, incremental scans, snapshots and dead letters."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.url import request_key
from . import tables


def fetch(table: DataFrame, **filters) -> DataFrame:
    """Rows equal to all filters; None asks for null."""
    return table.where(reduce(lambda a, kv: a & F.col(kv[0]).eqNullSafe(F.lit(kv[1])), filters.items(), F.lit(True)))


def with_defaults(rows: DataFrame, defaults: dict[str, Column]) -> DataFrame:
    """Defaults fill the columns that no row of the batch sets; where some row does, the nulls of the others stay."""
    there = [c for c in defaults if c in rows.columns]
    unset = {c for c in defaults if c not in there}
    if there:
        held = rows.agg(*[F.count(c).alias(f"n{i}") for i, c in enumerate(there)]).first()
        unset |= {c for i, c in enumerate(there) if held[i] == 0}
    return rows.withColumns({c: defaults[c] for c in defaults if c in unset})


# Fixed value: the characters that stand escaped in the name of a partition's folder.
_ESCAPED = frozenset("\"#%'*/:=?\\{[]^" + "".join(map(chr, range(1, 32))) + "\x7f")


def source_folder(path: str, source: str) -> str:
    """The folder of one source's rows, named as Spark names a partition's."""
    return f"{path}/source=" + "".join(f"%{ord(c):02X}" if c in _ESCAPED else c for c in source)


def append(rows: DataFrame, path: str, defaults: dict[str, Column] | None = None, source: str | None = None) -> None:
    """Adds rows to a table. Those of one source go to the source's own folder, so sources may be written at once."""
    rows = with_defaults(rows, defaults or {})
    if source is not None:
        rows, path = rows.drop("source"), source_folder(path, source)
    rows.write.mode("append").option("compression", "zstd").parquet(path)


def append_batch(rows: DataFrame, path: str, source: str) -> int:
    """Adds rows of one source as a batch of their own, so that later work may read what is new by its folder; returns the
    batch's number. A batch counts once it is whole."""
    where = source_folder(path, source)
    n = tables.new_batch(rows.sparkSession, where)
    rows.drop("source").write.option("compression", "zstd").parquet(f"{where}/batch={n}")
    return n


def upsert_update(table: DataFrame, rows: DataFrame, keys: list[str], update: list[str]) -> DataFrame:
    """The table after DO UPDATE: `update` columns from rows, the others of existing rows kept, new rows added.

    A key on several of the rows is an error when the result is made, as one statement can't change a row twice. A key
    with a null never meets another and is added."""
    whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    one = rows.where(whole).groupBy(*keys).agg(F.count("*").alias("_n"), F.first(F.struct(*rows.columns)).alias("_row"))
    twice = F.raise_error(F.concat(F.lit("upsert: several rows with key "), F.to_json(F.struct(*keys))))
    once = one.select(F.when(F.col("_n") > 1, twice.cast(one.schema["_row"].dataType)).otherwise(F.col("_row")).alias("_row")).select("_row.*")
    t = table.withColumn("_known", F.lit(True)).alias("t")
    r = once.unionByName(rows.where(~whole)).withColumn("_fresh", F.lit(True)).alias("r")
    both = t.join(r, reduce(lambda a, b: a & b, [F.col(f"t.{k}") == F.col(f"r.{k}") for k in keys]), "full_outer")
    fresh, known = F.col("r._fresh").isNotNull(), F.col("t._known").isNotNull()
    out = []
    for c in table.columns:
        if c in keys:
            out.append(F.coalesce(F.col(f"t.{c}"), F.col(f"r.{c}")).alias(c))
        elif c in update:
            out.append(F.when(fresh, F.col(f"r.{c}")).otherwise(F.col(f"t.{c}")).alias(c))
        else:
            out.append(F.when(known, F.col(f"t.{c}")).otherwise(F.col(f"r.{c}")).alias(c))
    return both.select(*out)


def upsert_nothing(table: DataFrame, rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The table after DO NOTHING: existing rows win; of new rows with one key the first by `order`."""
    first = rows.groupBy(*keys).agg(F.min_by(F.struct(*rows.columns), F.struct(*order)).alias("row")).select("row.*")
    return table.unionByName(first.join(table.select(*keys), keys, "left_anti").select(*table.columns))


def unparsed(bronze: DataFrame, silver: DataFrame, source: str) -> DataFrame:
    """Snapshots of the source that no silver row of the source comes from."""
    done = silver.where(F.col("source") == source).select(F.col("bronze_id").alias("id")).distinct()
    return bronze.where(F.col("source") == source).join(done, "id", "left_anti")


def visited(bronze: DataFrame, source: str, cutoff: Column) -> DataFrame:
    """Distinct requests of the source that succeeded since the cutoff; null parameters as none."""
    found = bronze.where((F.col("source") == source) & (F.col("created_at") >= cutoff) & F.col("status_code").between(200, 299))
    params = F.coalesce("request_params", F.create_map().cast("map<string,string>"))
    rows = found.select("request_url", params.alias("request_params"))
    return rows.withColumn("key", request_key(F.col("request_url"), F.col("request_params"))).dropDuplicates(["key"]).drop("key")


def route(status: Column, persistable: Column, model: str) -> Column:
    """Where a response goes: nowhere (null) if it isn't worth keeping, whatever its status; else its table or, if it
    failed, the dead letters."""
    return F.when(~persistable, F.lit(None)).when(status.between(200, 299), F.lit(model)).otherwise(F.lit("failed"))


def backfilled(headers: Column, name: str) -> Column:
    """A column filled from a stored header; empty where there is none."""
    return F.coalesce(F.try_element_at(headers, F.lit(name)), F.lit(""))
