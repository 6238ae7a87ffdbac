"""Constraints of tables as queries: Spark enforces none, so what breaks one is counted."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def required(schema: str) -> list[str]:
    """The columns that a schema in DDL declares NOT NULL."""
    return re.findall(r"(?:^|,\s*)(\w+) [A-Z][A-Z_<>,()0-9]* NOT NULL", schema)


def broken(table: DataFrame, not_null: list[str] = [], unique: list[list[str]] = [], references: list[tuple[str, DataFrame, str]] = []) -> DataFrame:  # noqa: B006
    """rule, rows: for each constraint how many rows break it.

    Of rows with equal unique keys all but one break the rule, and a key with a null equals none. A reference is broken
    by a value that the parent's column lacks, not by a null.
    """
    found = []
    if not_null:
        counts = table.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in not_null])
        rows = F.array(*[F.struct(F.lit(f"{c} is not null").alias("rule"), F.col(c).alias("rows")) for c in not_null])
        found.append(counts.select(F.inline(rows)))
    for keys in unique:
        whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
        groups = table.where(whole).groupBy(*keys).agg((F.count("*") - 1).alias("more"))
        found.append(groups.agg(F.coalesce(F.sum("more"), F.lit(0)).alias("rows")).select(F.lit(f"unique {', '.join(keys)}").alias("rule"), "rows"))
    for column, parent, key in references:
        child = table.where(F.col(column).isNotNull()).select(F.col(column).alias("_child"))
        known = parent.select(F.col(key).alias("_parent")).distinct()
        lost = child.join(known, F.col("_child") == F.col("_parent"), "left_anti").agg(F.count("*").alias("rows"))
        found.append(lost.select(F.lit(f"{column} is known").alias("rule"), "rows"))
    return reduce(DataFrame.unionByName, found)
