"""Schema evolution on read: rows of every stored version, brought to the present columns by a chain of changes.

A table's rows lie in folders by the version of the schema they were written with. The steps from a version to the present
are composed into one expression a column, so each version is one projection over its scan: files are never rewritten,
a scan reads what the present columns come from and nothing else, and filters on renamed columns still reach it.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import LoadError
from . import tables

#: Column names so far -> what each is made of.
Columns = dict[str, Column]


@dataclass(frozen=True)
class Rename:
    old: str
    new: str

    def apply(self, columns: Columns) -> Columns:
        _need(columns, self.old)
        _free(columns, self.new)
        return {self.new if c == self.old else c: e for c, e in columns.items()}


@dataclass(frozen=True)
class Add:
    """A new column; `value` gets the columns so far (by name) and gives what old rows hold in it, null where there is none."""

    name: str
    kind: str
    value: Callable[[Columns], Column] | None = None

    def apply(self, columns: Columns) -> Columns:
        _free(columns, self.name)
        made = F.lit(None) if self.value is None else self.value(columns)
        return columns | {self.name: made.cast(self.kind)}


@dataclass(frozen=True)
class Drop:
    name: str

    def apply(self, columns: Columns) -> Columns:
        _need(columns, self.name)
        return {c: e for c, e in columns.items() if c != self.name}


@dataclass(frozen=True)
class Change:
    """A column's new type, or a new value by `value` from the columns so far. A value that the type can't hold is null."""

    name: str
    kind: str
    value: Callable[[Columns], Column] | None = None

    def apply(self, columns: Columns) -> Columns:
        _need(columns, self.name)
        made = columns[self.name] if self.value is None else self.value(columns)
        return columns | {self.name: made.try_cast(self.kind)}


Step = Rename | Add | Drop | Change


def _need(columns: Columns, name: str) -> None:
    if name not in columns:
        raise LoadError(f"schema: there is no column {name} to change")


def _free(columns: Columns, name: str) -> None:
    if name in columns:
        raise LoadError(f"schema: there is a column {name} already")


@dataclass(frozen=True)
class Chain:
    """first: the columns of version 1, as DDL; steps: for each later version what changed. NOT NULL isn't kept on read."""

    first: str
    steps: tuple[tuple[Step, ...], ...] = ()

    @property
    def version(self) -> int:
        return len(self.steps) + 1

    def at(self, spark: SparkSession, version: int) -> DataFrame:
        """An empty table with the columns of a version."""
        rows = tables.empty(spark, self.first)
        columns = _composed({c: F.col(c) for c in rows.columns}, self.steps[: version - 1])
        return rows.select(*[e.alias(c) for c, e in columns.items()])

    def upgraded(self, rows: DataFrame, version: int) -> DataFrame:
        """Rows of a version with the present columns."""
        if not 1 <= version <= self.version:
            raise LoadError(f"schema: version {version} is unknown, the present one is {self.version}")
        columns = _composed({c: F.col(c) for c in rows.columns}, self.steps[version - 1 :])
        return rows.select(*[e.alias(c) for c, e in columns.items()])


def _composed(columns: Columns, steps: tuple[tuple[Step, ...], ...]) -> Columns:
    return reduce(lambda now, step: step.apply(now), [s for version in steps for s in version], columns)


def append(rows: DataFrame, path: str, chain: Chain) -> None:
    """Adds rows with the present columns to the table. Others are an error, before anything is written."""
    want = {f.name: f.dataType.simpleString() for f in chain.at(rows.sparkSession, chain.version).schema}
    have = {f.name: f.dataType.simpleString() for f in rows.schema}
    if want != have:
        odd = sorted(set(want.items()) ^ set(have.items()))
        raise LoadError(f"{path}: columns differ from version {chain.version}: {', '.join(f'{n} {t}' for n, t in odd)}")
    rows.select(*want).write.mode("append").option("compression", "zstd").parquet(f"{path}/schema={chain.version}")


def stored(spark: SparkSession, path: str) -> list[int]:
    """The versions of the schema that the table has rows of."""
    return sorted(int(m[1]) for p in tables.parts(spark, path) if (m := re.search(r"/schema=(\d+)/?$", p)))


def read(spark: SparkSession, path: str, chain: Chain) -> DataFrame:
    """All rows with the present columns, whatever version they were written with; none where the table isn't there yet. A
    version later than the chain's last is an error, since what it means isn't known."""
    found = [chain.upgraded(spark.read.schema(chain.at(spark, v).schema).parquet(f"{path}/schema={v}"), v) for v in _known(spark, path, chain)]
    return reduce(DataFrame.unionByName, found) if found else chain.at(spark, chain.version)


def _known(spark: SparkSession, path: str, chain: Chain) -> list[int]:
    found = stored(spark, path)
    if found and found[-1] > chain.version:
        raise LoadError(f"{path}: rows of version {found[-1]} of the schema, the present one is {chain.version}")
    return found
