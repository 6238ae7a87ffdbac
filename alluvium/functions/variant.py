"""Column functions on JSON of mixed shapes, as VARIANT; what has another type than asked for is null or absent."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip, strip_or_null


def kind(v: Column) -> Column:
    """OBJECT, ARRAY, STRING, BIGINT and so on; null for null."""
    return F.regexp_extract(F.schema_of_variant(v), "^[A-Z]+", 0)


def at(v: Column, path: str) -> Column:
    """What is there, as a variant. Each costs a copy of it, so the value itself is taken as it is."""
    return v if path == "$" else F.try_variant_get(v, path, "variant")


def scalar(v: Column, path: str = "$") -> Column:
    """Text of a string, number or boolean; null for objects, arrays and null."""
    return F.when(~kind(at(v, path)).isin("OBJECT", "ARRAY", "VOID"), F.try_variant_get(v, path, "string"))


def string(v: Column, path: str = "$") -> Column:
    """Text of a string only, by one lookup: of what JSON has nothing but a string casts to binary."""
    return F.try_variant_get(v, path, "binary").cast("string")


def name(v: Column, path: str = "$") -> Column:
    """A stripped string; null where it is empty."""
    return strip_or_null(string(v, path))


def text(v: Column, path: str = "$") -> Column:
    """A stripped string; empty where there is none."""
    return F.coalesce(strip(string(v, path)), F.lit(""))


def members(v: Column, path: str = "$") -> Column:
    """Elements of an array as variants; none for any other value."""
    none = F.array().cast("array<variant>")
    return F.coalesce(F.try_variant_get(v, path, "array<variant>"), none)


def is_object(v: Column) -> Column:
    """Asked by a cast that only objects stand, since kind() works out the schema of all that is below."""
    return F.try_variant_get(v, "$", "struct<_:variant>").isNotNull()


def parsed(text: Column, read: Callable[[Column], Column]) -> Column:
    """read(the JSON text as a variant), the text parsed once."""
    return F.get(F.transform(F.array(F.try_parse_json(text)), lambda v: read(v)), F.lit(0))


def objects(v: Column, path: str = "$") -> Column:
    return F.filter(members(v, path), is_object)


def shaped(v: Column, shape: str, path: str = "$") -> Column:
    """The objects of an array as structs of this shape, by one cast; fields that are absent or have another type are null."""
    return F.filter(F.try_variant_get(v, path, f"array<{shape}>"), lambda x: x.isNotNull())


def plucked(items: Column, read: Callable[[Column], Column]) -> Column:
    """What `read` gives for each item, without nulls and empty strings."""
    return F.filter(F.transform(items, lambda x: read(x)), lambda x: x.isNotNull() & (x != ""))


def names(strings: Column) -> Column:
    """An array of strings, or of binaries as shaped() gives them: stripped, without nulls and empty ones."""
    return plucked(strings.cast("array<string>"), strip)


def linked_all(scripts: Column, types: tuple[str, ...]) -> Column:
    """Objects of the types in JSON-LD scripts: an object itself, members of its @graph or of a list."""

    def candidates(v: Column) -> Column:
        one = F.when(is_object(v), F.concat(F.array(v), members(v, "$['@graph']"))).otherwise(members(v))
        return F.filter(one, lambda x: is_object(x) & F.coalesce(string(x, "$['@type']").isin(*types), F.lit(False)))

    return F.flatten(F.transform(F.transform(scripts, lambda s: F.try_parse_json(s)), candidates))


def linked_data(scripts: Column, types: tuple[str, ...]) -> Column:
    """The first of these objects."""
    return F.get(linked_all(scripts, types), F.lit(0))
