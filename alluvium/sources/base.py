"""What every parser shares: items of a snapshot, provenance, and the silver shapes."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions import variant as J
from ..schemas import DEFAULT_CURRENCY

STRINGS = "array<string>"
ITEMS = 1 << 20


def no_strings() -> Column:
    return F.array().cast(STRINGS)


@dataclass(frozen=True)
class Parser:
    """A source's parser. `items` turns snapshots into a row an item; `fields` are columns over these rows."""

    silver: str
    items: Callable[[DataFrame], DataFrame]
    fields: Callable[[], dict[str, Column]]

    def parse(self, bronze: DataFrame) -> DataFrame:
        """Silver rows of the snapshots: (source, bronze_id) and the snapshot's time go with each; none is dropped.

        Absent required strings are empty, optional ones null, lists empty. A body that can't be read gives no row,
        so the snapshot is read again at the next run.
        """
        rows = self.items(bronze.withColumnsRenamed({"id": "bronze_id"}).withColumn("pos", F.lit(0)))
        made = self.fields()
        shape = ARTICLE_FIELDS if self.silver == "articles" else PRODUCT_FIELDS
        kept = [F.coalesce(made.get(n, F.lit(None)).cast(t), F.lit(None) if d is None else d).cast(t).alias(n) for n, t, d in shape()]
        # Ids follow the order of snapshots and of items in them; a body with more items than that is an error.
        beyond = F.raise_error(F.concat(F.lit(f"more than {ITEMS} items in snapshot "), F.col("bronze_id").cast("string"))).cast("bigint")
        number = F.when(F.col("pos") >= ITEMS, beyond).otherwise((F.col("bronze_id") * ITEMS + F.col("pos")).cast("bigint")).alias("id")
        return rows.select(number, "bronze_id", "source", *kept, "created_at")


def ARTICLE_FIELDS() -> list[tuple[str, str, Column | None]]:
    return [
        ("source_url", "string", F.lit("")), ("title", "string", F.lit("")), ("body", "string", None), ("authors", STRINGS, no_strings()),
        ("published_at", "timestamp_ntz", None), ("section", "string", None), ("tags", STRINGS, no_strings()), ("image_urls", STRINGS, no_strings()),
    ]


def PRODUCT_FIELDS() -> list[tuple[str, str, Column | None]]:
    return [
        ("source_url", "string", F.lit("")), ("sku", "string", None), ("name", "string", F.lit("")), ("brand", "string", None),
        ("price", "decimal(12,2)", None), ("currency", "string", F.lit(DEFAULT_CURRENCY)), ("unit", "string", None), ("image_urls", STRINGS, no_strings()),
    ]


def json_items(path: str, shape: str | None = None) -> Callable[[DataFrame], DataFrame]:
    """A row for each object in the array at `path` of the JSON body: a variant, or a struct of the shape if one is given."""

    def items(bronze: DataFrame) -> DataFrame:
        found = J.parsed(F.col("body"), lambda v: J.objects(v, path)) if shape is None else J.shaped(F.try_parse_json("body"), shape, path)
        return bronze.drop("pos").select("*", F.posexplode(found).alias("pos", "item"))

    return items


def with_unit(fields: dict[str, Column]) -> dict[str, Column]:
    return fields | {"unit": X.unit_from_name(fields["name"])}
