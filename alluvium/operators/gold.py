"""Gold layer: the product dimension, price changes and price facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import scratch, tables

ATTRIBUTES = ("name", "brand", "unit", "currency", "image_urls")


def dim_product(silver: DataFrame, attributes: tuple[str, ...] = ATTRIBUTES) -> DataFrame:
    """A row a (source, sku): attributes of the latest row by (created_at, id), nulls included, first and last sight."""
    latest = F.max_by(F.struct(*attributes), F.struct("created_at", "id")).alias("latest")
    seen = silver.where("sku IS NOT NULL").groupBy("source", "sku").agg(latest, F.min("created_at").alias("first_seen_at"), F.max("created_at").alias("last_seen_at"))
    return seen.select("source", "sku", "latest.*", "first_seen_at", "last_seen_at")


def price_changes(silver: DataFrame) -> DataFrame:
    """Rows whose price differs from the one observed before, by (created_at, id); the first of a product counts."""
    w = Window.partitionBy("source", "sku").orderBy("created_at", "id")
    priced = silver.where("sku IS NOT NULL AND price IS NOT NULL")
    return priced.withColumn("previous", F.lag("price").over(w)).where(~F.col("price").eqNullSafe(F.col("previous"))).drop("previous")


def fact_price(silver: DataFrame) -> DataFrame:
    """Price changes with one a timestamp, the first by id; the conflict is settled after the changes are found."""
    return _first_of_a_time(price_changes(silver))


def _first_of_a_time(changes: DataFrame) -> DataFrame:
    w = Window.partitionBy("source", "sku", "created_at").orderBy("id")
    return changes.withColumn("nth", F.row_number().over(w)).where("nth = 1").drop("nth").withColumnRenamed("created_at", "observed_at")


def with_product_keys(dim: DataFrame, existing: DataFrame | None = None, start: int = 0) -> DataFrame:
    """Keys of known products stay; new ones are numbered after the largest, or after `start` where there is none.

    The dimension is met with the known keys once and written; what is read again, to number the new products, is that.
    """
    spark = dim.sparkSession
    if existing is None:
        existing = dim.limit(0).select("source", "sku", F.lit(0).cast("long").alias("product_key"))
    known = existing.select(F.col("source").alias("_source"), F.col("sku").alias("_sku"), "product_key")
    met = scratch.written(dim.join(known, (F.col("source") == F.col("_source")) & (F.col("sku") == F.col("_sku")), "left").drop("_source", "_sku"), "products")
    top = existing.agg(F.coalesce(F.max("product_key"), F.lit(start)).alias("top")).first()["top"]
    fresh = tables.numbered(met.where("product_key IS NULL").drop("product_key"), ["source", "sku"], "product_key", F.lit(top))
    return met.where("product_key IS NOT NULL").unionByName(fresh)


def facts_with_keys(facts: DataFrame, dim: DataFrame) -> DataFrame:
    return facts.join(dim.select("source", "sku", "product_key"), ["source", "sku"])


#: What is kept of each product between loads: its last row and its last priced row, by (created_at, id).
STATE = "source STRING, sku STRING, last_at TIMESTAMP_NTZ, last_id BIGINT, priced_at TIMESTAMP_NTZ, priced_id BIGINT, price DECIMAL(12,2)"
_LAST = ("last_at", "last_id")
_PRICED = ("priced_at", "priced_id", "price")


def product_state(silver: DataFrame, state: DataFrame | None = None) -> DataFrame:
    """The state of products after these rows, from the state before them; one exchange by product."""
    when = F.struct("created_at", "id")
    last = F.struct(F.col("created_at").alias("last_at"), F.col("id").alias("last_id"))
    priced = F.when(F.col("price").isNotNull(), F.struct(F.col("created_at").alias("priced_at"), F.col("id").alias("priced_id"), "price"))
    now = silver.where("sku IS NOT NULL").select("source", "sku", last.alias("last"), priced.alias("priced"), when.alias("at"))
    if state is not None:
        kept = F.when(F.col("priced_id").isNotNull(), F.struct(*_PRICED))
        now = now.unionByName(state.select("source", "sku", F.struct(*_LAST).alias("last"), kept.alias("priced"), F.struct(F.col("last_at").alias("created_at"), F.col("last_id").alias("id")).alias("at")))
    made = now.groupBy("source", "sku").agg(F.max("last").alias("last"), F.max("priced").alias("priced"))
    return made.select("source", "sku", "last.*", "priced.*")


def changes_since(fresh: DataFrame, state: DataFrame) -> DataFrame:
    """Priced rows that came since the state was made, with `late`: whether their product has a row among them that isn't
    after its last priced one; and `changed`: whether the price differs from the one before, which holds for products
    that aren't late only."""
    by = Window.partitionBy("source", "sku")
    before = state.select(F.col("source").alias("_source"), F.col("sku").alias("_sku"), F.struct(F.col("priced_at").alias("created_at"), F.col("priced_id").alias("id")).alias("_upto"), F.col("priced_id").isNotNull().alias("_known"), F.col("price").alias("_price"))
    rows = fresh.where("sku IS NOT NULL AND price IS NOT NULL").join(before, (F.col("source") == F.col("_source")) & (F.col("sku") == F.col("_sku")), "left")
    previous = F.coalesce(F.lag("price").over(by.orderBy("created_at", "id")), F.col("_price"))
    late = F.coalesce(F.col("_known") & (F.min(F.struct("created_at", "id")).over(by) <= F.col("_upto")), F.lit(False))
    return rows.withColumns({"changed": ~F.col("price").eqNullSafe(previous), "late": late}).drop("_source", "_sku", "_upto", "_known", "_price")


def incremental_facts(fresh: DataFrame, state: DataFrame, history: DataFrame) -> DataFrame:
    """What fact_price() of the whole history may have that it hadn't before the fresh rows came: changes of the products
    whose rows all came in order, from these rows and the state alone, and all changes of products with a late row, whose
    history is read. history: all rows, the fresh ones among them. Without late rows it isn't read.

    Facts that were known before, and only those of products with late rows or at the time of the last row, may be among
    them; a fact's key is (source, sku, observed_at)."""
    marked = scratch.written(changes_since(fresh, state), "price-changes")
    on_time = _first_of_a_time(marked.where("changed AND NOT late").drop("changed", "late"))
    late = marked.where("late").select("source", "sku").distinct()
    if late.isEmpty():
        return on_time
    again = history.join(late.select(F.col("source").alias("_source"), F.col("sku").alias("_sku")), (F.col("source") == F.col("_source")) & (F.col("sku") == F.col("_sku")), "left_semi")
    return on_time.unionByName(fact_price(again).select(*on_time.columns))


def incremental_dim(fresh: DataFrame, dim: DataFrame, state: DataFrame, attributes: tuple[str, ...] = ATTRIBUTES) -> DataFrame:
    """dim_product() of the whole history for the products of the fresh rows, from these rows, the dimension and the state."""
    at = F.struct("created_at", "id")
    new = fresh.where("sku IS NOT NULL").groupBy("source", "sku").agg(F.max_by(F.struct(*attributes), at).alias("latest"), F.max(at).alias("at"), F.min("created_at").alias("first"), F.max("created_at").alias("last"))
    old = dim.join(state.select("source", "sku", F.struct(F.col("last_at").alias("created_at"), F.col("last_id").alias("id")).alias("upto")), ["source", "sku"])
    old = old.select(F.col("source").alias("_source"), F.col("sku").alias("_sku"), F.struct(*attributes).alias("held"), "upto", "first_seen_at", "last_seen_at")
    both = new.join(old, (F.col("source") == F.col("_source")) & (F.col("sku") == F.col("_sku")), "left")
    latest = F.when(F.col("upto").isNull() | (F.col("at") > F.col("upto")), F.col("latest")).otherwise(F.col("held")).alias("latest")
    return both.select("source", "sku", latest, F.least("first", "first_seen_at").alias("first_seen_at"), F.greatest("last", "last_seen_at").alias("last_seen_at")).select("source", "sku", "latest.*", "first_seen_at", "last_seen_at")


def price_segments(facts: DataFrame, keys: tuple[str, ...] = ("product_key",)) -> DataFrame:
    """The facts with valid_to: a price holds from observed_at until the product's next fact, without end after the last."""
    return facts.withColumn("valid_to", F.lead("observed_at").over(Window.partitionBy(*keys).orderBy("observed_at")))


def price_as_of(asked: DataFrame, facts: DataFrame, keys: tuple[str, ...] = ("product_key",), at: str = "at", values: tuple[str, ...] = ("price", "observed_at")) -> DataFrame:
    """The rows of asked with the values of the product's last fact at or before `at`, null where there is none.

    Both sides are laid together and sorted by product and time, in one shuffle, and each row takes the last fact above
    it: no range join, and no pair of rows is made. A null key or time finds nothing. Rows of asked that repeat stay, and
    so does every column of theirs; one that is named like a value is an error. Of facts with equal key and time any counts.

    A product that most rows of either side share is sorted in one task, spilling; see price_as_of_hot().
    """
    return _as_of(asked, facts, list(keys), at, values, [])


def price_as_of_hot(asked: DataFrame, facts: DataFrame, period: str, keys: tuple[str, ...] = ("product_key",), at: str = "at", values: tuple[str, ...] = ("price", "observed_at")) -> DataFrame:
    """price_as_of() for products with very many rows: each product's time is cut into periods (a unit of date_trunc), a task
    has a product's rows of one period, and the last fact of each is carried to the next ones that have rows."""
    cut = lambda c: F.date_trunc(period, c)
    ks = list(keys)
    lasts = facts.where(_whole(ks)).groupBy(*ks, cut(F.col("observed_at")).alias("_period")).agg(F.max_by(F.struct(*values), "observed_at").alias("_last"))
    wanted = asked.where(_whole([*ks, at])).select(*ks, cut(F.col(at)).alias("_period")).distinct()
    # one row a product and period on either side: the last value of the periods before
    spine = lasts.unionByName(wanted.withColumn("_last", F.lit(None).cast(lasts.schema["_last"].dataType)))
    once = spine.groupBy(*ks, "_period").agg(F.first("_last", ignorenulls=True).alias("_last"))
    carried = once.withColumn("_carried", F.last("_last", ignorenulls=True).over(Window.partitionBy(*ks).orderBy("_period").rowsBetween(Window.unboundedPreceding, -1)))
    seeds = carried.where("_carried IS NOT NULL").select(*ks, F.col("_period").alias("observed_at"), "_carried")
    facts = facts.where(_whole([*ks, "observed_at"])).select(*ks, F.col("observed_at").alias("_at"), F.struct(*values).alias("_value"), F.lit(1).alias("_rank"))
    facts = facts.unionByName(seeds.select(*ks, F.col("observed_at").alias("_at"), F.col("_carried").alias("_value"), F.lit(0).alias("_rank")))
    return _laid(asked, facts, ks, at, values, [cut(F.col("_at"))])


def _whole(names: list[str]) -> Column:
    return F.expr(" AND ".join(f"`{n}` IS NOT NULL" for n in names))


def _as_of(asked: DataFrame, facts: DataFrame, keys: list[str], at: str, values: tuple[str, ...], more: list[Column]) -> DataFrame:
    side = facts.where(_whole([*keys, "observed_at"])).select(*keys, F.col("observed_at").alias("_at"), F.struct(*values).alias("_value"), F.lit(1).alias("_rank"))
    return _laid(asked, side, keys, at, values, more)


def _laid(asked: DataFrame, side: DataFrame, keys: list[str], at: str, values: tuple[str, ...], more: list[Column]) -> DataFrame:
    """side: keys, _at, _value, _rank (at one time lower ranks first, the rows of asked last)."""
    if clash := set(values) & set(asked.columns):
        raise ValueError(f"asked already has {', '.join(sorted(clash))}")
    kind = side.schema["_value"].dataType
    rows = asked.select(*keys, F.col(at).alias("_at"), F.lit(None).cast(kind).alias("_value"), F.lit(2).alias("_rank"), F.struct(*asked.columns).alias("_row"))
    both = rows.unionByName(side.withColumn("_row", F.lit(None).cast(rows.schema["_row"].dataType)))
    up = Window.partitionBy(*keys, *more).orderBy("_at", "_rank").rowsBetween(Window.unboundedPreceding, 0)
    found = F.when(_whole([*keys, "_at"]), F.last("_value", ignorenulls=True).over(up)).alias("_found")
    return both.select("_row", "_rank", found).where("_rank = 2").select("_row.*", *[F.col(f"_found.{v}").alias(v) for v in values])
