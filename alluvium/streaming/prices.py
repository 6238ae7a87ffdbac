"""Streaming variants of the price changes: by order of arrival, and as facts by order of time."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def _changes(key, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    rows = pd.concat(list(frames)).sort_values(["created_at", "id"], ignore_index=True)
    if rows.empty:
        return
    before = rows["price"].shift(1)
    changed = rows["price"] != before
    changed.iloc[0] = not state.exists or rows["price"].iloc[0] != state.get[0]
    state.update((rows["price"].iloc[-1],))
    out = rows.loc[changed, ["id", "price", "created_at"]]
    out.insert(0, "source", key[0])
    out.insert(1, "sku", key[1])
    yield out


def streaming_price_changes(silver: DataFrame) -> DataFrame:
    """Changes by order of arrival between batches; the batch operator stays the source of truth for late rows. Prices
    keep the type they have, so decimals are compared as decimals."""
    price = silver.schema["price"].dataType.simpleString()
    return (
        silver.where("sku IS NOT NULL AND price IS NOT NULL").select("source", "sku", "id", "price", "created_at")
        .groupBy("source", "sku")
        .applyInPandasWithState(_changes, f"source string, sku string, id long, price {price}, created_at timestamp", f"price {price}", "append", GroupStateTimeout.NoTimeout)
    )


#: What the stream of facts gives, its prices in hundredths.
FACTS = "source string, sku string, id long, cents long, us long"
#: Products share a state by their hash, so what each state costs in a batch doesn't grow with the products.
BUCKETS = 1024

_PRODUCT = ["source", "sku"]
_ROW = [*_PRODUCT, "us", "id", "cents"]
_LAST = [*_PRODUCT, "us", "cents"]


class PriceFacts(StatefulProcessor):
    """Per bucket of products: rows that wait for their time, in `waiting`, and each product's last price, in `last`.

    A row waits until the watermark reaches its time, when no earlier one can come any more; a timer at the first one's time
    wakes the bucket, whose due rows are then gone through in order. So arrival order doesn't matter within the bound on lateness.
    After forget_ms of event time without a row a product's last price is dropped, by a timer too."""

    def __init__(self, forget_ms: int | None):
        self.forget_ms = forget_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        kinds = {"source": "string", "sku": "string", "us": "long", "id": "long", "cents": "long"}
        columns = lambda names: ", ".join(f"{n} array<{kinds[n]}>" for n in names)
        self.waiting = handle.getListState("waiting", columns(_ROW))
        self.last = handle.getValueState("last", columns(_LAST))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        upto = timerValues.getCurrentWatermarkInMs() * 1000
        fresh = pd.concat([f.loc[f["us"] > upto, _ROW] for f in rows])
        if len(fresh):
            self.waiting.appendValue(_lists(fresh, _ROW))
            self._wake_at(fresh)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        upto = timerValues.getCurrentWatermarkInMs() * 1000
        held = _frame(self.waiting.get(), _ROW)
        last = _frame(filter(None, [self.last.get()]), _LAST)
        due, later = held[held["us"] <= upto], held[held["us"] > upto]
        out = None
        if len(due):
            out, now = _facts(last, due)
            if len(later):
                self.waiting.put([_lists(later, _ROW)])
                self._wake_at(later)
            else:
                self.waiting.clear()
        else:
            now = last
        if self.forget_ms is not None and len(now):
            busy = pd.MultiIndex.from_frame(held[_PRODUCT])
            now = now[(now["us"] > upto - self.forget_ms * 1000) | pd.MultiIndex.from_frame(now[_PRODUCT]).isin(busy)]
            if len(now) and (len(due) or len(now) < len(last)):
                self.handle.registerTimer(-(-int(now["us"].min()) // 1000) + self.forget_ms)
        if len(due) or len(now) < len(last):
            self.last.update(_lists(now, _LAST)) if len(now) else self.last.clear()
        if out is not None and len(out):
            yield out

    def _wake_at(self, rows: pd.DataFrame) -> None:
        """One timer, at the first of the rows' times: what else is due by then goes with it, and the rest gets the next."""
        self.handle.registerTimer(-(-int(rows["us"].min()) // 1000))

    def close(self) -> None:
        pass


def _lists(rows: pd.DataFrame, names: list[str]) -> tuple:
    return tuple(rows[n].tolist() for n in names)


def _frame(stored: Iterable[tuple], names: list[str]) -> pd.DataFrame:
    parts = [pd.DataFrame({n: pd.Series(v, dtype=object if n in _PRODUCT else "int64") for n, v in zip(names, r)}) for r in stored]
    return pd.concat(parts, ignore_index=True) if parts else pd.DataFrame({n: pd.Series([], dtype=object if n in _PRODUCT else "int64") for n in names})


def _facts(last: pd.DataFrame, due: pd.DataFrame) -> tuple[pd.DataFrame, pd.DataFrame]:
    """The facts that due rows make after the last prices, and the last prices after them."""
    rows = pd.concat([last.assign(id=0, fresh=False), due.assign(fresh=True)], ignore_index=True)
    rows["product"] = rows.groupby(_PRODUCT, dropna=False, sort=False).ngroup()
    rows = rows.sort_values(["product", "fresh", "us", "id"], ignore_index=True)
    before = rows.groupby("product")["cents"].shift(1)
    # the first change at a time counts, a later one only moves the price
    changed = rows[rows["fresh"] & (before.isna() | (before != rows["cents"]))].drop_duplicates(["product", "us"])
    return changed[["source", "sku", "id", "cents", "us"]], rows.drop_duplicates("product", keep="last")[_LAST]


def price_fact_stream(silver: DataFrame, lateness: str, forget_ms: int | None = None) -> DataFrame:
    """source, sku, id, price, observed_at: fact_price() over a stream, rows in any order within `lateness` of event time.

    A fact comes once the watermark has passed its time. Rows later than the bound are dropped; one that Spark's watermark
    lets pass is dropped here, so no fact depends on how rows were dealt to batches. A product without a row for forget_ms
    loses its state, and its next row counts as a first one; without it the last price stays. The state's provider must be
    RocksDB's (spark.sql.streaming.stateStore.providerClass), which spills, so the waiting rows of all products need not
    fit memory; those of one of BUCKETS buckets within the bound do. created_at without a zone is read in the session's.
    """
    rows = silver.where("sku IS NOT NULL AND price IS NOT NULL AND created_at IS NOT NULL").select("source", "sku", "id", F.col("price").cast("decimal(12,2)").alias("price"), F.col("created_at").cast("timestamp").alias("created_at"))
    bucket = F.pmod(F.xxhash64("source", "sku"), F.lit(BUCKETS)).cast("int")
    coded = rows.select(bucket.alias("bucket"), "source", "sku", "id", (F.col("price") * 100).cast("long").alias("cents"), F.unix_micros("created_at").alias("us"), "created_at")
    waiting = coded.withWatermark("created_at", lateness).groupBy("bucket")
    facts = waiting.transformWithStateInPandas(PriceFacts(forget_ms), FACTS, "append", "EventTime")
    price = (F.col("cents").cast("decimal(20,2)") / 100).cast("decimal(12,2)")
    return facts.select("source", "sku", "id", price.alias("price"), F.timestamp_micros("us").alias("observed_at"))
