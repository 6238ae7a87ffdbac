"""The stream of price facts: shuffled batches against the batch operator, lateness, end of state, restarts."""

import datetime as dt
import os
import random
from decimal import Decimal

import pytest

from alluvium.operators import gold
from alluvium.streaming.prices import price_fact_stream

SCHEMA = "id long, source string, sku string, price decimal(12,2), created_at timestamp"
DAY = dt.datetime(2024, 1, 1)
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@pytest.fixture(autouse=True)
def rocks(spark):
    keys = {"spark.sql.streaming.stateStore.providerClass": ROCKS, "spark.sql.shuffle.partitions": "2"}
    before = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def arrive(spark, folder, batches, lateness, forget_ms=None, name="q"):
    """Each batch is a file of its own; returns what has come out so far, and the state's rows after each batch."""
    there = len(list(folder.glob("in/*.parquet"))) if (folder / "in").exists() else 0
    for n, rows in enumerate(batches, there):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("overwrite").parquet(str(folder / "made"))
        (folder / "in").mkdir(exist_ok=True)
        to = folder / "in" / f"{n:04d}.parquet"
        next((folder / "made").glob("*.parquet")).rename(to)
        os.utime(to, (1_700_000_000 + n, 1_700_000_000 + n))
    rows = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(folder / "in"))
    query = (
        price_fact_stream(rows, lateness, forget_ms).writeStream.format("parquet").option("checkpointLocation", str(folder / "state"))
        .trigger(availableNow=True).start(str(folder / "out"))
    )
    assert query.awaitTermination(300)
    states = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    out = spark.read.parquet(str(folder / "out")).collect()
    return sorted((r["sku"], r["observed_at"], r["id"], r["price"]) for r in out), states


def rows_of(seed, n):
    rng = random.Random(seed)
    made = [(i, "s", rng.choice(["a", "b", "c", None]), rng.choice([None, *map(Decimal, ("1.10", "2.20", "3.30"))]), DAY + dt.timedelta(minutes=rng.randrange(600), microseconds=rng.choice([0, 0, 1500]))) for i in range(n)]
    return sorted(made, key=lambda r: r[4])


FLUSH = [(10_000, "s", "zz", Decimal("9.00"), DAY + dt.timedelta(days=2)), (10_001, "s", "zz", Decimal("9.00"), DAY + dt.timedelta(days=2, hours=3))]


def test_shuffled_batches_equal_the_batch_operator(spark, tmp_path):
    made = rows_of(1, 240)
    # every row comes at most two hours late
    order = sorted(made, key=lambda r, rng=random.Random(2): r[4] + dt.timedelta(minutes=rng.randrange(115)))
    batches = [order[i : i + 60] for i in range(0, 240, 60)]
    for b in batches:
        random.Random(len(b)).shuffle(b)
    out, states = arrive(spark, tmp_path, [*batches, FLUSH[:1], FLUSH[1:]], "2 hours")
    facts = gold.fact_price(spark.createDataFrame(made, SCHEMA)).collect()
    assert out[: len(facts)] == sorted((r["sku"], r["observed_at"], r["id"], r["price"]) for r in facts)
    assert len(facts) > 60 and states[-1] == 5  # the last prices of four products, and a row that waits


def test_a_late_row_is_dropped_and_a_restart_goes_on(spark, tmp_path):
    at = lambda h: DAY + dt.timedelta(hours=h)
    first = [[(1, "s", "a", Decimal(1), at(0)), (2, "s", "a", Decimal(1), at(5))], [(3, "s", "a", Decimal(2), at(9))]]
    arrive(spark, tmp_path, first, "1 hour")
    more = [[(4, "s", "a", Decimal(7), at(1)), (5, "s", "a", Decimal(2), at(10))], FLUSH[:1], FLUSH[1:]]
    out, _ = arrive(spark, tmp_path, more, "1 hour")
    assert [(s, i, int(p)) for s, _, i, p in out if s == "a"] == [("a", 1, 1), ("a", 3, 2)]


def test_state_ends(spark, tmp_path):
    at = lambda h: DAY + dt.timedelta(hours=h)
    batches = [[(i, "s", f"p{i}", Decimal(1), at(0)) for i in range(20)], [(100, "s", "x", Decimal(1), at(3))], [(101, "s", "x", Decimal(1), at(30))], [(102, "s", "x", Decimal(1), at(31))], [(103, "s", "p3", Decimal(1), at(33))], *[[r] for r in FLUSH]]
    out, states = arrive(spark, tmp_path, batches, "1 hour", 10 * 3600 * 1000)
    assert [i for s, _, i, _ in out if s == "p3"] == [3, 103]  # forgotten, so it is first again
    assert max(states) >= 20 and states[-1] < 10


def test_products_of_one_bucket_stay_apart(spark, tmp_path, monkeypatch):
    """A state holds many products, null sources among them; each has its own changes, and the states are few."""
    from alluvium.streaming import prices

    monkeypatch.setattr(prices, "BUCKETS", 2)
    made = [(i, None if sku == "c" else s, sku, p, at) for i, s, sku, p, at in rows_of(3, 240)]
    out, states = arrive(spark, tmp_path, [made[:120], made[120:], FLUSH[:1], FLUSH[1:]], "1 hour")
    facts = gold.fact_price(spark.createDataFrame(made, SCHEMA)).collect()
    assert out[: len(facts)] == sorted((r["sku"], r["observed_at"], r["id"], r["price"]) for r in facts)
    assert len(facts) > 60 and max(states) <= 4
