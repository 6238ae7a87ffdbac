"""Incremental loads against a rebuild, the as-of lookup on odd rows, checked publication, schema evolution."""

import datetime as dt
import io
import random
from contextlib import redirect_stdout
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from alluvium import config
from alluvium.errors import LoadError
from alluvium.operators import constraints, evolution, gold, store, tables
from alluvium.plans import pipeline
from alluvium.schemas import PRODUCT

DAY = dt.datetime(2024, 1, 1)


def silver_rows(seed, n, start=0, days=30, late=0.1):
    """Rows of about 12 products in the order of their ids, a few dated back, some without sku or price."""
    rng, out = random.Random(seed), []
    for i in range(n):
        at = DAY + dt.timedelta(hours=(start + i) // 3 if rng.random() > late else rng.randrange(24 * days))
        sku = None if rng.random() < 0.05 else f"p{rng.randrange(12)}"
        price = None if rng.random() < 0.1 else Decimal(rng.randrange(3)) + Decimal("0.10")
        out.append((start + i, start + i, "shop", "u", sku, f"name {rng.randrange(3)}", rng.choice([None, "b"]), price, "PYG", None, [], at))
    return out


def loaded(spark, store_folder, batches):
    cfg = config.from_mapping({"name": "shop", "load": {"builder": "product"}}, store_folder)
    for rows in batches:
        store.append_batch(spark.createDataFrame(rows, PRODUCT), f"{store_folder}/silver/products", "shop")
        counts = pipeline.load(spark, cfg)
    dim = {r["sku"]: tuple(r)[3:] for r in pipeline.gold_table(spark, store_folder, "dim_product").collect()}
    keys = {r["product_key"]: r["sku"] for r in pipeline.gold_table(spark, store_folder, "dim_product").collect()}
    facts = pipeline.gold_table(spark, store_folder, "fact_price").collect()
    assert sorted(r["id"] for r in facts) == list(range(1, len(facts) + 1))
    return counts, dim, {(keys[r["product_key"]], r["observed_at"]): (r["price"], r["bronze_id"]) for r in facts}


def rebuilt(batches):
    """By the reference's rule: each load goes through everything so far; a fact that is there stays."""
    facts, so_far, dim = {}, [], {}
    for rows in batches:
        so_far += rows
        for sku in {r[4] for r in so_far} - {None}:
            own = sorted((r for r in so_far if r[4] == sku), key=lambda r: (r[11], r[0]))
            dim[sku] = (*own[-1][5:7], own[-1][9], own[-1][8], own[-1][10], own[0][11], own[-1][11])
            before = None
            for r in own:
                if r[7] is not None:
                    if r[7] != before:
                        facts.setdefault((sku, r[11]), (r[7], r[1]))
                    before = r[7]
    return dim, facts


@pytest.mark.parametrize("late", [0, 0.2])
def test_loads_by_batches_equal_rebuilds(spark, tmp_path, late):
    batches = [silver_rows(1, 200), silver_rows(2, 40, 200, late=late), silver_rows(3, 3, 240, late=late), silver_rows(4, 30, 243, late=late)]
    counts, dim, facts = loaded(spark, str(tmp_path), batches)
    want_dim, want_facts = rebuilt(batches)
    assert facts == want_facts and dim == want_dim
    nulls = sum(r[4] is None for b in batches for r in b)
    assert counts == {"products": len(dim), "null_skus": nulls, "facts": len(facts)}


def test_a_load_reads_the_new_batches_only(spark, tmp_path):
    path = str(tmp_path / "silver")
    for n in range(3):
        store.append_batch(spark.createDataFrame(silver_rows(n, 20, 20 * n, late=0), PRODUCT), path, "shop")
    silver = spark.read.schema(f"{PRODUCT}, batch BIGINT").parquet(path)
    fresh = silver.where("source = 'shop' AND batch = 2")
    state = gold.product_state(silver.where("batch < 2"))
    assert fresh.inputFiles() and "PartitionFilters" in plan(fresh)
    history = silver.where("raise_error('the history was read') IS NULL")
    assert gold.incremental_facts(fresh, state, history).count() >= 0  # without late rows the history isn't read
    assert tables.whole_batches(spark, store.source_folder(path, "shop")) == [0, 1, 2]
    (tmp_path / "silver" / "source=shop" / "batch=1" / "_SUCCESS").unlink()
    assert tables.whole_batches(spark, store.source_folder(path, "shop")) == [0, 2]


def plan(df):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def test_the_dimension_meets_the_known_keys_once(spark):
    dim = gold.dim_product(spark.createDataFrame(silver_rows(1, 50), PRODUCT))
    keyed = gold.with_product_keys(dim, start=100)
    assert sorted(r["product_key"] for r in keyed.collect()) == list(range(101, 101 + dim.count()))
    assert "ObjectHashAggregate" not in plan(keyed) and "MapPartitions" not in plan(keyed)  # the products were written


def test_a_load_that_died_is_made_good(spark, tmp_path, monkeypatch):
    batches = [silver_rows(1, 60), silver_rows(2, 30, 60)]
    loaded(spark, str(tmp_path), batches[:1])
    real = tables.replace

    def dies(rows, path, base, **more):
        if "product_state" in path:
            raise OSError("lost")
        return real(rows, path, base, **more)

    monkeypatch.setattr(tables, "replace", dies)
    with pytest.raises(OSError, match="lost"):
        loaded(spark, str(tmp_path), batches[1:])
    monkeypatch.setattr(tables, "replace", real)
    _, dim, facts = loaded(spark, str(tmp_path), [[]])
    assert (dim, facts) == rebuilt(batches)


def test_as_of_on_odd_rows(spark):
    facts = spark.createDataFrame([(1, DAY, 5), (1, DAY + dt.timedelta(days=2), None), (2, DAY, 7), (None, DAY, 9), (3, None, 1)], "product_key long, observed_at timestamp, price int")
    hours = (-1, 0, 30, 48, 49, 24 * 90)
    asked = [(k, DAY + dt.timedelta(hours=h), "x", i) for k in (1, 2, 4, None) for i, h in enumerate(hours)] + [(1, None, "x", 0), (1, DAY, "y", 1), (1, DAY, "y", 1)]
    rows = spark.createDataFrame(asked, "product_key long, at timestamp, valid_to string, n int")

    def want(k, at):
        if k is None or at is None:
            return None, None
        found = [(a, p) for key, a, p in ((1, DAY, 5), (1, DAY + dt.timedelta(days=2), None), (2, DAY, 7)) if key == k and a <= at]
        return (max(found)[1], max(found)[0]) if found else (None, None)

    expected = sorted(map(repr, ((*r, *want(*r[:2])) for r in asked)))
    for out in (gold.price_as_of(rows, facts), gold.price_as_of_hot(rows, facts, "day"), gold.price_as_of_hot(rows, facts, "month")):
        assert out.columns == ["product_key", "at", "valid_to", "n", "price", "observed_at"]
        assert sorted(repr(tuple(r)) for r in out.collect()) == expected
        assert "CartesianProduct" not in plan(out) and "NestedLoop" not in plan(out)
    assert plan(gold.price_as_of(rows, facts)).count("Exchange") == 2  # named in the tree and in the details: one shuffle
    assert gold.price_as_of(rows, facts.limit(0)).where("price IS NULL").count() == len(asked) and gold.price_as_of(rows.limit(0), facts).count() == 0
    with pytest.raises(ValueError, match="already has price"):
        gold.price_as_of(rows.withColumn("price", F.lit(1)), facts)


def test_a_breach_leaves_the_version_before(spark, tmp_path):
    path = str(tmp_path / "t")
    check = lambda rows: constraints.broken(rows, ["id"], [["id"]])
    tables.replace(spark.range(3), path, 0, check=check)
    for bad, rule in ((spark.range(3).union(spark.range(1)), r"unique id \(1 rows\)"), (spark.sql("SELECT CAST(NULL AS long) AS id"), r"id is not null \(1 rows\)")):
        with pytest.raises(LoadError, match=rule):
            tables.replace(bad, path, 1, check=check)
        assert tables.version(spark, path) == 1 and tables.current(spark, path, "id long").count() == 3
    assert sorted(p.name for p in (tmp_path / "t").iterdir() if not p.name.startswith(".")) == ["v1"]
    tables.replace(spark.range(5), path, 1, check=check)
    assert tables.current(spark, path, "id long").count() == 5


CHAIN = evolution.Chain(
    "a BIGINT, b STRING, c STRING",
    ((evolution.Rename("b", "body"), evolution.Add("n", "INT", lambda c: F.length(c["body"]))), (evolution.Drop("c"), evolution.Change("n", "BIGINT", lambda c: c["n"] * 2), evolution.Add("tag", "STRING"))),
)


def test_versions_are_read_as_one(spark, tmp_path):
    path = str(tmp_path / "t")
    assert evolution.read(spark, path, CHAIN).columns == ["a", "body", "n", "tag"] and evolution.read(spark, path, CHAIN).count() == 0
    evolution.append(spark.createDataFrame([(1, "xyz", "c"), (2, None, None)], "a long, b string, c string"), path, evolution.Chain(CHAIN.first))
    evolution.append(spark.createDataFrame([(3, "de", "c", 7)], "a long, body string, c string, n int"), path, evolution.Chain(CHAIN.first, CHAIN.steps[:1]))
    evolution.append(spark.createDataFrame([("t", 4, "f", 1)], "tag string, a long, body string, n long"), path, CHAIN)
    rows = evolution.read(spark, path, CHAIN)
    assert sorted(tuple(r) for r in rows.collect()) == [(1, "xyz", 6, None), (2, None, None, None), (3, "de", 14, None), (4, "f", 1, "t")]
    shown = plan(rows.where("body = 'xyz'").select("a"))
    assert "EqualTo(b,xyz)" in shown and "EqualTo(body,xyz)" in shown and "tag" not in shown.split("ReadSchema")[1]
    with pytest.raises(LoadError, match="version 3"):
        evolution.append(rows.drop("tag"), path, CHAIN)
    with pytest.raises(LoadError, match="present one is 2"):
        evolution.read(spark, path, evolution.Chain(CHAIN.first, CHAIN.steps[:1]))
    for bad in (evolution.Rename("z", "y"), evolution.Rename("a", "b"), evolution.Drop("z"), evolution.Add("a", "INT"), evolution.Change("z", "INT")):
        with pytest.raises(LoadError, match="column"):
            evolution.Chain("a INT, b INT", ((bad,),)).at(spark, 2)
