"""The run of one source: extract, transform, load, or one of them by name."""

from __future__ import annotations

import functools
import logging
import urllib.parse
from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..config import Config
from ..errors import ConfigError, ExtractError, LoadError, PipelineError, TransformError
from ..operators import constraints, gold, scratch, store, tables
from ..schemas import ARTICLE, DIM_PRODUCT, FACT_PRICE, PRODUCT, REFERENCES, UNIQUE
from ..sources import crawl, http, parsers
from ..sources.scrapers import scraper

log = logging.getLogger(__name__)

SILVER = {"articles": ARTICLE, "products": PRODUCT}
Stage = tuple[str, Callable[[], dict[str, int]]]
#: A source may have so many bits of products and of price facts.
SPACE_BITS = 40
UPDATED = (*gold.ATTRIBUTES, "first_seen_at", "last_seen_at")
#: A row for each batch of silver that was loaded: its rows without a sku, and the facts' version and largest id by then.
LOADS = "batch BIGINT, null_skus BIGINT, fact_version BIGINT, last_fact_id BIGINT"


def transform(spark: SparkSession, config: Config) -> dict[str, int]:
    """Appends the silver rows of the source's snapshots that have none yet. The counts are observed while the rows are
    written, by the same job."""
    t = config.transform
    parser = parsers()[t.parser.rsplit(".", 1)[-1]]
    path = f"{t.store}/silver/{parser.silver}"
    silver = tables.read(spark, path, SILVER[parser.silver])
    bronze = crawl.snapshots(spark, t.store, scraper(t.parser.rsplit(".", 1)[-1], "").model)
    read, made = Observation(), Observation()
    open_rows = store.unparsed(bronze, silver, t.source).observe(read, F.count("*").alias("processed"))
    store.append_batch(parser.parse(open_rows).observe(made, F.count("*").alias("silver_rows")), path, t.source)
    return {**read.get, **made.get}


def _gold_path(store_folder: str, table: str, source: str) -> str:
    return f"{store_folder}/gold/{table}/{urllib.parse.quote(source, safe='')}"


def gold_table(spark: SparkSession, store_folder: str, table: str) -> DataFrame:
    """The gold table of all sources: dim_product or fact_price."""
    read, schema = (tables.current, DIM_PRODUCT) if table == "dim_product" else (tables.all_versions, FACT_PRICE)
    found = [read(spark, p, schema) for p in tables.parts(spark, f"{store_folder}/gold/{table}")]
    return functools.reduce(DataFrame.unionByName, found) if found else tables.empty(spark, schema)


def load(spark: SparkSession, config: Config) -> dict[str, int]:
    """Brings the dimension and the facts of the source up to date with the batches of silver that no load has read.

    Only these batches are read, and of the history the products that have a row among them which isn't after their last
    one. The result is that of a load of everything. A version that breaks a constraint isn't published. A load that died
    between two tables is made good by the next one, since a batch counts as loaded last.

    Each source has folders and a space of ids of its own, so sources may be loaded at once. Of two loads of one source
    at once the second to write fails and changes nothing. Facts are only added to."""
    source, folder = config.load.source, config.load.store
    path = f"{folder}/silver/products"
    first = tables.space(spark, folder, source) << SPACE_BITS
    dim_path, fact_path, state_path, load_path = (_gold_path(folder, t, source) for t in ("dim_product", "fact_price", "product_state", "loads"))
    dim_base, fact_base, state_base, load_base = (tables.version(spark, p) for p in (dim_path, fact_path, state_path, load_path))
    loads = tables.current(spark, load_path, LOADS).collect()  # a short row a batch
    batches = tables.whole_batches(spark, store.source_folder(path, source))
    todo = sorted(set(batches) - {r["batch"] for r in loads})
    if todo:
        silver = spark.read.schema(f"{PRODUCT}, batch BIGINT").parquet(path).where(F.col("source") == source)
        history, fresh = (silver.where(F.col("batch").isin(b)) for b in (batches, todo))
        dim, state, facts = (tables.current(spark, dim_path, DIM_PRODUCT), tables.current(spark, state_path, gold.STATE), tables.all_versions(spark, fact_path, FACT_PRICE))
        keyed = gold.with_product_keys(gold.incremental_dim(fresh, dim, state), dim, first).select(*dim.columns)
        tables.replace(store.upsert_update(dim, keyed, ["source", "sku"], list(UPDATED)), dim_path, dim_base, check=_rules("dim_product"))
        dim = tables.current(spark, dim_path, DIM_PRODUCT)
        found = gold.facts_with_keys(gold.incremental_facts(fresh, state, history), dim).select("product_key", "price", "currency", "observed_at", "bronze_id")
        found = scratch.written(found, "facts")
        since = found.agg(F.min("observed_at").alias("at")).first()["at"]
        old = facts.where(F.col("observed_at") >= F.lit(since)).select("product_key", "observed_at") if since is not None else facts.select("product_key", "observed_at").limit(0)
        new = scratch.written(found.join(old, ["product_key", "observed_at"], "left_anti"), "new-facts")
        last = _last_fact_id(spark, fact_path, loads, first)
        n = new.count()
        if n:
            rows = tables.numbered(new, ["product_key", "observed_at"], "id", F.lit(last)).select(*facts.columns)
            tables.add_version(rows, fact_path, fact_base, _rules("fact_price", {"dim_product": dim}))
        tables.replace(gold.product_state(fresh, state), state_path, state_base)
        nulls = {r["batch"]: r["n"] for r in fresh.groupBy("batch").agg(F.count_if(F.col("sku").isNull()).alias("n")).collect()}
        loads = [*map(tuple, loads), *[(b, nulls.get(b, 0), tables.version(spark, fact_path), last + n) for b in todo]]
        tables.replace(spark.createDataFrame(loads, LOADS).coalesce(1), load_path, load_base)
    nulls = tables.current(spark, load_path, LOADS).agg(F.coalesce(F.sum("null_skus"), F.lit(0)).alias("n")).first()["n"]
    return {"products": tables.current(spark, dim_path, DIM_PRODUCT).count(), "null_skus": nulls, "facts": tables.all_versions(spark, fact_path, FACT_PRICE).count()}


def _last_fact_id(spark: SparkSession, path: str, loads: list, first: int) -> int:
    """The largest id of the facts: as the loads say, and of the versions that a load which died has left since."""
    known, last = max(((r["fact_version"], r["last_fact_id"]) for r in loads), default=(0, first))
    more = tables.all_versions(spark, path, FACT_PRICE, after=known)
    return max(last, more.agg(F.coalesce(F.max("id"), F.lit(first)).alias("last")).first()["last"])


def _rules(table: str, parents: dict[str, DataFrame] | None = None) -> tables.Check:
    """The constraints of a table that a version must keep; of facts those within the version."""
    of = {"dim_product": DIM_PRODUCT, "fact_price": FACT_PRICE}
    refer = [(c, parents[parent], key) for c, parent, key in REFERENCES.get(table, [])] if parents else []
    return lambda rows: constraints.broken(rows, constraints.required(of[table]), UNIQUE[table], refer)


def broken_constraints(spark: SparkSession, store_folder: str) -> dict[str, DataFrame]:
    """For each gold table the rules (rule, rows) and how many rows break them."""
    made = {t: gold_table(spark, store_folder, t) for t in ("dim_product", "fact_price")}
    of = {"dim_product": DIM_PRODUCT, "fact_price": FACT_PRICE}
    refer = {t: [(c, made[parent], key) for c, parent, key in REFERENCES.get(t, [])] for t in made}
    return {t: constraints.broken(rows, constraints.required(of[t]), UNIQUE[t], refer[t]) for t, rows in made.items()}


def check_plugins(config: Config) -> None:
    """Names of scraper, parser and builder must be known before anything runs."""
    known = parsers()
    for block, name in (("extract", config.extract and config.extract.scraper), ("transform", config.transform and config.transform.parser)):
        if name is not None and name.rsplit(".", 1)[-1] not in known:
            raise ConfigError(f"{config.name}: no {block} plug-in {name!r}")
    if config.load is not None and config.load.builder.rsplit(".", 1)[-1] != "product":
        raise ConfigError(f"{config.name}: no load plug-in {config.load.builder!r}")


def _wrapped(error: type[PipelineError], run: Callable[[], dict[str, int]]) -> Callable[[], dict[str, int]]:
    def stage() -> dict[str, int]:
        try:
            return run()
        except PySparkException as e:
            raise error(str(e)) from e

    return stage


def stages(spark: SparkSession, config: Config, fetcher: http.Fetcher | None = None) -> list[Stage]:
    """All three; one that isn't configured does nothing."""
    check_plugins(config)
    made = [
        ("extract", ExtractError, config.extract and (lambda: crawl.crawl(spark, config.extract, fetcher))),
        ("transform", TransformError, config.transform and (lambda: transform(spark, config))),
        ("load", LoadError, config.load and (lambda: load(spark, config))),
    ]
    return [(name, _wrapped(error, run) if run else dict) for name, error, run in made]


def run(made: list[Stage], only: str | None = None) -> dict[str, dict[str, int]]:
    names = [name for name, _ in made]
    if not names:
        raise PipelineError("a pipeline needs a stage")
    if len(set(names)) != len(names):
        raise PipelineError("stages share a name")
    if only is not None and only not in names:
        raise PipelineError(f"no stage {only!r}; there are {', '.join(names)}")
    out = {}
    for name, stage in made:
        if only in (None, name):
            out[name] = stage()
            log.info("%s: %s", name, out[name])
    return out
