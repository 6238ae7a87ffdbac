"""Queries of the crawl: which requests follow from answers, what is stored of them, and the stream of price facts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config
from ..functions import text as X
from ..operators import scratch, store
from ..sources import crawl
from ..sources.scrapers import scraper
from ..streaming.prices import price_fact_stream

_NONE = "CAST(map() AS map<string,string>)"


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _map(**values: Column) -> Column:
    return F.create_map(*[x for k, v in values.items() for x in (F.lit(k), v.cast("string"))])


def _answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers of a shop's graph service: a tree of categories for each nation, pages of one for each supplier."""
    nation, supplier = _t(spark, sf_dir, "nation"), _t(spark, sf_dir, "supplier")
    tree = F.format_string('{"data": {"getCategory": [{"reference": "N%s"}, {"reference": ""}, {"reference": "M%s"}]}}', "n_nationkey", "n_nationkey")
    roots = nation.select(F.concat(F.lit("n"), "n_nationkey").alias("key"), _map(operationName=F.lit("GetCategoryTree"), variables=F.lit("{}")).alias("params"), tree.alias("body"))
    asked = F.format_string('{"getProductsByCategoryInput": {"categoryReference": "S%s", "currentPage": %s}}', "s_suppkey", F.col("s_suppkey") % 2 + 1)
    body = F.when(F.col("s_suppkey") % 7 == 0, "not json").otherwise(F.format_string('{"data": {"getProductsByCategory": {"pagination": {"pages": %s}}}}', F.col("s_suppkey") % 5))
    pages = supplier.select(F.concat(F.lit("s"), "s_suppkey").alias("key"), _map(operationName=F.lit("GetProductsByCategory"), variables=asked).alias("params"), body.alias("body"))
    return roots.unionByName(pages).withColumn("url", F.lit("https://shop.test/graph"))


def crawl_tree_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The category and page of each request that follows, and of how many answers none can be read (as a row without any)."""
    found = _answers(spark, sf_dir).select("key", F.explode_outer(scraper("realonline", "").following(5)).alias("n"))
    asked = F.try_parse_json(F.col("n.params")["variables"])
    get = lambda name, kind: F.try_variant_get(asked, f"$.getProductsByCategoryInput.{name}", kind)
    return found.select("key", get("categoryReference", "string").alias("reference"), get("currentPage", "int").alias("page"), get("pageSize", "int").alias("page_size"))


_TREE = """SELECT 'n' || n_nationkey AS key, x || n_nationkey AS reference, 1 AS page, 100 AS page_size FROM nation, (SELECT unnest(['N', 'M']) AS x)
  UNION ALL SELECT 's' || s_suppkey, CASE WHEN p IS NOT NULL THEN 'S' || s_suppkey END, CAST(p AS INTEGER), CASE WHEN p IS NOT NULL THEN 100 END FROM (
    SELECT s_suppkey, unnest(CASE WHEN s_suppkey % 7 <> 0 AND s_suppkey % 2 = 0 AND s_suppkey % 5 >= 2 THEN range(2, s_suppkey % 5 + 1) ELSE [NULL] END) AS p FROM supplier)"""


def crawl_tree_persisted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _answers(spark, sf_dir).select("key", scraper("realonline", "").persists().alias("kept"))


def crawl_feed_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The next request of three feeds, in the wording that is its identity: by sections, in a window, and an open one."""
    orders = _t(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_orderkey") % 8 * 1300).alias("at"), F.when(F.col("o_orderkey") % 3 == 0, 100).otherwise(F.col("o_orderkey") % 100).cast("int").alias("n"))
    body = F.when(F.col("o_orderkey") % 11 == 0, "<html>").otherwise(F.concat(F.lit('{"content_elements": ['), F.array_join(F.array_repeat(F.lit("{}"), F.col("n")), ","), F.lit("]}"))).alias("body")
    blobs = {"abc_color": '{"section_id": "/a b", "offset": "%s"}', "lanacion": '{"feedFrom": "%s"}', "latribuna": '{"offset": %s}'}
    made = []
    for name, blob in blobs.items():
        answers = orders.select("o_orderkey", F.lit("https://feed.test").alias("url"), _map(query=F.format_string(blob, "at")).alias("params"), body)
        made.append(answers.select(F.lit(name).alias("feed"), "o_orderkey", F.explode(scraper(name, "").following(2)).alias("n")).select("feed", "o_orderkey", F.col("n.params")["query"].alias("query")))
    return made[0].unionByName(made[1]).unionByName(made[2])


_FEEDS = """WITH o AS (SELECT o_orderkey, o_orderkey % 8 * 1300 AS off FROM orders WHERE o_orderkey % 3 = 0 AND o_orderkey % 11 <> 0)
  SELECT 'abc_color' AS feed, o_orderkey, '{"section_id": "/a b", "sort": "display_date:desc", "limit": "100", "offset": "' || (off + 100) || '"}' AS query FROM o
  UNION ALL SELECT 'lanacion', o_orderkey, '{"feedSize": "100", "feedFrom": "' || (off + k * 100) || '", "website": "lanacionpy", "feedQuery": "type:story"}' FROM o, (SELECT unnest([1, 2]) AS k) WHERE off + k * 100 + 100 <= 10000
  UNION ALL SELECT 'latribuna', o_orderkey, '{"query": "type:story", "offset": ' || (off + 100) || ', "size": 100}' FROM o"""


def text_without_nul(spark: SparkSession, sf_dir: str) -> DataFrame:
    nul = F.char(F.lit(0))
    dirty = F.concat(nul, F.substring("text", 1, 5), nul, nul, F.substring("text", 6, 1 << 30), nul)
    return _t(spark, sf_dir, "documents").select("doc_id", X.without_nul(dirty).alias("text"))


def bronze_snapshots_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers made of the pages, stored as a crawl stores them, and read back from the tables of pages and of failures."""
    folder = scratch.path(spark, "bronze")
    extract = config.from_mapping({"name": "site", "extract": {"scraper": "arete", "base_url": "http://s.test", "blocklist_tags": ["title"]}}, folder).extract
    status = F.when(F.col("page_id") % 10 == 0, 503).otherwise(200)
    answers = _t(spark, sf_dir, "pages").select(
        F.col("page_id").cast("string").alias("key"), "url", F.expr(_NONE).alias("params"), _map(**{"user-agent": F.lit("t")}).alias("request_headers"), status.alias("status_code"),
        _map(**{"content-type": F.lit("text/html")}).alias("response_headers"), F.lit("text/html").alias("content_type"), F.concat(F.lit("<title>t</title><p>"), "page_id").alias("body"), F.lit("2024-01-02 03:04:05").cast("timestamp").alias("fetched_at"),
    )
    crawl._store(answers.withColumn("target", store.route(F.col("status_code"), F.col("key").cast("long") % 4 != 3, "html")), extract, "html")
    kept = [crawl.snapshots(spark, folder, t).select(F.lit(t).alias("target"), "source", "request_url", "status_code", "content_type", "body", F.col("request_headers")["user-agent"].alias("agent"), "created_at") for t in ("html", "failed")]
    return kept[0].unionByName(kept[1])


_STORED = """SELECT CASE WHEN page_id % 10 = 0 THEN 'failed' ELSE 'html' END AS target, 'site' AS source, url AS request_url, CASE WHEN page_id % 10 = 0 THEN 503 ELSE 200 END AS status_code, 'text/html' AS content_type,
  CASE WHEN page_id % 10 = 0 THEN '<title>t</title><p>' || page_id ELSE '<p>' || page_id || '</p>' END AS body, 't' AS agent, TIMESTAMP '2024-01-02 03:04:05' AS created_at FROM pages WHERE page_id % 4 <> 3"""


def stream_fact_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The facts by the stream, over all events as they lie there; a row waits for its time, whatever batch it came in."""
    key, rocks = "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    before = spark.conf.get(key, None)
    spark.conf.set(key, rocks)
    try:
        events = spark.readStream.schema("event_id long, ts timestamp_ntz, user_id long, event_type string, value double").parquet(f"{sf_dir}/events.parquet*")
        silver = events.select(
            F.col("event_id").alias("id"), F.col("event_type").alias("source"), F.when(F.col("user_id") % 10 != 0, F.col("user_id").cast("string")).alias("sku"),
            (F.floor(F.col("value") / 50) * 50).cast("decimal(12,2)").alias("price"), F.date_trunc("day", "ts").alias("created_at"),
        )
        out = scratch.path(spark, "stream")
        query = price_fact_stream(silver, "0 seconds").writeStream.format("parquet").option("checkpointLocation", f"{out}-state").trigger(availableNow=True).start(out)
        query.awaitTermination()
    finally:
        spark.conf.set(key, before) if before is not None else spark.conf.unset(key)
    return spark.read.parquet(out).select("source", "sku", "id", "price", "observed_at")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    made = (crawl_tree_requests, crawl_tree_persisted, crawl_feed_requests, text_without_nul, bronze_snapshots_stored, stream_fact_price)
    return {f.__name__: f for f in made}


def oracle_sql(facts: str) -> dict[str, str]:
    """facts: the SQL of the batch facts, which the stream must give too."""
    return {
        "crawl_tree_requests": _TREE,
        "crawl_tree_persisted": "SELECT 'n' || n_nationkey AS key, FALSE AS kept FROM nation UNION ALL SELECT 's' || s_suppkey, TRUE FROM supplier",
        "crawl_feed_requests": _FEEDS,
        "text_without_nul": "SELECT doc_id, text FROM documents",
        "bronze_snapshots_stored": _STORED,
        "stream_fact_price": facts,
    }
