"""The crawl of one source, level by level: fetch, store, find the next requests, drop those seen."""

from __future__ import annotations

import datetime as dt
import logging
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Extract
from ..errors import ExtractError
from ..functions import select
from ..functions import url as U
from ..operators import frontier, store, tables
from ..schemas import SNAPSHOT
from . import http
from .scrapers import scraper

log = logging.getLogger(__name__)

TABLES = {"html": "bronze/html_snapshots", "api": "bronze/api_snapshots", "failed": "bronze/failed_snapshots"}
#: A source may store so many bits of snapshots; with the items of a body (20 bits), 13 bits are left for sources.
SPACE_BITS = 30
_REQUEST = "url string, params map<string,string>"


def snapshots(spark: SparkSession, folder: str, model: str) -> DataFrame:
    return tables.read(spark, f"{folder}/{TABLES[model]}", SNAPSHOT)


def _written(rows: DataFrame, path: str) -> DataFrame:
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _first_met(requests: DataFrame) -> DataFrame:
    """key, url, params, parent, place: each request once, by its first discovery."""
    keyed = requests.withColumn("key", U.request_key(F.col("url"), F.col("params")))
    by = F.struct("parent", "place")
    return keyed.groupBy("key").agg(F.min_by(F.struct("url", "params"), by).alias("request"), F.min(by).alias("by")).select("key", "request.*", "by.*")


def _store(answers: DataFrame, e: Extract, model: str) -> None:
    """Appends answers to the tables their `target` names. Ids go on from the source's largest, in the source's own
    space of numbers, so sources that are crawled at once don't share any."""
    spark = answers.sparkSession
    first = tables.space(spark, e.store, e.source) << SPACE_BITS
    page = select.cleaned(F.col("body"), e.blocklist_tags, e.blocklist_attributes) if model == "html" else F.col("body")
    for target in (model, "failed"):
        path = f"{e.store}/{TABLES[target]}"
        last = snapshots(spark, e.store, target).where(F.col("source") == e.source).agg(F.coalesce(F.max("id"), F.lit(first)).alias("last")).first()["last"]
        if last - first >= (1 << SPACE_BITS) * 9 // 10:
            raise ExtractError(f"{e.source}: the source's space of snapshot ids is nearly used up")
        rows = tables.numbered(answers.where(F.col("target") == target), ["key"], "id", F.lit(last)).select(
            "id", F.col("url").alias("request_url"), "request_headers", F.col("params").alias("request_params"),
            "status_code", "response_headers", "content_type", (page if target == model else F.col("body")).alias("body"), F.col("fetched_at").cast("timestamp_ntz").alias("created_at"),
        )
        store.append(rows, path, source=e.source)


def crawl(spark: SparkSession, e: Extract, fetcher: http.Fetcher | None = None, since: dt.datetime | None = None) -> dict[str, int]:
    """Fetches what the source's scraper asks for, at most e.max_pages answers (-1: all); returns counts.

    Requests that succeeded since `since` (midnight UTC) aren't made again, seeds included. Requests have the order of their
    discovery (their first parent's, then the link's place in it), and under a cap the first ones are made. Answers of a
    level are written before anything follows from them, so a lost executor repeats at most its own requests. What was seen
    lies in buckets by key and isn't shuffled again. Answers other than 2xx go to the failed table and lead nowhere.
    """
    plan = scraper(e.scraper.rsplit(".", 1)[-1], e.base_url)
    fetcher = fetcher or http.getter(e.timeout_seconds, e.follow_redirects, plan.ciphers)
    since = since or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None, hour=0, minute=0, second=0, microsecond=0)
    work = f"{e.store}/crawl/{e.source}-{uuid.uuid4().hex}"
    done = store.visited(snapshots(spark, e.store, plan.model), e.source, F.lit(since))
    seen = frontier.Seen(spark, "key", f"{work}/seen")
    seen.add(done.select(U.request_key(F.col("request_url"), F.col("request_params")).alias("key")), -1)
    asked = spark.createDataFrame([(e.base_url, p, 0, i) for i, p in enumerate(plan.seeds())], f"{_REQUEST}, parent long, place int")
    counts = {"fetched": 0, "stored": 0, "failed": 0, "broken": 0}
    level = 0
    while True:
        new = tables.ranked(seen.unseen(_first_met(asked)), ["parent", "place", "key"], "rank", counts["fetched"])
        now = _written(new.where(F.col("rank") <= e.max_pages) if e.max_pages >= 0 else new, f"{work}/asked-{level}")
        if seen.add(now.select("key"), level) == 0:
            break
        answers = _written(http.fetch_all(now, fetcher, dict(e.headers), e.concurrency, e.request_delay), f"{work}/answers-{level}")
        good = F.col("status_code").between(200, 299)
        kept = U.should_persist(F.col("url"), e.scrape_patterns)
        if plan.persists is not None:
            kept = kept & plan.persists()
        routed = answers.withColumn("target", store.route(F.col("status_code"), F.coalesce(kept, F.lit(False)), plan.model))
        _store(routed, e, plan.model)
        found = _written(answers.where(good).select("key", plan.following(e.concurrency).alias("next")), f"{work}/next-{level}")
        n = routed.agg(F.count("*").alias("fetched"), F.count_if(F.col("target") == plan.model).alias("stored"), F.count_if(F.col("target") == "failed").alias("failed")).first()
        counts = {k: v + (n[k] if k in n else 0) for k, v in counts.items()}
        counts["broken"] += found.where("next IS NULL").count()
        linked = found.join(now.select("key", F.col("rank").alias("parent")), "key").select("parent", F.posexplode("next").alias("place", "n"))
        asked = linked.select("n.url", "n.params", "parent", "place")
        if plan.model == "html":
            asked = asked.withColumn("url", U.canonical(F.col("url"))).where(U.should_enqueue(F.col("url"), e.allowed_domains, e.ignore_patterns))
        level += 1
    seen.drop()
    fs, path = tables._folder(spark, work)
    fs.delete(path, True)
    log.info("extract[%s]: %s", e.source, counts)
    return counts
