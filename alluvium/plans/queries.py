"""Registry of the queries of the core library and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import LoadError
from ..functions import text as X
from ..functions import url as U
from ..functions import values as V
from ..functions import variant as J
from ..functions.bodies import packed, unpacked
from ..functions.select import Pick, cleaned, pick
from ..operators import constraints, evolution, frontier, gold, scratch, store, tables
from . import crawling, parsing

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def _query(sql: str | None = None):
    def add(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: events stand in for silver products.
_S = """WITH s AS (SELECT event_id AS id, event_type AS source,
  CASE WHEN user_id % 10 = 0 THEN NULL ELSE CAST(user_id AS VARCHAR) END AS sku,
  CAST(floor(value / 50) * 50 AS DECIMAL(12,2)) AS price, date_trunc('day', ts) AS created_at FROM events) """


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"),
        F.col("event_type").alias("source"),
        F.when(F.col("user_id") % 10 != 0, F.col("user_id").cast("string")).alias("sku"),
        (F.floor(F.col("value") / 50) * 50).cast("decimal(12,2)").alias("price"),
        F.date_trunc("day", "ts").alias("created_at"),
    )


@_query(_S + """SELECT source, sku, l.price AS latest_price, l.name AS name, l.brand AS brand, first_seen_at, last_seen_at FROM (
  SELECT source, sku, arg_max(struct_pack(price := price, name := 'n' || CAST(id % 5 AS VARCHAR), brand := CASE WHEN id % 3 <> 0 THEN 'b' || CAST(id % 2 AS VARCHAR) END), (created_at, id)) AS l,
  min(created_at) AS first_seen_at, max(created_at) AS last_seen_at FROM s WHERE sku IS NOT NULL GROUP BY source, sku)""")
def gold_dim_product(spark, sf_dir):
    silver = _silver(spark, sf_dir).withColumns({"name": F.concat(F.lit("n"), (F.col("id") % 5).cast("string")), "brand": F.when(F.col("id") % 3 != 0, F.concat(F.lit("b"), (F.col("id") % 2).cast("string")))})
    return gold.dim_product(silver, ("price", "name", "brand")).withColumnRenamed("price", "latest_price")


_CHANGES = """SELECT *, lag(price) OVER (PARTITION BY source, sku ORDER BY created_at, id) AS prev,
  row_number() OVER (PARTITION BY source, sku ORDER BY created_at, id) AS n FROM s WHERE sku IS NOT NULL AND price IS NOT NULL"""


@_query(_S + f"SELECT source, sku, id, price, created_at FROM ({_CHANGES}) WHERE n = 1 OR price IS DISTINCT FROM prev")
def gold_price_changes(spark, sf_dir):
    return gold.price_changes(_silver(spark, sf_dir)).select("source", "sku", "id", "price", "created_at")


@_query(_S + f"""SELECT source, sku, id, price, created_at AS observed_at FROM (SELECT *, row_number() OVER (PARTITION BY source, sku, created_at ORDER BY id) AS rn
  FROM ({_CHANGES}) WHERE n = 1 OR price IS DISTINCT FROM prev) WHERE rn = 1""")
def gold_fact_price(spark, sf_dir):
    return gold.fact_price(_silver(spark, sf_dir)).select("source", "sku", "id", "price", "observed_at")


@_query(_S + """SELECT source, count(*) AS products, count(*) AS keys, count(*) FILTER (WHERE CAST(sku AS BIGINT) % 2 = 0) AS kept
  FROM (SELECT DISTINCT source, sku FROM s WHERE sku IS NOT NULL) GROUP BY source""")
def gold_keyed_dim(spark, sf_dir):
    dim = gold.dim_product(_silver(spark, sf_dir), ("price",))
    known = gold.with_product_keys(dim.where(F.col("sku").cast("long") % 2 == 0), start=1 << 40)
    keyed = gold.with_product_keys(dim, known).join(known.select("source", "sku", F.col("product_key").alias("old")), ["source", "sku"], "left")
    return keyed.groupBy("source").agg(F.count("*").alias("products"), F.countDistinct("product_key").alias("keys"), F.count_if(F.col("old") == F.col("product_key")).alias("kept"))


@_query(_S + f"""SELECT source, sku, id, price, created_at AS observed_at FROM (SELECT *, row_number() OVER (PARTITION BY source, sku, created_at ORDER BY id) AS rn
  FROM ({_CHANGES}) WHERE n = 1 OR price IS DISTINCT FROM prev) WHERE rn = 1""")
def gold_fact_with_keys(spark, sf_dir):
    """Facts joined with the dimension's keys, and the keys followed back to the products."""
    silver = _silver(spark, sf_dir)
    dim = gold.with_product_keys(gold.dim_product(silver, ("price",)))
    facts = gold.facts_with_keys(gold.fact_price(silver), dim).select("product_key", "id", "price", "observed_at")
    return facts.join(dim.select("product_key", "source", "sku"), "product_key").select("source", "sku", "id", "price", "observed_at")


# Rows of the last days, and a few earlier ones that come late.
_FRESH = "created_at >= TIMESTAMP '2024-01-29' OR id % 301 = 0"
_FACTS = "SELECT source, sku, id, price, created_at AS observed_at FROM (SELECT *, row_number() OVER (PARTITION BY source, sku, created_at ORDER BY id) AS rn FROM ({changes}) WHERE n = 1 OR price IS DISTINCT FROM prev) WHERE rn = 1"


@_query(_S + f""", o AS (SELECT * FROM s WHERE NOT ({_FRESH})), old AS ({_FACTS.format(changes=_CHANGES.replace("FROM s", "FROM o"))}), now AS ({_FACTS.format(changes=_CHANGES)})
  SELECT * FROM old UNION ALL SELECT * FROM now WHERE NOT EXISTS (SELECT 1 FROM old WHERE old.source = now.source AND old.sku = now.sku AND old.observed_at = now.observed_at)""")
def gold_incremental_facts(spark, sf_dir):
    """The facts after a first load and one of the fresh rows, late ones among them, as a load of everything gives them."""
    silver = _silver(spark, sf_dir)
    old, fresh = silver.where(f"NOT ({_FRESH})"), silver.where(_FRESH)
    cols = ("source", "sku", "id", "price", "observed_at")
    facts = scratch.written(gold.fact_price(old).select(*cols), "facts")
    found = gold.incremental_facts(fresh, gold.product_state(old), silver).select(*cols)
    known = facts.select("source", "sku", "observed_at")
    return facts.unionByName(found.join(known, ["source", "sku", "observed_at"], "left_anti").select(*cols))


@_query(_S + f"""SELECT source, sku, l.price AS price, l.id % 7 AS name, first_seen_at, last_seen_at FROM (SELECT source, sku, arg_max(struct_pack(price := price, id := id), (created_at, id)) AS l,
  min(created_at) AS first_seen_at, max(created_at) AS last_seen_at FROM s WHERE sku IS NOT NULL GROUP BY source, sku HAVING bool_or({_FRESH}))""")
def gold_incremental_dim(spark, sf_dir):
    """What a load of the fresh rows makes of the products they touch, late rows included."""
    silver = _silver(spark, sf_dir).withColumn("name", F.col("id") % 7)
    old = silver.where(f"NOT ({_FRESH})")
    return gold.incremental_dim(silver.where(_FRESH), gold.dim_product(old, ("price", "name")), gold.product_state(old), ("price", "name"))


@_query(_S + f"SELECT *, lead(observed_at) OVER (PARTITION BY source, sku ORDER BY observed_at) AS valid_to FROM ({_FACTS.format(changes=_CHANGES)})")
def gold_price_segments(spark, sf_dir):
    facts = gold.fact_price(_silver(spark, sf_dir)).select("source", "sku", "id", "price", "observed_at")
    return gold.price_segments(facts, ("source", "sku"))


_AS_OF = _S + f""", f AS ({_FACTS.format(changes=_CHANGES)}), q AS (SELECT event_id, event_type AS source, CASE WHEN user_id % 10 = 0 THEN NULL ELSE CAST(user_id AS VARCHAR) END AS sku, ts - INTERVAL 60 HOUR AS at FROM events)
  SELECT q.event_id, q.at, f.price, f.observed_at FROM q ASOF LEFT JOIN f ON q.source = f.source AND q.sku = f.sku AND q.at >= f.observed_at"""


def _asked(spark, sf_dir):
    events = _t(spark, sf_dir, "events")
    sku = F.when(F.col("user_id") % 10 != 0, F.col("user_id").cast("string"))
    return events.select("event_id", F.col("event_type").alias("source"), sku.alias("sku"), (F.col("ts") - F.expr("INTERVAL 60 HOURS")).alias("at"))


@_query(_AS_OF)
def gold_price_as_of(spark, sf_dir):
    facts = gold.fact_price(_silver(spark, sf_dir))
    return gold.price_as_of(_asked(spark, sf_dir), facts, ("source", "sku")).select("event_id", "at", "price", "observed_at")


@_query(_AS_OF)
def gold_price_as_of_hot(spark, sf_dir):
    """The same lookup with each product's time cut into weeks."""
    facts = gold.fact_price(_silver(spark, sf_dir))
    return gold.price_as_of_hot(_asked(spark, sf_dir), facts, "week", ("source", "sku")).select("event_id", "at", "price", "observed_at")


# Three versions of a table of orders: the first with other names and prices as text, the second without an origin.
_ORDERS = evolution.Chain(
    "id BIGINT, source_url STRING, total STRING, is_diff BOOLEAN",
    (
        (evolution.Rename("source_url", "request_url"), evolution.Drop("is_diff"), evolution.Change("total", "DECIMAL(12,2)")),
        (evolution.Add("origin", "STRING", lambda c: F.regexp_extract(c["request_url"], "^[a-z]*", 0)), evolution.Rename("id", "order_id")),
    ),
)


@_query("""SELECT o_orderkey AS order_id, 'from' || CAST(o_custkey AS VARCHAR) AS request_url, CASE WHEN o_orderkey % 3 = 0 AND o_orderkey % 5 = 0 THEN NULL ELSE CAST(round(o_totalprice, 2) AS DECIMAL(12,2)) END AS total,
  CASE WHEN o_orderkey % 3 = 2 THEN 'own' ELSE 'from' END AS origin FROM orders""")
def schema_versions_as_one(spark, sf_dir):
    """Rows written with three versions of the schema, read with the columns of the last."""
    path, third = scratch.path(spark, "evolved"), F.col("o_orderkey") % 3
    price = F.round("o_totalprice", 2).cast("decimal(12,2)")
    rows = _t(spark, sf_dir, "orders").select("o_orderkey", F.concat(F.lit("from"), F.col("o_custkey").cast("string")).alias("url"), price.alias("price"))
    wrong = F.when(F.col("o_orderkey") % 5 == 0, "unknown").otherwise(F.col("price").cast("string"))
    evolution.append(rows.where(third == 0).select(F.col("o_orderkey").alias("id"), F.col("url").alias("source_url"), wrong.alias("total"), F.lit(True).alias("is_diff")), path, evolution.Chain(_ORDERS.first))
    evolution.append(rows.where(third == 1).select(F.col("o_orderkey").alias("id"), F.col("url").alias("request_url"), F.col("price").alias("total")), path, evolution.Chain(_ORDERS.first, _ORDERS.steps[:1]))
    evolution.append(rows.where(third == 2).select(F.col("o_orderkey").alias("order_id"), F.col("url").alias("request_url"), F.col("price").alias("total"), F.lit("own").alias("origin")), path, _ORDERS)
    return evolution.read(spark, path, _ORDERS)


@_query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderkey % 4 = 0 AND o_custkey IN (SELECT c_custkey FROM customer)")
def store_checked_publication(spark, sf_dir):
    """A version that breaks a rule isn't published: the one before stays, and a third that keeps them takes its place."""
    path, orders = scratch.path(spark, "published"), _t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    customers = _t(spark, sf_dir, "customer")
    check = lambda rows: constraints.broken(rows, ["o_orderkey"], [["o_orderkey"]], [("o_custkey", customers, "c_custkey")])
    tables.replace(orders.where("o_orderkey % 2 = 0"), path, 0, check=check)
    try:
        tables.replace(orders.unionByName(orders), path, 1, check=check)
    except LoadError:
        tables.replace(orders.where("o_orderkey % 4 = 0"), path, tables.version(spark, path), check=check)
    return tables.current(spark, path, "o_orderkey BIGINT, o_custkey BIGINT, o_totalprice DOUBLE")


@_query(_S + "SELECT count(*) FILTER (WHERE sku IS NULL) AS null_skus FROM s")
def gold_null_sku_count(spark, sf_dir):
    return _silver(spark, sf_dir).agg(F.count_if(F.col("sku").isNull()).alias("null_skus"))


def _pages(spark, sf_dir):
    return _t(spark, sf_dir, "pages").select(F.col("page_id").alias("id"), F.when(F.col("page_id") % 2 == 0, "a").otherwise("b").alias("source"), "url")


def _parsed(spark, sf_dir):
    return _t(spark, sf_dir, "documents").select((F.col("doc_id") * 3).alias("bronze_id"), F.when(F.col("doc_id") % 4 < 2, "a").otherwise("b").alias("source"))


_UNPARSED = """WITH b AS (SELECT page_id AS id, CASE WHEN page_id % 2 = 0 THEN 'a' ELSE 'b' END AS source, url FROM pages),
  s AS (SELECT doc_id * 3 AS bronze_id, CASE WHEN doc_id % 4 < 2 THEN 'a' ELSE 'b' END AS source FROM documents)
  SELECT id, source, url FROM b WHERE source = 'a' AND NOT EXISTS (SELECT 1 FROM s WHERE s.bronze_id = b.id AND s.source = 'a')"""


@_query(_UNPARSED)
def bronze_unparsed(spark, sf_dir):
    return store.unparsed(_pages(spark, sf_dir), _parsed(spark, sf_dir), "a").select("id", "source", "url")


@_query("""SELECT DISTINCT event_type || '/' || CAST(user_id AS VARCHAR) AS request_url, CAST(user_id % 7 AS VARCHAR) AS page FROM events
  WHERE event_type = 'click' AND ts >= TIMESTAMP '2024-01-01' AND user_id % 5 <> 0""")
def bronze_visited(spark, sf_dir):
    b = _t(spark, sf_dir, "events").select(
        F.col("event_type").alias("source"),
        F.concat_ws("/", "event_type", F.col("user_id").cast("string")).alias("request_url"),
        F.create_map(F.lit("page"), (F.col("user_id") % 7).cast("string")).alias("request_params"),
        F.when(F.col("user_id") % 5 == 0, 503).otherwise(200).alias("status_code"),
        F.col("ts").alias("created_at"),
    )
    return store.visited(b, "click", F.lit("2024-01-01").cast("timestamp")).select("request_url", F.col("request_params")["page"].alias("page"))


@_query("""SELECT event_id, CASE WHEN event_type = 'click' THEN NULL WHEN user_id % 4 = 0 THEN 'failed' ELSE 'html' END AS target FROM events""")
def bronze_route_snapshots(spark, sf_dir):
    status = F.when(F.col("user_id") % 4 == 0, 503).otherwise(200)
    return _t(spark, sf_dir, "events").select("event_id", store.route(status, F.col("event_type") != "click", "html").alias("target"))


@_query("SELECT * FROM customer WHERE c_mktsegment = 'BUILDING' AND c_nationkey = 3")
def store_fetch_filtered(spark, sf_dir):
    return store.fetch(_t(spark, sf_dir, "customer"), c_mktsegment="BUILDING", c_nationkey=3)


@_query(_S + "SELECT id, source, price FROM s WHERE sku IS NULL")
def store_fetch_null(spark, sf_dir):
    return store.fetch(_silver(spark, sf_dir), sku=None).select("id", "source", "price")


@_query("""SELECT p_partkey, CASE WHEN count(c) OVER () = 0 THEN 'PYG' ELSE c END AS currency, CASE WHEN count(u) OVER () = 0 THEN 'un' ELSE u END AS unit, 7 AS batch
  FROM (SELECT p_partkey, CASE WHEN p_size > 25 THEN 'USD' END AS c, CAST(NULL AS VARCHAR) AS u FROM part)""")
def store_append_defaults(spark, sf_dir):
    rows = _t(spark, sf_dir, "part").select("p_partkey", F.when(F.col("p_size") > 25, "USD").alias("currency"), F.lit(None).cast("string").alias("unit"))
    return store.with_defaults(rows, {"currency": F.lit("PYG"), "unit": F.lit("un"), "batch": F.lit(7)})


@_query("""WITH t AS (SELECT c_custkey, c_name, c_acctbal FROM customer),
  r AS (SELECT s_suppkey * 40 AS c_custkey, s_name AS c_name, s_acctbal AS c_acctbal FROM supplier)
  SELECT coalesce(t.c_custkey, r.c_custkey) AS c_custkey, CASE WHEN t.c_custkey IS NULL THEN r.c_name ELSE t.c_name END AS c_name,
  CASE WHEN r.c_custkey IS NULL THEN t.c_acctbal ELSE r.c_acctbal END AS c_acctbal FROM t FULL JOIN r ON t.c_custkey = r.c_custkey""")
def store_upsert_update(spark, sf_dir):
    t = _t(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    r = _t(spark, sf_dir, "supplier").select((F.col("s_suppkey") * 40).alias("c_custkey"), F.col("s_name").alias("c_name"), F.col("s_acctbal").alias("c_acctbal"))
    return store.upsert_update(t, r, ["c_custkey"], ["c_acctbal"])


@_query("""WITH t AS (SELECT c_custkey * 2 AS o_custkey, c_custkey AS o_orderkey FROM customer),
  r AS (SELECT o_custkey, min(o_orderkey) AS o_orderkey FROM orders GROUP BY o_custkey)
  SELECT * FROM t UNION ALL SELECT * FROM r WHERE o_custkey NOT IN (SELECT o_custkey FROM t)""")
def store_upsert_nothing(spark, sf_dir):
    t = _t(spark, sf_dir, "customer").select((F.col("c_custkey") * 2).alias("o_custkey"), F.col("c_custkey").alias("o_orderkey"))
    return store.upsert_nothing(t, _t(spark, sf_dir, "orders").select("o_custkey", "o_orderkey"), ["o_custkey"], ["o_orderkey"])


@_query("SELECT event_id, coalesce(json_extract_string(props, '$.k'), '') AS content_type FROM events")
def header_backfill(spark, sf_dir):
    headers = F.from_json("props", "map<string,string>")
    return _t(spark, sf_dir, "events").select("event_id", store.backfilled(headers, "k").alias("content_type"))


# Addresses of pages with some made worse: other suffixes, repeated segments, capitals, tracking parameters.
_MADE = """SELECT page_id, CASE WHEN page_id % 3 = 0 THEN replace(head, 'http', 'HTTP') ELSE head END
  || CASE page_id % 7 WHEN 1 THEN '/file.PDF/' WHEN 2 THEN '/x/y/x' WHEN 3 THEN '/.pdf' WHEN 4 THEN '/a.b.js;v=1' ELSE '' END
  || CASE WHEN page_id % 2 = 0 THEN (CASE WHEN query = '' THEN '?' ELSE query || '&' END) || 'gclid=1&q=a%20b&empty=&utm_term' ELSE query END || fragment AS url FROM (
  SELECT page_id, regexp_extract(url, '^[^?#]*', 0) AS head, regexp_extract(url, '[?][^#]*', 0) AS query, regexp_extract(url, '#.*$', 0) AS fragment FROM pages)"""
_CANONICAL = f"""SELECT page_id, lower(regexp_extract(url, '^[^:]*://[^/?#]*', 0)) || path || CASE WHEN len(kept) > 0 THEN '?' || array_to_string(kept, '&') ELSE '' END AS canonical, path FROM (
  SELECT page_id, url, regexp_extract(url, '^[^:]*://[^/?#]*([^?#]*)', 1) AS path, list_transform(list_filter(string_split(regexp_extract(url, '[?]([^#]*)', 1), '&'),
    lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_(source|medium|campaign|content|term|id|name|reader)|fbclid|gclid|mc_eid|mc_cid|yclid|msclkid|_ga|_gl)(=|$)')),
    lambda p: CASE WHEN contains(p, '=') THEN p ELSE p || '=' END) AS kept FROM ({_MADE}))"""
_DOMAINS = ("blog.tionsh.example.net", "thther.example.org", "blog.ththan.example.net", "m.ththth.example.net", "www.ththhe.example.com")
_IGNORED = ("utm_", "gclid", "/en/4", "[?]page=")


def _made(spark, sf_dir):
    return spark.sql(_MADE.replace("FROM pages", "FROM {pages}"), pages=_t(spark, sf_dir, "pages"))


@_query(f"""SELECT page_id, regexp_extract(canonical, '^[^:]*://([^/?#]*)', 1) IN {_DOMAINS} AND NOT regexp_matches(canonical, 'utm_|gclid|/en/4|[?]page=') AND len(sg) = len(list_distinct(sg))
  AND NOT regexp_matches(coalesce(sg[-1], ''), '(?i)^.+\\.(pdf|jpg|jpeg|png|gif|svg|webp|css|js|zip|mp4|mp3|ico|woff|woff2|rss|xml|atom)(;.*)?$') AS enqueue
  FROM (SELECT page_id, canonical, list_filter(string_split(path, '/'), lambda x: x <> '') AS sg FROM ({_CANONICAL}))""")
def frontier_enqueue(spark, sf_dir):
    return _made(spark, sf_dir).select("page_id", U.should_enqueue(U.canonical(F.col("url")), _DOMAINS, _IGNORED).alias("enqueue"))


@_query("SELECT page_id, regexp_matches(url, '[13579]$') OR regexp_matches(url, 'utm_') AS persist FROM pages")
def frontier_persist(spark, sf_dir):
    return _t(spark, sf_dir, "pages").select("page_id", U.should_persist(F.col("url"), ("[13579]$", "utm_")).alias("persist"))


@_query("""WITH RECURSIVE e AS (SELECT c_custkey AS src, c_custkey * 2 AS dst FROM customer UNION ALL SELECT c_custkey, CAST(c_custkey * 3 % 101 AS BIGINT) FROM customer),
  r(node) AS (SELECT CAST(1 AS BIGINT) UNION SELECT e.dst FROM r JOIN e ON e.src = r.node) SELECT node FROM r""")
def frontier_bfs(spark, sf_dir):
    c = _t(spark, sf_dir, "customer")
    edges = c.select(F.col("c_custkey").alias("src"), (F.col("c_custkey") * 2).alias("dst")).union(c.select("c_custkey", (F.col("c_custkey") * 3 % 101).alias("dst")))
    return frontier.reachable(edges, spark.range(1, 2).withColumnRenamed("id", "node")).select("node")


@_query("""WITH RECURSIVE e AS (SELECT c_custkey AS src, c_custkey * 2 AS dst, 0 AS place FROM customer UNION ALL SELECT c_custkey, c_custkey * 7 % 113, 1 FROM customer UNION ALL SELECT c_custkey, c_custkey + 1, 2 FROM customer),
  r(node, level, path) AS (SELECT CAST(1 AS BIGINT), 0, CAST([] AS INTEGER[]) UNION ALL SELECT e.dst, level + 1, list_append(path, e.place) FROM r JOIN e ON e.src = r.node WHERE level < 7),
  met AS (SELECT node, min(level) AS level, arg_min(path, (level, path)) AS path FROM r GROUP BY node)
  SELECT node, level, rank FROM (SELECT node, level, row_number() OVER (ORDER BY level, path) AS rank FROM met) WHERE rank <= 100""")
def frontier_capped(spark, sf_dir):
    """The first 100 nodes of a walk by the order of discovery: a node's path of places from the seed orders it in its level."""
    key = F.col("c_custkey")
    links = F.inline(F.array(*[F.struct(dst.alias("dst"), F.lit(i).alias("place")) for i, dst in enumerate((key * 2, key * 7 % 113, key + 1))]))
    edges = _t(spark, sf_dir, "customer").select(key.alias("src"), links)
    seeds = spark.range(1, 2).select(F.col("id").alias("node"), F.lit(0).alias("place"))
    return frontier.reachable(edges, seeds, max_pages=100, max_levels=7)


@_query(f"SELECT page_id, canonical FROM ({_CANONICAL})")
def url_canonicalize(spark, sf_dir):
    return _made(spark, sf_dir).select("page_id", U.canonical(F.col("url")).alias("canonical"))


@_query("""SELECT page_id, CAST(nth - 1 AS INTEGER) AS nth, regexp_extract(url, '^[^:]*://[^/?#]*', 0) || href AS link FROM (
  SELECT page_id, url, unnest(hrefs) AS href, generate_subscripts(hrefs, 1) AS nth FROM (SELECT page_id, url, regexp_extract_all(html, '<a [^>]*href="([^"]*)"', 1) AS hrefs FROM pages))""")
def page_links(spark, sf_dir):
    found = _t(spark, sf_dir, "pages").select("page_id", "url", pick(F.col("html"), links=Pick("a[href]", attr="href"))["links"].alias("links"))
    site = F.regexp_extract("url", "^[^:]*://[^/?#]*", 0)
    return found.select("page_id", F.posexplode(U.join_site("url", site, "links")).alias("nth", "link"))


_PLAIN = "replace(replace(replace(replace(replace(replace(replace({x}, '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#x27;', chr(39)), '&copy;', chr(169)), '&middot;', chr(183)), '&amp;', '&')"


_TRIMMED = f"regexp_replace({_PLAIN}, '^\\s+|\\s+$', '', 'g')"
_NO_SCRIPTS = "regexp_replace(regexp_replace(html, '<!--.*?-->', '', 'gs'), '<(script|style|noscript)[ >].*?</(script|style|noscript)>', '<x>', 'gs')"


@_query(f"""SELECT page_id, array_to_string(list_filter(list_transform(string_split_regex({_NO_SCRIPTS}, '<[^>]*>'), lambda x: {_TRIMMED.format(x='x')}), lambda x: x <> ''), ' ') AS text,
  {_TRIMMED.format(x="regexp_extract(html, '<h1>([^<]*)</h1>', 1)")} AS h1 FROM pages""")
def pages_text(spark, sf_dir):
    read = pick(F.col("html"), text=Pick(""), h1=Pick("h1", first=True))
    return _t(spark, sf_dir, "pages").select("page_id", read.alias("p")).select("page_id", F.get("p.text", F.lit(0)).alias("text"), F.coalesce(F.get("p.h1", F.lit(0)), F.lit("")).alias("h1"))


@_query()
def pages_clean(spark, sf_dir):
    return _t(spark, sf_dir, "pages").select("page_id", cleaned(F.col("html")).alias("clean"))


@_query("""SELECT page_id, replace(replace(replace(replace(replace(trim(regexp_extract(html, '<title>([^<]*)</title>', 1)), '&lt;', '<'), '&gt;', '>'),
  '&quot;', '"'), '&#x27;', chr(39)), '&amp;', '&') AS title FROM pages""")
def page_titles(spark, sf_dir):
    return _t(spark, sf_dir, "pages").select("page_id", F.coalesce(F.get(pick(F.col("html"), title=Pick("title", first=True))["title"], F.lit(0)), F.lit("")).alias("title"))


@_query("SELECT r_regionkey, unnest(generate_series(2, r_regionkey * 2)) AS page FROM region")
def pagination_pages(spark, sf_dir):
    total = (F.col("r_regionkey") * 2).cast("int")
    return _t(spark, sf_dir, "region").select("r_regionkey", F.explode((frontier.pages_after_first(total, F.lit(1))).cast("array<bigint>")).alias("page"))


@_query("SELECT r_regionkey, unnest(range(50, r_regionkey * 60, 50)) AS skip FROM region")
def pagination_offsets(spark, sf_dir):
    count = (F.col("r_regionkey") * 60).cast("int")
    return _t(spark, sf_dir, "region").select("r_regionkey", F.explode((frontier.offsets_by_count(count, F.lit(0), 50)).cast("array<bigint>")).alias("skip"))


@_query("SELECT r_regionkey, CAST(300 + r_regionkey * 100 + 100 AS BIGINT) AS o FROM region WHERE r_regionkey * 40 >= 100")
def pagination_full(spark, sf_dir):
    at, got = (F.lit(300) + F.col("r_regionkey") * 100).cast("int"), F.col("r_regionkey") * 40
    return _t(spark, sf_dir, "region").select("r_regionkey", F.explode((frontier.offset_if_full(at, got, 100)).cast("array<bigint>")).alias("o"))


@_query("SELECT r_regionkey, o FROM (SELECT r_regionkey, unnest(list_transform(range(1, 6), lambda k: 9200 + r_regionkey * 100 + k * 100)) AS o FROM region) WHERE o + 100 <= 10000")
def pagination_speculative(spark, sf_dir):
    at = (F.lit(9200) + F.col("r_regionkey") * 100).cast("int")
    return _t(spark, sf_dir, "region").select("r_regionkey", F.explode((frontier.speculative_offsets(at, F.lit(100), 100, 5, 10_000)).cast("array<bigint>")).alias("o"))


@_query("""WITH o AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE o_orderpriority END AS pr FROM orders)
  SELECT 'pr is not null' AS rule, count(*) FILTER (WHERE pr IS NULL) AS rows FROM o UNION ALL SELECT 'o_orderkey is not null', count(*) FILTER (WHERE o_orderkey IS NULL) FROM o
  UNION ALL SELECT 'unique o_orderkey', count(*) - count(DISTINCT o_orderkey) FROM o UNION ALL SELECT 'unique o_custkey, pr', count(*) - count(DISTINCT (o_custkey, pr)) FROM o WHERE pr IS NOT NULL
  UNION ALL SELECT 'o_custkey is known', count(*) FROM o WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_nationkey < 20)""")
def schema_constraints(spark, sf_dir):
    orders = _t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.when(F.col("o_orderkey") % 9 != 0, F.col("o_orderpriority")).alias("pr"))
    customers = _t(spark, sf_dir, "customer").where("c_nationkey < 20")
    return constraints.broken(orders, ["pr", "o_orderkey"], [["o_orderkey"], ["o_custkey", "pr"]], [("o_custkey", customers, "c_custkey")])


_NAME = "p_name || ' ' || CAST(p_size AS VARCHAR) || CASE p_partkey % 7 WHEN 0 THEN ' KG' WHEN 1 THEN 'lt' WHEN 2 THEN ' ml' WHEN 3 THEN 'GRS' WHEN 4 THEN 'cc' WHEN 5 THEN 'UN' ELSE ' L' END"


@_query("SELECT p_partkey, CASE p_partkey % 7 WHEN 0 THEN 'kg' WHEN 1 THEN 'l' WHEN 2 THEN 'ml' WHEN 3 THEN 'g' WHEN 4 THEN 'cc' WHEN 6 THEN 'l' END AS unit FROM part")
def unit_from_name(spark, sf_dir):
    return _t(spark, sf_dir, "part").select("p_partkey", X.unit_from_name(F.expr(_NAME.replace("VARCHAR", "STRING"))).alias("unit"))


@_query("SELECT p_partkey, CAST(CAST(floor(p_retailprice * 1000) AS BIGINT) AS DECIMAL(12,2)) AS price FROM part")
def price_from_text(spark, sf_dir):
    dotted = F.regexp_replace(F.floor(F.col("p_retailprice") * 1000).cast("string"), r"(?<=\d)(?=(\d{3})+$)", ".")
    return _t(spark, sf_dir, "part").select("p_partkey", V.price_from_text(F.concat(F.lit("Precio ₲. "), dotted, F.lit(" c/u"))).alias("price"))


@_query("SELECT p_partkey, CAST(CAST(p_size AS DECIMAL(20,6)) / CASE p_partkey % 3 WHEN 0 THEN 1 WHEN 1 THEN 10 ELSE 100 END AS DECIMAL(12,2)) AS price FROM part")
def price_minor_units(spark, sf_dir):
    return _t(spark, sf_dir, "part").select("p_partkey", V.price_minor_units(F.col("p_size").cast("string"), F.col("p_partkey") % 3).alias("price"))


@_query("SELECT p_partkey, CAST(nullif(trunc(CASE WHEN p_partkey % 2 = 0 AND p_size % 3 <> 0 THEN p_size ELSE p_retailprice END), 0) AS DECIMAL(12,2)) AS price FROM part")
def price_offer_rule(spark, sf_dir):
    offer = F.when(F.col("p_size") % 3 != 0, F.col("p_size").cast("double")).otherwise(F.lit(0.0))
    return _t(spark, sf_dir, "part").select("p_partkey", V.price_offer(F.col("p_retailprice"), offer, F.col("p_partkey") % 2 == 0).alias("price"))


@_query("SELECT p_partkey, CAST(coalesce(CASE WHEN p_partkey % 2 = 0 THEN p_size % 5 END, p_size) AS DECIMAL(12,2)) AS price FROM part")
def price_promo_rule(spark, sf_dir):
    promo = F.when(F.col("p_partkey") % 2 == 0, F.col("p_size") % 5)
    return _t(spark, sf_dir, "part").select("p_partkey", V.price_promo(F.col("p_size"), promo).alias("price"))


@_query("SELECT p_partkey, trim(regexp_replace(lower(strip_accents(p_name || ' Ñandú')), '[^a-z0-9]+', '-', 'g'), '-') AS slug FROM part")
def slugify_name(spark, sf_dir):
    return _t(spark, sf_dir, "part").select("p_partkey", X.slugify(F.concat("p_name", F.lit(" Ñandú"))).alias("slug"))


@_query("SELECT o_orderkey, date_trunc('day', o_orderdate) + INTERVAL 15 HOUR + INTERVAL 5 MINUTE AS published_at FROM orders")
def spanish_date(spark, sf_dir):
    d = F.col("o_orderdate")
    month = F.element_at(F.array(*[F.lit(m.capitalize()) for m in V.MONTHS]), F.month(d))
    shown = F.concat(F.lit("Publicado: "), month, F.lit(" "), F.dayofmonth(d).cast("string"), F.lit(", "), F.year(d).cast("string"), F.lit(" 03:05 p. m."))
    return _t(spark, sf_dir, "orders").select("o_orderkey", V.spanish_date(shown).alias("published_at"))


@_query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN TIMESTAMP '2020-01-02 06:04:05' ELSE date_trunc('day', o_orderdate) END AS published_at FROM orders")
def date_coalesce(spark, sf_dir):
    first = F.when(F.col("o_orderkey") % 3 == 0, "2020-01-02T03:04:05-03:00").otherwise("not a date")
    second = F.date_format("o_orderdate", "yyyy-MM-dd")
    return _t(spark, sf_dir, "orders").select("o_orderkey", F.coalesce(V.iso_timestamp(first), V.iso_timestamp(second)).alias("published_at"))


@_query("""SELECT o_orderkey, date_trunc('day', o_orderdate) + CASE o_orderkey % 6 WHEN 0 THEN INTERVAL 904 MINUTE WHEN 1 THEN INTERVAL 0 MINUTE WHEN 2 THEN INTERVAL 540 MINUTE WHEN 3 THEN INTERVAL 1112 MINUTE WHEN 4 THEN INTERVAL 0 MINUTE ELSE INTERVAL 545 MINUTE END AS published_at FROM orders""")
def date_free_form(spark, sf_dir):
    """Days and times in six forms that no pattern of a list has: words, ordinals, other orders, zones."""
    d = F.col("o_orderdate")
    form = lambda f: F.date_format(d, f)
    day = F.dayofmonth(d)
    ordinal = F.concat(day.cast("string"), F.when(day.isin(1, 21, 31), "st").when(day.isin(2, 22), "nd").when(day.isin(3, 23), "rd").otherwise("th"))
    forms = [
        F.concat(F.lit("the "), ordinal, F.lit(" of "), form("MMMM yyyy"), F.lit(" at 3:04pm")), form("yyyy-MMM-dd"), F.concat(form("EEEE, MMM. "), ordinal, form(", yyyy"), F.lit(" 9 a.m.")),
        F.concat(F.lit("15:32 UTC-3 "), form("d MMM yyyy")), form("dd-MMM-yyyy"), F.concat(form("yyyyMMdd"), F.lit("T0905")),
    ]
    shown = F.element_at(F.array(*forms), (F.col("o_orderkey") % 6 + 1).cast("int"))
    return _t(spark, sf_dir, "orders").select("o_orderkey", V.free_timestamp(shown).alias("published_at"))


@_query("SELECT page_id, html AS body FROM pages WHERE page_id % 5 = 0")
def bronze_packed_bodies(spark, sf_dir):
    """Bodies stored as zstd frames in a BINARY column; only those of the rows that are asked for are decoded."""
    pages = _t(spark, sf_dir, "pages").select("page_id", packed(F.col("html")).alias("body"))
    return scratch.written(pages, "packed").withColumn("body", unpacked(F.col("body"))).where("page_id % 5 = 0")


@_query("""SELECT p_partkey, '<div class="k">' || p_name || ' &lt;b&gt;<p id="' || CAST(p_partkey AS VARCHAR) || '">' || CASE WHEN p_partkey % 2 = 0 THEN '<img src="i">' ELSE '' END || p_brand || '</p></div>' AS clean FROM part""")
def pages_clean_made(spark, sf_dir):
    """Made pages lose comments, scripts, blocked tags with all in them, and blocked attributes."""
    page = F.concat(F.lit("<!-- c --><div onclick='x()' class='k'>"), "p_name", F.lit(" &lt;b&gt;<script>s()</script><nav><a href='/'>n</a></nav><p id='"), F.col("p_partkey").cast("string"), F.lit("' style=\"a\">"),
        F.when(F.col("p_partkey") % 2 == 0, "<img src=i>").otherwise(""), "p_brand", F.lit("<!-- " + "x" * 9 + " --></p><noscript>y</noscript></div>"))
    return _t(spark, sf_dir, "part").select("p_partkey", cleaned(page, ("nav", "script", "nav"), ("onclick", "style")).alias("clean"))


@_query("SELECT l_orderkey, l_partkey, l_quantity FROM lineitem")
def json_items_explode(spark, sf_dir):
    item = F.struct("l_partkey", "l_quantity")
    bodies = _t(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.to_json(F.struct(F.collect_list(item).alias("items"))).alias("body"))
    items = F.from_json("body", "items array<struct<l_partkey:bigint,l_quantity:double>>")["items"]
    return bodies.select("l_orderkey", F.inline(items))


@_query("SELECT p_partkey, CASE WHEN p_partkey % 3 = 2 THEN NULL ELSE p_brand END AS brand FROM part")
def json_polymorphic_brand(spark, sf_dir):
    body = F.when(F.col("p_partkey") % 3 == 0, F.to_json(F.struct(F.struct(F.col("p_brand").alias("name")).alias("brand")))).when(F.col("p_partkey") % 3 == 1, F.to_json(F.struct(F.col("p_brand").alias("brand")))).otherwise('{"brand": [1]}')
    v = F.try_parse_json(body)
    return _t(spark, sf_dir, "part").select("p_partkey", F.coalesce(J.name(v, "$.brand"), J.name(v, "$.brand.name")).alias("brand"))


@_query("SELECT event_id, array_to_string(CASE WHEN user_id % 3 = event_id % 2 THEN ['http://i/' || (user_id % 3)] ELSE ['http://i/' || (user_id % 3), 'http://i/' || (event_id % 2)] END, ' ') AS images FROM events")
def images_dedup(spark, sf_dir):
    u = lambda c: F.concat(F.lit("http://i/"), c.cast("string"))
    inline, promo = F.array(u(F.col("user_id") % 3), F.lit("")), F.array(u(F.col("event_id") % 2), u(F.col("user_id") % 3))
    return _t(spark, sf_dir, "events").select("event_id", F.array_join(U.ordered_distinct(inline, promo), " ").alias("images"))


@_query("SELECT doc_id, array_to_string(list_filter(list_transform(string_split(source || ', ,' || coalesce(lang, ''), ','), lambda x: trim(x)), lambda x: x <> ''), '|') AS tags FROM documents")
def keywords_split(spark, sf_dir):
    return _t(spark, sf_dir, "documents").select("doc_id", F.array_join(X.keywords(F.concat("source", F.lit(", ,"), F.coalesce("lang", F.lit("")))), "|").alias("tags"))


@_query("SELECT source, count(*) AS processed, count(*) FILTER (WHERE n_chars < 200) AS skipped, CAST(sum(n_chars) AS BIGINT) AS chars FROM documents GROUP BY source")
def run_counters(spark, sf_dir):
    return _t(spark, sf_dir, "documents").groupBy("source").agg(F.count("*").alias("processed"), F.count_if(F.col("n_chars") < 200).alias("skipped"), F.sum("n_chars").alias("chars"))


def queries() -> dict[str, Query]:
    return _QUERIES | crawling.queries() | parsing.queries()


def oracle_sql() -> dict[str, str]:
    return _SQL | crawling.oracle_sql(_SQL["gold_fact_price"]) | parsing.oracle_sql()
