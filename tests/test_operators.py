"""Store, address and frontier rules on hand-made rows."""

import datetime as dt
import pathlib
import random
from urllib.parse import urlsplit

import pytest
import zstandard
from pyspark.sql import functions as F

from alluvium import schemas
from alluvium.functions import url as U
from alluvium.functions.bodies import packed, unpacked
from alluvium.functions.values import iso_timestamp, spanish_date
from alluvium.operators import constraints, frontier, store, tables
from alluvium.schemas import SNAPSHOT
from alluvium.sources import base, parsers


def test_upsert_with_a_repeated_key_fails(spark):
    table = spark.createDataFrame([(1, "a", 1.0)], "k int, name string, x double")
    rows = spark.createDataFrame([(1, "b", 2.0), (2, "c", 3.0), (None, "d", 4.0), (None, "e", 5.0)], "k int, name string, x double")
    got = sorted(map(repr, (tuple(r) for r in store.upsert_update(table, rows, ["k"], ["x"]).collect())))
    assert got == sorted(map(repr, [(1, "a", 2.0), (2, "c", 3.0), (None, "d", 4.0), (None, "e", 5.0)]))
    with pytest.raises(Exception, match="several rows with key"):
        store.upsert_update(table, rows.unionByName(rows.where("k = 2")), ["k"], ["x"]).collect()


def test_defaults_fill_what_no_row_sets(spark):
    rows = spark.createDataFrame([(1, None, None), (2, "x", None)], "id int, a string, b string")
    got = store.with_defaults(rows, {"a": F.lit("A"), "b": F.lit("B"), "c": F.lit("C")}).orderBy("id").collect()
    assert [tuple(r) for r in got] == [(1, None, "B", "C"), (2, "x", "B", "C")]


def test_route(spark):
    rows = spark.createDataFrame([(200, True), (503, True), (0, True), (200, False), (503, False)], "s int, keep boolean")
    got = rows.select("s", "keep", store.route(F.col("s"), F.col("keep"), "html").alias("to")).collect()
    assert [r["to"] for r in got] == ["html", "failed", "failed", None, None]


def test_required_columns():
    assert constraints.required(schemas.FACT_PRICE) == ["id", "product_key", "price", "observed_at"]
    assert constraints.required(schemas.SNAPSHOT)[:5] == ["id", "source", "request_url", "request_headers", "request_params"]
    assert constraints.required("a BIGINT, b STRING") == []


URLS = ["/file.pdf/", "/.pdf", "/a/..pdf", "/a/file.PDF", "/a/b.tar.gz", "/a/file.", "/", "", "/a/./", "/a.b/c", "/x.js/.", "/ñ.mp4"]


def test_extension_is_the_path_suffix(spark):
    rows = spark.createDataFrame([(f"https://h.test{u}?q=1.css#f.css",) for u in URLS], "u string")
    got = [r[0] for r in rows.select(U.extension(F.col("u"))).collect()]
    # what a name that ends in a dot has differs between Python's versions: here it is none
    assert got == ["" if u.endswith(".") and not u.endswith("/.") else pathlib.PurePosixPath(urlsplit(f"https://h.test{u}").path).suffix.lower() for u in URLS]


def test_canonical_keeps_hosts_and_other_schemes(spark):
    cases = {"//CDN.test/x": "//cdn.test/x", "mailto:a@b.test": "mailto:a@b.test", "HTTPS://Example.Test/A?id=1&utm_source=f&fbclid=z#top": "https://example.test/A?id=1", "/a?b=%20c&d": "/a?b=%20c&d="}
    rows = spark.createDataFrame([(u,) for u in cases], "u string")
    assert {r[0]: r[1] for r in rows.select("u", U.canonical(F.col("u"))).collect()} == cases


def test_ignored_patterns_see_the_canonical_address(spark):
    rows = spark.createDataFrame([("https://h.test/ofertas?utm_source=a",), ("https://h.test/x?utm_source=a",), ("https://h.test/a/b/a",), ("https://o.test/x",), ("mailto:x@h.test",)], "u string")
    got = [r[0] for r in rows.select(U.should_enqueue(U.canonical(F.col("u")), ("h.test",), ("/ofertas$",))).collect()]
    assert got == [False, True, False, False, False]


def test_deep_crawls_go_on(spark):
    """A chain longer than any fixed number of levels; and one cut by max_levels, one by a cap."""
    chain = spark.range(40).selectExpr("id AS src", "id + 1 AS dst", "0 AS place")
    seeds = spark.range(1).selectExpr("id AS node", "0 AS place")
    assert frontier.reachable(chain, seeds).count() == 41
    assert frontier.reachable(chain, seeds, max_levels=3).count() == 4
    capped = frontier.reachable(chain, seeds, max_pages=5).collect()
    assert sorted((r["node"], r["level"], r["rank"]) for r in capped) == [(i, i, i + 1) for i in range(5)]
    assert frontier.reachable(chain, seeds, max_pages=0).count() == 0


def test_the_order_of_discovery(spark):
    """Against a queue: several seeds, links that repeat, cycles, and caps that cut a level."""
    rng = random.Random(4)
    links = {n: [rng.randrange(60) for _ in range(rng.randrange(5))] for n in range(60)}
    edges = spark.createDataFrame([(n, d, i) for n, ds in links.items() for i, d in enumerate(ds)], "src long, dst long, place int")
    seeds = [7, 3, 44]
    for cap in (2, 3, 11, 30, 1000):
        queue, seen = list(seeds), set(seeds)
        for n in queue:
            for d in links[n]:
                if d not in seen:
                    seen.add(d)
                    queue.append(d)
        got = frontier.reachable(edges, spark.createDataFrame(list(zip(seeds, range(3))), "node long, place int"), max_pages=cap).collect()
        assert [r["node"] for r in sorted(got, key=lambda r: r["rank"])] == queue[:cap]
        assert sorted(r["rank"] for r in got) == list(range(1, len(got) + 1))


def test_what_was_seen_is_not_shuffled(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        seen = frontier.Seen(spark, "node")
        assert seen.add(spark.range(500).selectExpr("id AS node"), 0) == 500 and seen.add(spark.range(500, 700).selectExpr("id AS node"), 1) == 200
        left = seen.unseen(spark.range(650, 800).selectExpr("id AS node").distinct())
        assert left.count() == 100 and seen.rows(1).count() == 200
        shown = left._jdf.queryExecution().executedPlan().toString()
        scan = shown[: shown.index("alluvium_seen")]
        assert shown.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in shown and scan.rindex("FileScan") > scan.rindex("Exchange")
        seen.drop()
        assert not spark.catalog.tableExists(seen.table)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_ranks_are_gapless_and_in_order(spark):
    rows = spark.range(1000).selectExpr("(id * 7919) % 1000 AS x", "id").repartition(5)
    got = tables.ranked(rows, ["x", "id"], "rank", start=10).collect()
    assert [r["rank"] for r in sorted(got, key=lambda r: (r["x"], r["id"]))] == list(range(11, 1011))
    assert tables.ranked(rows.limit(0), ["x"], "rank").count() == 0


def test_too_many_items_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(base, "ITEMS", 2)
    now = dt.datetime(2026, 1, 2, 3, 4, 5)
    bodies = ('{"items": [{"name": "a"}, {"name": "b"}]}', '{"items": [{"name": "a"}, {"name": "b"}, {"name": "c"}]}')
    rows = spark.createDataFrame([(i, "biggie", "https://x.test/a", {}, {}, 200, {}, "", b, now) for i, b in enumerate(bodies)], SNAPSHOT)
    assert parsers()["biggie"].parse(rows.where("id = 0")).count() == 2
    with pytest.raises(Exception, match="more than 2 items in snapshot 1"):
        parsers()["biggie"].parse(rows).collect()


def test_dates_of_every_form(spark):
    cases = {
        "May 5, 2024": "2024-05-05 00:00:00", "September 5, 2024 3:04 PM": "2024-09-05 15:04:00", "Sep 5, 2024 15:04:05": "2024-09-05 15:04:05", "5 Sep 2024": "2024-09-05 00:00:00",
        "05 September 2024 03:04:05 +0300": "2024-09-05 00:04:05", "1/2/2024": "2024-01-02 00:00:00", "13/2/2024": "2024-02-13 00:00:00", "2024/2/3 4:05": "2024-02-03 04:05:00",
        "20240203": "2024-02-03 00:00:00", "Mon, 05 Feb 2024 10:00:00 GMT": "2024-02-05 10:00:00", "2024-02-03T04:05:06Z": "2024-02-03 04:05:06", "Feb 30, 2024": None, "not a date": None, "": None,
        "5th of September 2024 at 3:04pm": "2024-09-05 15:04:00", "2024-Sep-05": "2024-09-05 00:00:00", "05-Sep-24": "2024-09-05 00:00:00", "Sept. 5th, 2024 12 a.m.": "2024-09-05 00:00:00",
        "Thursday, September 5th, 2024 3pm": "2024-09-05 15:00:00", "5.9.2024": "2024-05-09 00:00:00", "20240905T030405": "2024-09-05 03:04:05", "20240905T0304Z": "2024-09-05 03:04:00",
        "2024 September 5": "2024-09-05 00:00:00", "10:20 5 Sep 2024": "2024-09-05 10:20:00", "10:20:30.250 UTC+2 5 Sep 2024": "2024-09-05 08:20:30.25", "1/2/99": "1999-01-02 00:00:00",
        "2024-09-05 10:20:30,5 -03:00": "2024-09-05 13:20:30.5", "2024-09-05 1:00 p.m.": "2024-09-05 13:00:00", "05/06/2024 11:22 AM": "2024-05-06 11:22:00", "September 05 2024 15:04 z": "2024-09-05 15:04:00",
        "Sep 2024": None, "10:20": None, "5 Foo 2024": None, "Sep 5 2024 13 pm": None, "Sep 5, 2024 at 25:00": None, "5 Sep 2024 & more": None, "1 2 3 4": None, "12 de mayo 2024": None, "5 Sep 2024 " + "x" * 200: None,
    }
    rows = spark.createDataFrame([(t,) for t in cases], "t string")
    assert {r[0]: r[1] for r in rows.select("t", iso_timestamp(F.col("t")).cast("string")).collect()} == cases


def test_spanish_dates(spark):
    cases = {
        "Mayo 14, 2026 11:20 a. m.": "2026-05-14 11:20:00", "x Mayo 14, 2026": "2026-05-14 00:00:00", "mayo 1, 2026 12:05am y": "2026-05-01 00:05:00", "Enero 2, 2024 3:05 P.M.": "2024-01-02 15:05:00",
        "Enero 2, 2024 13:05": "2024-01-02 13:05:00", "Febrero 31, 2024": None, "hola": None, "ENERO 2,\u00a02024": "2024-01-02 00:00:00", "": None, "Enero 2, 2024 25:00": None,
    }
    rows = spark.createDataFrame([(t,) for t in [*cases, None]], "t string")
    assert {r[0]: r[1] for r in rows.select("t", spanish_date(F.col("t")).cast("string")).collect()} == cases | {None: None}


def test_packed_bodies(spark):
    long = "ñ " * 100_000
    rows = spark.createDataFrame([(1, "a", None), (2, "", None), (3, None, None), (4, long, None), (5, None, b"no frame"), (6, None, zstandard.ZstdCompressor().compress(b"\xff\xfe"))], "id int, t string, b binary")
    made = rows.select("id", F.coalesce("b", packed(F.col("t"))).alias("b"))
    assert {r["id"]: r["t"] for r in made.select("id", unpacked(F.col("b")).alias("t")).collect()} == {1: "a", 2: "", 3: None, 4: long, 5: None, 6: None}
    other = zstandard.ZstdCompressor(level=1, write_content_size=False).compress(b"streamed")
    assert spark.createDataFrame([(other,)], "b binary").select(unpacked(F.col("b")).alias("t")).first()["t"] == "streamed"
    assert zstandard.ZstdDecompressor().decompress(bytes(made.where("id = 1").first()["b"])) == b"a"
    seen = made.withColumn("t", unpacked(F.col("b"))).where("id > 4")._jdf.queryExecution().optimizedPlan().toString()
    assert seen.index("ArrowEvalPython") < seen.rindex("Filter")  # the filter lies below the decoding


def test_references_end_in_a_semicolon():
    """A title cut within a reference keeps what is left of it, as its SQL does; scripts are not read for references."""
    from alluvium.functions.select import Pick, read

    page = "<title>a &lt;&amp; b&amp</title><h1>x &amp;amp; &#x27;&#39; &copy=1 &nope;&eacute;</h1><script>1 &amp; 2</script><p>R&D & S<p>end &amp"
    got = read(page, {"t": Pick("title"), "h": Pick("h1"), "s": Pick("script", raw=True), "p": Pick("p")})
    assert got == {"t": ["a <& b&amp"], "h": ["x &amp; '' &copy=1 &nope;é"], "s": ["1 &amp; 2"], "p": ["R&D & S", "end &amp"]}


def test_tasks_of_costly_work_grow_with_the_rows(spark, monkeypatch):
    rows = spark.range(0, 1000, 1, 10)
    assert tables.spread(rows).rdd.getNumPartitions() == 10
    monkeypatch.setattr(tables, "SPREAD_ROWS", 30)
    dealt = tables.spread(rows)
    assert dealt.rdd.getNumPartitions() == 34 and max(dealt.rdd.glom().map(len).collect()) <= 60
    assert tables.spread(spark.range(0, 8, 1, 1)).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_plain_markup_gives_the_same_tree_as_the_parser(monkeypatch):
    from alluvium.functions import select

    pieces = ["<p>", "</p>", "<P class='a b'>", '<a href="/x?a=1&amp;b">', "<br/>", "<b a='1' a='2'>", "a &amp; b", "<", "<script>1<2</script>", "<!-- c -->", "</i x>", "<a href=x>", "\n"]
    pages = ["".join(pieces[(i * k + k) % len(pieces)] for k in range(i % 9 + 1)) for i in range(200)]
    shape = lambda n: [c if isinstance(c, str) else (c.tag, c.attrs, shape(c)) for c in n.children]
    quick = [shape(select.tree(h)) for h in pages]
    at = select._plain("<p>a<b c='d'>e</b><!-- f -->", select._Builder())
    assert at == len("<p>a<b c='d'>e</b>")
    monkeypatch.setattr(select, "_plain", lambda html, builder: 0)
    assert quick == [shape(select.tree(h)) for h in pages]
