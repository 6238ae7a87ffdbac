"""Crawl, pipeline, configuration and command line, with a fetcher that reads from a dictionary."""

import dataclasses
import json
import os
import sys
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark import cloudpickle

from alluvium import __main__ as cli
from alluvium import config
from alluvium.errors import ConfigError, LoadError, PipelineError
from alluvium.operators import tables
from alluvium.plans import pipeline
from alluvium.sources import crawl, parsers, sites
from alluvium.sources.http import Response

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # the workers can't import this file


def html_config(store, **more):
    extract = {"scraper": "supermercados.arete", "base_url": "http://s.test", "allowed_domains": ["s.test"], "scrape_patterns": [r"-p\d+$"], "concurrency": 2} | more
    return config.from_mapping({"name": "arete", "extract": extract, "transform": {"parser": "arete"}, "load": {"builder": "supermercados.product"}}, store)


def shop(url, params, headers):
    pages = {
        "http://s.test": "<a href='/x-p1'>1</a><a href='y-p2?utm_source=q'>2</a><a href='http://other.test/z-p9'>o</a><a href='/bad'>b</a><a href='/bad-p3'>b</a><a href='/f.pdf'>f</a>",
        "http://s.test/x-p1": "<h1>Arroz 1 KG</h1>₲. 5.000 CÓDIGO: 11<!-- c --><script>x</script><a href='/'>home</a><a href='/x-p1#top'>self</a>",
        "http://s.test/y-p2": "<h1>Sal</h1>₲. 900",
        "http://s.test/": "<a href='/x-p1'>1</a>",
    }
    return Response(200, pages[url], {"content-type": "text/html"}, url) if url in pages else Response(503, "down", {}, url)


def test_html_end_to_end(spark, tmp_path):
    cfg = html_config(str(tmp_path))
    out = pipeline.run(pipeline.stages(spark, cfg, shop))
    assert out["extract"] == {"fetched": 6, "stored": 2, "failed": 1, "broken": 0}
    assert out["transform"] == {"processed": 2, "silver_rows": 2}
    assert out["load"] == {"products": 1, "null_skus": 1, "facts": 1}
    bronze = crawl.snapshots(spark, str(tmp_path), "html").collect()
    assert sorted(r.id for r in bronze) == [1, 2] and not any("<script" in r.body or "<!--" in r.body for r in bronze)
    assert crawl.snapshots(spark, str(tmp_path), "failed").first().body == "down"
    again = pipeline.run(pipeline.stages(spark, cfg, shop))
    assert again["extract"]["stored"] == 0 and again["transform"]["silver_rows"] == 0 and again["load"]["facts"] == 1
    dim = pipeline.gold_table(spark, str(tmp_path), "dim_product").collect()
    fact = pipeline.gold_table(spark, str(tmp_path), "fact_price").collect()
    assert [(d.product_key, d.sku, d.name, d.unit) for d in dim] == [(1, "11", "Arroz 1 KG", "kg")]
    assert [(f.id, f.product_key, int(f.price)) for f in fact] == [(1, 1, 5000)]


def named_config(store, name):
    extract = {"scraper": "arete", "base_url": "http://s.test", "allowed_domains": ["s.test"], "scrape_patterns": [r"-p\d+$"], "concurrency": 2}
    return config.from_mapping({"name": name, "extract": extract, "transform": {"parser": "arete"}, "load": {"builder": "product"}}, store)


def test_two_sources_at_once(spark, tmp_path):
    """Both are crawled, parsed and loaded at once into one store: nothing is lost and no id is shared."""
    made = [pipeline.stages(spark, named_config(str(tmp_path), n), shop) for n in ("one", "two")]
    with ThreadPoolExecutor(2) as pool:
        for stage in ("extract", "transform", "load"):
            list(pool.map(lambda m, s=stage: pipeline.run(m, s), made))
    bronze, dim, fact = crawl.snapshots(spark, str(tmp_path), "html"), *(pipeline.gold_table(spark, str(tmp_path), t) for t in ("dim_product", "fact_price"))
    silver = tables.read(spark, f"{tmp_path}/silver/products", pipeline.PRODUCT)
    for rows, key, n in ((bronze, "id", 4), (silver, "id", 4), (dim, "product_key", 2), (fact, "id", 2)):
        assert rows.count() == n and rows.select(key).distinct().count() == n
    assert sorted(r.source for r in dim.collect()) == ["one", "two"]
    assert fact.join(dim, "product_key").select("source").distinct().count() == 2
    for rules in pipeline.broken_constraints(spark, str(tmp_path)).values():
        assert rules.count() >= 4 and rules.where("rows > 0").count() == 0


def test_second_writer_of_a_version_fails(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.replace(spark.range(3), path, 0)
    base = tables.version(spark, path)
    tables.replace(spark.range(4), path, base)
    with pytest.raises(LoadError, match="since version 1"):
        tables.replace(spark.range(5), path, base)
    assert tables.current(spark, path, "id long").count() == 4
    (tmp_path / "t" / "_claim-v3").touch()
    with pytest.raises(LoadError, match="is writing version 3"):
        tables.replace(spark.range(5), path, 2)
    os.utime(tmp_path / "t" / "_claim-v3", (0, 0))  # a dead writer's
    tables.replace(spark.range(5), path, 2)
    assert tables.current(spark, path, "id long").count() == 5


def test_spaces_of_ids(spark, tmp_path):
    assert [tables.space(spark, str(tmp_path), s) for s in ("a", "b/ñ", "a", "c", "b/ñ")] == [0, 1, 0, 2, 1]


@pytest.mark.parametrize("cap, fetched", [(0, 0), (1, 1), (3, 3)])
def test_cap(spark, tmp_path, cap, fetched):
    assert crawl.crawl(spark, html_config(str(tmp_path), max_pages=cap).extract, shop)["fetched"] == fetched


def api(spark, tmp_path, source, answer, **more):
    extract = {"scraper": source, "base_url": "http://a.test/api", "concurrency": 2} | more
    cfg = config.from_mapping({"name": source, "extract": extract}, str(tmp_path))
    counts = crawl.crawl(spark, cfg.extract, answer)
    return counts, [r.request_params for r in crawl.snapshots(spark, str(tmp_path), "api").collect()]


def test_header_pages(spark, tmp_path):
    counts, params = api(spark, tmp_path, "hoy", lambda u, p, h: Response(200, "[]", {"x-wp-totalpages": "3"}))
    assert sorted(p["page"] for p in params) == ["1", "2", "3"] and counts["broken"] == 0


def test_header_missing(spark, tmp_path):
    counts, _ = api(spark, tmp_path, "grutter", lambda u, p, h: Response(200, "[]"))
    assert counts == {"fetched": 1, "stored": 1, "failed": 0, "broken": 1}


def test_counted_offsets(spark, tmp_path):
    _, params = api(spark, tmp_path, "biggie", lambda u, p, h: Response(200, '{"count": 120, "items": []}'))
    assert sorted(int(p["skip"]) for p in params) == [0, 50, 100]


def feed(key, full):
    def answer(u, p, h):
        at = int(json.loads(p["query"])[key])
        n = 100 if at < full * 100 else 7 if at == full * 100 else 0
        return Response(200, json.dumps({"content_elements": [{}] * n}))

    return answer


def test_window_feed_stores_no_empty_page(spark, tmp_path):
    counts, params = api(spark, tmp_path, "lanacion", feed("feedFrom", 1))
    assert sorted(int(json.loads(p["query"])["feedFrom"]) for p in params) == [0, 100]
    assert counts["fetched"] == 3


def test_open_feed_and_sections(spark, tmp_path):
    _, params = api(spark, tmp_path / "a", "latribuna", feed("offset", 2))
    assert sorted(json.loads(p["query"])["offset"] for p in params) == [0, 100, 200]
    _, params = api(spark, tmp_path / "b", "abc_color", feed("offset", 1))
    assert len(params) == 24 and all(p["_website"] == "abc-color" for p in params)


def test_tree(spark, tmp_path):
    def answer(u, p, h):
        if p["operationName"] == "GetCategoryTree":
            return Response(200, '{"data": {"getCategory": [{"reference": "A"}, {"reference": ""}, {"reference": "B"}]}}')
        return Response(200, '{"data": {"getProductsByCategory": {"pagination": {"pages": 2}}}}')

    counts, params = api(spark, tmp_path, "realonline", answer)
    asked = sorted((v["categoryReference"], v["currentPage"]) for v in (json.loads(p["variables"])["getProductsByCategoryInput"] for p in params))
    assert asked == [("A", 1), ("A", 2), ("B", 1), ("B", 2)] and counts["fetched"] == 5


def test_config():
    cfg = html_config("/s", max_pages=-1)
    assert cfg.extract.headers["User-Agent"].startswith("Mozilla/5.0") and html_config("/s", headers={"X": "y"}).extract.headers == {"X": "y"}
    assert (cfg.extract.source, cfg.extract.store, cfg.transform.source, cfg.load.partitions) == ("arete", "/s", "arete", 5)
    assert config.from_mapping({"name": "n", "partitions": 9, "transform": {"parser": "p", "source": "own"}}, "/s").transform == config.Transform("own", "/s", "p", 9)
    for bad in ({"name": "n", "what": 1}, {}, {"name": "n", "partitions": 0}, {"name": "n", "transform": {"parser": "p", "x": 1}}, {"name": "n", "transform": {}}):
        with pytest.raises(ConfigError):
            config.from_mapping(bad, "/s")
    for bad in ({"concurrency": 0}, {"max_pages": -2}, {"scrape_patterns": ["("]}, {"scrape_patterns": "x"}):
        with pytest.raises(ConfigError):
            html_config("/s", **bad)
    with pytest.raises(dataclasses.FrozenInstanceError):
        cfg.name = "x"


def test_stages():
    made = [("a", lambda: {"n": 1}), ("b", lambda: {"n": 2})]
    assert list(pipeline.run(made)) == ["a", "b"] and list(pipeline.run(made, "b")) == ["b"]
    with pytest.raises(PipelineError, match="a, b"):
        pipeline.run(made, "c")
    for bad in ([], made + made):
        with pytest.raises(PipelineError):
            pipeline.run(bad)


def test_command_line(tmp_path, monkeypatch):
    monkeypatch.delenv(config.STORE_VARIABLE, raising=False)
    assert cli.main(["--config", "none.yaml"]) == 2
    monkeypatch.setenv(config.STORE_VARIABLE, str(tmp_path))
    assert cli.main(["--config", "none.yaml"]) == 2
    assert cli.main(["--source", "none"]) == 2


def test_sites(spark):
    assert set(sites.SITES) == set(parsers())
    for name, site in sites.SITES.items():
        cfg = sites.site_config(name, "/s", {"ALLUVIUM_REALONLINE_KEY": "k"})
        assert [stage for stage, _ in pipeline.stages(spark, cfg)] == ["extract", "transform", "load"]
        assert cfg.extract.allowed_domains[0] in cfg.extract.base_url and (cfg.load is not None) == site.shop
    assert sites.site_config("realonline", "/s", {"ALLUVIUM_REALONLINE_KEY": "k"}).extract.headers == {"User-Agent": config.USER_AGENT, "Apikey": "k"}
    assert sites.site_config("hoy", "/s").extract.headers == {"User-Agent": config.USER_AGENT}
    with pytest.raises(ConfigError):
        sites.site_config("realonline", "/s", {})
