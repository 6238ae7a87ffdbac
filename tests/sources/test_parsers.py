"""Every source's parser on small bodies of our own, with odd and broken ones."""

import datetime as dt
import json
from decimal import Decimal

import pytest

from alluvium.functions.values import iso_timestamp
from alluvium.schemas import SNAPSHOT
from alluvium.sources import parsers

NOW = dt.datetime(2026, 1, 2, 3, 4, 5)


def parse(spark, source, *bodies, url="https://x.test/noticias/mi-seccion/una-nota-de-hoy"):
    rows = [(i, source, url, {}, {}, 200, {}, "", b if isinstance(b, str) else json.dumps(b), NOW) for i, b in enumerate(bodies)]
    out = parsers()[source].parse(spark.createDataFrame(rows, SNAPSHOT)).orderBy("id").collect()
    assert all(r.source == source and r.created_at == NOW for r in out)
    return out


def story(**more):
    return {
        "canonical_url": "/nota/1/", "headlines": {"basic": " Título "}, "publish_date": "2024-05-01T12:00:00-03:00",
        "credits": {"by": [{"name": "Ana"}, {"name": " "}, 5]}, "taxonomy": {"primary_section": {"name": "País"}, "tags": [{"text": "uno"}, {"slug": "dos"}, {}]},
        "promo_items": {"basic": {"type": "image", "url": "http://i/promo.jpg"}},
        "content_elements": [{"type": "text", "content": "<p>Hola <b>vos</b></p>"}, {"type": "raw_html", "content": "<i> </i>"}, {"type": "text", "content": "Chau"},
                             {"type": "image", "url": "http://i/in.jpg"}, {"type": "image", "url": "http://i/in.jpg"}, None, 3],
        **more,
    }


@pytest.mark.parametrize("source, host, images", [
    ("abc_color", "https://www.abc.com.py", ["http://i/in.jpg", "http://i/promo.jpg"]),
    ("lanacion", "https://www.lanacion.com.py", ["http://i/promo.jpg", "http://i/in.jpg"]),
    ("latribuna", "https://www.latribuna.com.py", ["http://i/promo.jpg", "http://i/in.jpg"]),
])
def test_story_feeds(spark, source, host, images):
    bare = {"website_url": "w", "first_publish_date": "2024-01-01T00:00:00Z", "taxonomy": {"primary_section": {"name": ""}, "sections": [{"name": ""}, {"name": "B"}]}}
    out = parse(spark, source, {"content_elements": [story(), "x", bare, {}]}, {"content_elements": []}, "not json", [1], {"content_elements": {"a": 1}})
    assert len(out) == 3
    a, b, c = out
    assert (a.source_url, a.title, a.body) == (f"{host}/nota/1/", "Título", "Hola vos\n\nChau")
    assert (a.authors, a.section, a.tags, a.image_urls) == (["Ana"], "País", ["uno", "dos"], images)
    assert a.published_at == dt.datetime(2024, 5, 1, 15)
    assert (b.source_url, b.title, b.section, b.published_at) == (f"{host}/w", "", "B", dt.datetime(2024, 1, 1))
    assert (c.source_url, c.title, c.body, c.authors, c.published_at, c.section, c.tags, c.image_urls) == ("", "", None, [], None, None, [], [])


@pytest.mark.parametrize("source", ["hoy", "megacadena"])
def test_post_feeds(spark, source):
    post = {
        "link": "https://h/1", "date": "2024-01-01T09:00:00", "date_gmt": "1970-01-01T04:00:00", "title": {"rendered": "A &amp; <b>B</b>"},
        "content": {"rendered": "<p>uno</p>\x00<p>dos</p>"},
        "_embedded": {"author": [{"name": "Eva"}, {"x": 1}], "wp:featuredmedia": [{"source_url": "http://i/1"}, {"source_url": "http://i/1"}],
                      "wp:term": [[{"taxonomy": "category", "name": ""}, {"taxonomy": "category", "name": "Cat"}], None, [{"taxonomy": "post_tag", "name": "t1"}, {"taxonomy": "post_tag", "name": "t2"}]]},
    }
    a, b = parse(spark, source, [post, 7, {"title": {"rendered": ""}, "date": "2024-02-03T04:05:06"}], [], {"code": "x"})
    assert (a.source_url, a.title, a.authors, a.section, a.tags, a.image_urls) == ("https://h/1", "A & B", ["Eva"], "Cat", ["t1", "t2"], ["http://i/1"])
    assert a.published_at == dt.datetime(1970, 1, 1, 4)
    assert ("\0" in a.body) == (source == "megacadena") and a.body.replace("\0", "").split("\n\n")[0] == "uno"
    assert (b.source_url, b.title, b.body, b.published_at) == ("", "", None, dt.datetime(2024, 2, 3, 4, 5, 6))


def ld(x):
    return f'<script type="application/ld+json">{json.dumps(x)}</script>'


def test_elnacional(spark):
    page = "<html><head>%s%s</head><body><div class='content x'><p>Uno<b>dos</b></p><p> </p><p>tres</p><img src='http://i/logo.png'><img src='http://i/a.jpg'><img src='/rel.jpg'></div></body></html>"
    a, b = parse(
        spark, "elnacional",
        page % ('<script type="application/ld+json">{bad</script>', ld({"@graph": [{"@type": "Org"}, {
            "@type": "NewsArticle", "headline": "H", "author": [{"name": "Ana"}, "Luz", {}], "datePublished": "2024-03-01T10:00:00-04:00",
            "articleSection": ["", "Sec"], "keywords": ["k1", " ", "k2"], "image": [{"url": "http://i/hero.jpg"}]}]})),
        "<p>nada</p><meta property='og:title' content='OG'><meta name='article:published_time' content='2024-01-01'>",
    )
    assert (a.title, a.body, a.authors, a.section, a.tags) == ("H", "Unodos\n\ntres", ["Ana", "Luz"], "Sec", ["k1", "k2"])
    assert a.image_urls == ["http://i/hero.jpg", "http://i/a.jpg"] and a.published_at == dt.datetime(2024, 3, 1, 14)
    assert (b.title, b.body, b.authors, b.tags, b.image_urls, b.published_at) == ("OG", None, [], [], [], dt.datetime(2024, 1, 1))


def test_elnacional_plain_strings(spark):
    (a,) = parse(spark, "elnacional", ld([{"@type": "Article", "name": "N", "author": "Solo", "articleSection": "S", "keywords": "a, ,b", "image": "http://i/1"}]))
    assert (a.title, a.authors, a.section, a.tags, a.image_urls) == ("N", ["Solo"], "S", ["a", "b"], ["http://i/1"])


def test_ultimahora(spark):
    body = "<nav class='breadcrumb'><a>Deportes</a><a>x</a></nav><article><p>cuerpo</p><img src='http://i/b.jpg'><img src='http://i/icon.png'></article>"
    art = ld({"@type": "NewsArticle", "headline": "T", "author": [{"name": "Uno"}, {"name": "Dos"}]})
    a, b = parse(spark, "ultimahora", "<meta property='og:image' content='http://i/Logo.png'>" + art + body, "<h1>hub</h1>" + body, "<meta property='article:section' content='País'>" + art)
    assert (a.title, a.body, a.authors, a.section, a.image_urls) == ("T", "cuerpo", ["Uno"], "Deportes", ["http://i/b.jpg"])
    assert (b.section, b.image_urls, b.bronze_id) == ("País", [], 2)


def test_npy(spark):
    a, b = parse(
        spark, "npy",
        "<title>Algo | NPY</title><span>Mayo 14, 2026 12:20 a. m.</span><article><b>sin p</b></article><main><p>uno<p>dos</main><img src='http://i/x.jpg'><img src='http://i/logo.jpg'>",
        "<h1> </h1>",
    )
    assert (a.title, a.body, a.section, a.image_urls) == ("Algo", "uno\n\ndos", "Mi Seccion", ["http://i/x.jpg"])
    assert a.published_at == dt.datetime(2026, 5, 14, 0, 20)
    assert (b.title, b.body, b.published_at) == ("", None, None)


@pytest.mark.parametrize("source, h1", [("arete", "<h1>"), ("casarica", "<h1 class='product_title x'>")])
def test_visible_text_shops(spark, source, h1):
    a, b = parse(spark, source, f"{h1}Yerba 500 gramos</h1><div>₲. 24.000</div><span>CÓDIGO: 72000</span>", "<p>nada ₲ .</p>")
    assert (a.sku, a.name, a.price, a.unit, a.currency, a.brand) == ("72000", "Yerba 500 gramos", Decimal("24000.00"), "g", "PYG", None)
    assert len(a.image_urls) == 1 and a.image_urls[0].endswith("/72000.jpg")
    assert (b.sku, b.name, b.price, b.image_urls) == (None, "", None, [])


def test_casarica_wants_its_own_title(spark):
    assert parse(spark, "casarica", "<h1>otro</h1>")[0].name == ""


def test_losjardines(spark):
    crumbs = "<nav class='ecommercepro-breadcrumb'><a href='/x-c1'>Cat</a><a href='/marca-m12/'>Marca</a></nav>"
    cart = "<button id='lnk-add-to-cart' data-product_id='1' data-product_ean=' 77 ' data-product_name='Leche 1 LT' data-product_price='15900'>"
    a, b, c = parse(spark, "losjardines", crumbs + cart, "<h1 class='product_title'>Pan</h1>", "<button id='lnk-add-to-cart' data-product_ean='9'>")
    assert (a.sku, a.name, a.brand, a.price, a.unit, len(a.image_urls)) == ("77", "Leche 1 LT", "Marca", Decimal(15900), "l", 1)
    assert (b.sku, b.name, b.brand, b.price, b.image_urls) == (None, "Pan", None, None, [])
    assert (c.sku, c.name) == (None, "")


def test_stock(spark):
    base = "<h1 class='productname'>Agua 2 L</h1><div class='sku' itemprop='sku'>Código de Barras:800</div><div class='manufacturers'><a>Otra</a></div>"
    prices = "<span class='productPrice'>1</span><span id='a_ctrlProductVariantsInGrid_lblPriceValue' class='productPrice'>Gs 195.000</span>"
    slider = "<div id='img-slider'><div class='ubislider-inner'><img src='/a.jpg'><img src=' /a.jpg'><img src='http://c/b.jpg'></div></div>"
    a, b, c = parse(spark, "stock", base + prices + slider + ld({"@type": "Product", "brand": {"name": "Marca"}}), base, "<p>")
    assert (a.sku, a.name, a.brand, a.price, a.image_urls) == ("800", "Agua 2 L", "Marca", Decimal(195000), ["https://www.stock.com.py/a.jpg", "http://c/b.jpg"])
    assert (b.brand, b.price, b.image_urls) == ("Otra", None, [])
    assert (c.sku, c.name, c.brand) == (None, "", None)


def test_superseis(spark):
    product = {"@type": "Product", "name": " Té 20 g ", "sku": "s1", "brand": "Marca", "offers": [{"price": "1200", "priceCurrency": "USD"}], "image": [" http://i/1", "http://i/1", 4]}
    a, b, c = parse(
        spark, "superseis", ld({"@type": "Org"}) + ld(product), "<meta property='og:image' content='http://i/og'>" + ld({"@type": "Product", "brand": {"name": "M"}, "offers": {"price": 7.5}}), "<p>"
    )
    assert (a.sku, a.name, a.brand, a.price, a.currency, a.image_urls) == ("s1", "Té 20 g", "Marca", Decimal(1200), "USD", ["http://i/1"])
    assert (b.brand, b.price, b.currency, b.image_urls) == ("M", Decimal("7.50"), "PYG", ["http://i/og"])
    assert (c.name, c.sku, c.price, c.image_urls) == ("", None, None, [])


def test_biggie(spark):
    items = [
        {"name": "Ñandú Café 1kg", "code": 12, "brand": {"name": "B"}, "price": "100.9", "isOnOffer": True, "priceSaleOffer": 80, "images": [{"type": 0, "src": "o"}, {"type": 1, "src": "t"}]},
        {"name": "", "code": "x", "price": 0, "isOnOffer": True, "priceSaleOffer": 0}, {"price": "None"}, "no",
    ]
    a, b, c = parse(spark, "biggie", {"items": items}, [])
    assert (a.source_url, a.sku, a.brand, a.price, a.unit, a.image_urls) == ("https://biggie.com.py/item/nandu-cafe-1kg-12", "12", "B", Decimal(80), "kg", ["o"])
    assert (b.source_url, b.sku, b.price, c.sku, c.price) == ("https://biggie.com.py/item/-x", "x", None, None, None)


def test_grutter(spark):
    a, b, c = parse(spark, "grutter", [
        {"name": "A", "sku": "1", "permalink": "https://g/a", "prices": {"price": "199", "currency_minor_unit": 2, "currency_code": " USD "}, "images": [{"src": "i"}, {"src": "i"}]},
        {"prices": {}}, {"prices": {"price": "5000", "currency_minor_unit": 0}}])
    assert (a.price, a.currency, a.image_urls, a.source_url) == (Decimal("1.99"), "USD", ["i"], "https://g/a")
    assert (b.price, b.currency, c.price) == (None, "PYG", Decimal(5000))


def test_realonline(spark):
    products = [
        {"name": "A", "price": 100, "promotionPricePerSubUnit": 0, "photosUrl": ["u", ""], "sku": "1", "brand": " X ", "slug": "a-1"},
        {"price": "250", "promotionPricePerSubUnit": None}, {"price": "12.7"}, {"price": 12.7},
    ]
    a, b, c, d = parse(spark, "realonline", {"data": {"getProductsByCategory": {"category": {"products": products}}}}, {"data": None})
    assert (a.price, a.image_urls, a.brand, a.source_url) == (Decimal(0), ["u"], "X", "https://www.realonline.com.py/p/a-1")
    assert (b.price, c.price, d.price) == (Decimal(250), None, Decimal(12))


def test_all_sixteen():
    assert len(parsers()) == 16


def test_free_form_dates(spark):
    same = ["2026-01-02T10:30:00Z", "2026-01-02T07:30:00-0300", "Fri, 02 Jan 2026 07:30:00 -0300", "Friday, 2 January 2026 10:30 GMT", "jan 2, 2026 10:30 a.m.", "1/2/2026 10:30", "2026/1/2 10:30"]
    cases = {t: "2026-01-02 10:30:00" for t in same} | {"31/12/2026": "2026-12-31 00:00:00", "20260102": "2026-01-02 00:00:00", "": None, "2026-02-31": None, "soon": None}
    rows = spark.createDataFrame([(t,) for t in [*cases, None]], "t string")
    assert {r.t: r.d for r in rows.select("t", iso_timestamp(rows["t"]).cast("string").alias("d")).collect()} == cases | {None: None}


def test_a_feed_s_json_is_parsed_once(spark):
    """Also where the array is asked for its kind; objects among odd members are told without the schema of what they hold."""
    from pyspark.sql import functions as F

    from alluvium.sources.base import json_items

    rows = spark.createDataFrame([(1, '{"a": [7, null, [1], {"x": {"y": 1}}, "s", {}]}'), (2, '{"a": {"x": 1}}'), (3, "broken"), (4, None)], "id long, body string").withColumn("pos", F.lit(0))
    found = json_items("$.a")(rows)
    assert found._jdf.queryExecution().analyzed().toString().count("parse_json") == 1
    assert sorted((r["id"], r["pos"], r["j"]) for r in found.select("id", "pos", F.to_json("item").alias("j")).collect()) == [(1, 0, '{"x":{"y":1}}'), (1, 1, "{}")]


@pytest.mark.parametrize("source", ["hoy", "megacadena"])
def test_a_post_is_cast_once(spark, source):
    """Its parts are fields of one cast, none is looked up in the variant again; odd shapes are absent, as before."""
    odd = [
        {"link": 5, "title": "t", "content": {"rendered": 1}, "date_gmt": 20240101, "date": "2024-01-01T09:00:00", "_embedded": [1]},
        {"link": "", "title": {"rendered": {"a": 1}}, "content": None, "date_gmt": "", "_embedded": {"author": {"name": "x"}, "wp:featuredmedia": [None, {"source_url": 1}, {"source_url": " u "}], "wp:term": {"a": 1}}},
        {"_embedded": {"author": ["x", {"name": None}, {"name": True}, {"name": " Y "}], "wp:term": [5, {"taxonomy": "category"}, [6, None, {"taxonomy": 7, "name": "n"}, {"taxonomy": ["category"], "name": "n"},
            {"name": "n"}, {"taxonomy": "category", "name": 2024}, {"taxonomy": "post_tag", "name": "2024"}, {"taxonomy": "category", "name": "true"}]]}},
    ]
    a, b, c = parse(spark, source, [None, *odd, [odd[0]], "x"], "[{} ", {"0": odd[0]}, 3)
    assert (a.source_url, a.title, a.body, a.authors, a.section, a.tags, a.image_urls) == ("", "", None, [], None, [], []) and a.published_at == dt.datetime(2024, 1, 1, 9)
    assert (b.source_url, b.title, b.body, b.authors, b.section, b.tags, b.image_urls, b.published_at) == ("", "", None, [], None, [], ["u"], None)
    assert (c.authors, c.section, c.tags) == (["Y"], "true", ["2024"]) and [r.id for r in (a, b, c)] == [0, 1, 2]

    plan = parsers()[source].parse(spark.createDataFrame([], SNAPSHOT))._jdf.queryExecution().analyzed().toString()
    assert plan.count("parse_json") == 1 and "try_variant_get" in plan and ", $." not in plan


def test_plain_fragments_need_no_tree(monkeypatch):
    from alluvium.functions import select

    made, tree = [], select.tree
    monkeypatch.setattr(select, "tree", lambda h: made.append(h) or tree(h))
    plain = {"<p>a &amp; <b>b</b></p> c": "a &|b|c", "<p> <br>x</i>y": "x|y", "1 > 0 &amp": "1 > 0 &amp", "<a href='/'>l</a>": "l", "": "", " \xa0": ""}
    assert {h: select._text(h, "|") for h in plain} == plain and not made
    odd = ["a<!-- x -->b", "<noscript>n</noscript>m", "<script>x<b>y</script>z", "<style>s", "<p a=b>c</p>", "a</p x='y'>b", "a <3", "<!DOCTYPE x>a", "<br/>a"]
    assert [select._text(h, "|") for h in odd] == [tree(h).text("|") for h in odd] and made == odd


@pytest.mark.parametrize("source", ["hoy", "megacadena"])
def test_a_post_s_texts_are_read_by_its_cast_alone(spark, source):
    """Strings come out of the one cast as they are: none is asked for its type and looked up again, and none is stripped twice."""
    plan = parsers()[source].parse(spark.createDataFrame([], SNAPSHOT))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("try_variant_get") == 1 and "SchemaOfVariant" not in plan
    assert plan.count(r"(?U)^\s+|\s+$") == 4  # authors, section, tags, images


def test_only_strings_are_strings(spark):
    """By one lookup, without asking for the type."""
    from pyspark.sql import functions as F

    from alluvium.functions import variant as J

    kinds = ["7", "-1", "3000000000", "99999999999999999999", "1.5", "1e300", "true", "false", "null", "{}", '{"b": "x"}', "[]", '["x"]']
    texts = {'"7"': "7", '""': "", '" x "': " x ", '"\\u00e9\\ud83d\\ude00"': "é😀", '"2024-01-01"': "2024-01-01", '"\\u0000a"': "\0a"}
    rows = spark.createDataFrame([(j,) for j in (*kinds, *texts)], "j string")
    here, below = J.string(F.try_parse_json("j")), J.string(F.try_parse_json(F.concat(F.lit('{"a": '), "j", F.lit("}"))), "$.a")
    found = rows.select("j", here.alias("here"), below.alias("below"))
    assert [(r.here, r.below) for r in found.collect()] == [(texts.get(j),) * 2 for j in (*kinds, *texts)]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("try_variant_get") == 2 and "SchemaOfVariant" not in plan

    listed = spark.createDataFrame([([" a ", None, "", " ", "b\xa0", "a"],), (None,)], "s array<string>")
    assert [r[0] for r in listed.select(J.names(F.col("s"))).collect()] == [["a", "b", "a"], None]
    assert [r[0] for r in listed.select(J.names(F.col("s").cast("array<binary>"))).collect()] == [["a", "b", "a"], None]


def test_plain_fragments_are_cut_at_their_tags(monkeypatch):
    """As the tree's strings; a tag that was met before isn't read again."""
    from alluvium.functions import select

    plain = ["a > <b>b</b>>", "<p id='x'>a</p><p id='x'> b &lt; </p>", "<P\n>a</ p", "a<br>b", "\0<i>\0</i>"]
    odd = ["a < b", "<p id='<'>x", "<p id='>'>x", "<>x", "</>x", "<<p>x", "<p>x<", "<SCRIPT>a<b>c</script>d", "<title>a<b></title>"]
    assert [select._text(h, "|") for h in (*plain, *odd)] == [select.tree(h).text("|") for h in (*plain, *odd)]
    seen = select._parting.cache_info().misses
    assert select._text("<p id='x'>c</p>", "|") == "c" and select._parting.cache_info().misses == seen
