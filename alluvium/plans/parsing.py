"""Queries that run each source's parser over bodies made of a test table, with the SQL for what must come out."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import tables
from ..sources import parsers

Query = Callable[[SparkSession, str], DataFrame]
PRODUCT_COLUMNS = ("bronze_id", "source_url", "sku", "name", "brand", "price", "currency", "unit", "images")
ARTICLE_COLUMNS = ("bronze_id", "source_url", "title", "body", "authors", "published_at", "section", "tags", "images")


def _snapshots(rows: DataFrame, key: str, source: str, url: Column, body: Column) -> DataFrame:
    return tables.spread(rows).select(F.col(key).alias("id"), F.lit(source).alias("source"), url.alias("request_url"), body.alias("body"), F.lit("2024-01-01").cast("timestamp_ntz").alias("created_at"))


def _parsed(bronze: DataFrame, source: str) -> DataFrame:
    made = parsers()[source].parse(bronze)
    joined = made.withColumns({c: F.array_join(c, "|") for c in ("authors", "tags") if c in made.columns}).withColumn("images", F.array_join("image_urls", "|"))
    return joined.select(*(ARTICLE_COLUMNS if "title" in made.columns else PRODUCT_COLUMNS))


def _fmt(pattern: str, *cs: str) -> Column:
    return F.format_string(pattern, *[F.col(c) for c in cs])


def _json(**fields: str) -> Column:
    return F.to_json(F.struct(*[F.expr(e).alias(n) for n, e in fields.items()]))


def _array(body: Column, head: str = "[", tail: str = "]") -> Column:
    """An item that isn't an object comes first and must be passed over."""
    return F.concat(F.lit(head + "7, "), body, F.lit(tail))


# Products, from `part`. p_name has letters and blanks only.
_HERE = "'https://s.test/' || p_partkey"
_KG = "p_name || ' 5 kg'"


def _products(source: str, sql: str):
    template = {"arete": "https://www.arete.com.py/userfiles/images/productos/%s.jpg", "casarica": "https://casarica.cdn1.dattamax.com/userfiles/images/productos/600/%s.jpg"}
    head, tail = template.get(source, "%s").split("%s") if source in template else ("", "")
    return f"SELECT p_partkey AS bronze_id, {sql.format(head=head, tail=tail)} FROM part"


def _shown(source: str) -> Query:
    title = {"arete": "<h1>%s 5 kg</h1>", "casarica": "<h1>otro</h1><h1 class='a product_title'>%s 5 kg</h1>"}[source]

    def query(spark, sf_dir):
        part = spark.read.parquet(f"{sf_dir}/part.parquet")
        body = F.format_string(title + "<script>₲ 1</script><div>₲. %s.000</div><p>CÓDIGO: %s", F.col("p_name"), F.col("p_size").cast("string"), F.col("p_partkey").cast("string"))
        return _parsed(_snapshots(part, "p_partkey", source, F.expr(_HERE), body), source)

    return query


def _from_part(source: str, body: Callable[[], Column]) -> Query:
    def query(spark, sf_dir):
        return _parsed(_snapshots(spark.read.parquet(f"{sf_dir}/part.parquet"), "p_partkey", source, F.expr(_HERE), body()), source)

    return query


def _losjardines() -> Column:
    return F.format_string(
        "<nav class='ecommercepro-breadcrumb'><a href='/c-c1'>C</a><a href='/b-m%s/'>%s</a></nav><button id='lnk-add-to-cart' data-product_id='1' data-product_ean='%s' data-product_name='%s 5 kg' data-product_price='%s'>",
        F.col("p_size").cast("string"), F.col("p_brand"), F.col("p_partkey").cast("string"), F.col("p_name"), F.col("p_size").cast("string"),
    )


def _stock() -> Column:
    return F.format_string(
        "<h1 class='productname'>%s 5 kg</h1><div class='sku' itemprop='sku'>Código: %s</div><div class='manufacturers'><a>%s</a></div><span class='productPrice'>Gs %s.000</span>"
        "<div id='img-slider'><div class='ubislider-inner'><img src='/i.jpg'><img src='/i.jpg'></div></div>",
        F.col("p_name"), F.col("p_partkey").cast("string"), F.col("p_brand"), F.col("p_size").cast("string"),
    )


def _superseis() -> Column:
    product = _json(**{"@type": "'Product'", "name": _KG, "sku": "string(p_partkey)", "brand": "struct(p_brand AS name)", "offers": "array(struct(string(p_size) AS price, 'USD' AS priceCurrency))", "image": "array('http://i/1', 'http://i/1')"})
    return F.concat(F.lit("<script type='application/ld+json'>{broken</script><script type='application/ld+json'>"), product, F.lit("</script>"))


def _biggie() -> Column:
    item = _json(
        name=_KG, code="p_partkey", brand="struct(p_brand AS name)", price="p_retailprice", isOnOffer="p_size > 25", priceSaleOffer="p_size",
        images="array(struct(0 AS type, 'o' AS src), struct(1 AS type, 't' AS src))",
    )
    return _array(item, '{"items": [', "]}")


def _grutter() -> Column:
    return _array(_json(name=_KG, sku="string(p_partkey)", permalink=_HERE, prices="struct(string(p_size) AS price, 2 AS currency_minor_unit, 'USD' AS currency_code)", images="array(struct('i' AS src), struct('i' AS src))"))


def _realonline() -> Column:
    item = _json(name=_KG, sku="string(p_partkey)", brand="p_brand", price="string(p_size)", promotionPricePerSubUnit="IF(p_size > 25, 0, NULL)", photosUrl="array('u', '')", slug="string(p_partkey)")
    return _array(item, '{"data": {"getProductsByCategory": {"category": {"products": [', "]}}}}")


_SKU = "CAST(p_partkey AS VARCHAR) AS sku"
_SHOWN = f"{_HERE} AS source_url, {_SKU}, {_KG} AS name, CAST(NULL AS VARCHAR) AS brand, CAST(p_size * 1000 AS DECIMAL(12,2)) AS price, 'PYG' AS currency, 'kg' AS unit, '{{head}}' || p_partkey || '{{tail}}' AS images"

_PART: dict[str, tuple[Query, str]] = {s: (_shown(s), _products(s, _SHOWN)) for s in ("arete", "casarica")} | {
    "losjardines": (_from_part("losjardines", _losjardines), f"""SELECT p_partkey AS bronze_id, {_HERE} AS source_url, {_SKU}, {_KG} AS name, p_brand AS brand, CAST(p_size AS DECIMAL(12,2)) AS price,
      'PYG' AS currency, 'kg' AS unit, 'https://losjardines.cdn1.dattamax.com/userfiles/images/productos/600/' || p_partkey || '.jpg' AS images FROM part"""),
    "stock": (_from_part("stock", _stock), f"""SELECT p_partkey AS bronze_id, {_HERE} AS source_url, {_SKU}, {_KG} AS name, p_brand AS brand, CAST(p_size * 1000 AS DECIMAL(12,2)) AS price,
      'PYG' AS currency, 'kg' AS unit, 'https://www.stock.com.py/i.jpg' AS images FROM part"""),
    "superseis": (_from_part("superseis", _superseis), f"""SELECT p_partkey AS bronze_id, {_HERE} AS source_url, {_SKU}, {_KG} AS name, p_brand AS brand, CAST(p_size AS DECIMAL(12,2)) AS price,
      'USD' AS currency, 'kg' AS unit, 'http://i/1' AS images FROM part"""),
    "biggie": (_from_part("biggie", _biggie), f"""SELECT p_partkey AS bronze_id, 'https://biggie.com.py/item/' || trim(regexp_replace(lower({_KG}), '[^a-z0-9]+', '-', 'g'), '-') || '-' || p_partkey AS source_url, {_SKU}, {_KG} AS name,
      p_brand AS brand, CAST(CASE WHEN p_size > 25 THEN p_size ELSE trunc(p_retailprice) END AS DECIMAL(12,2)) AS price, 'PYG' AS currency, 'kg' AS unit, 'o' AS images FROM part"""),
    "grutter": (_from_part("grutter", _grutter), f"""SELECT p_partkey AS bronze_id, {_HERE} AS source_url, {_SKU}, {_KG} AS name, CAST(NULL AS VARCHAR) AS brand, CAST(CAST(p_size AS DECIMAL(12,2)) / 100 AS DECIMAL(12,2)) AS price,
      'USD' AS currency, 'kg' AS unit, 'i' AS images FROM part"""),
    "realonline": (_from_part("realonline", _realonline), f"""SELECT p_partkey AS bronze_id, 'https://www.realonline.com.py/p/' || p_partkey AS source_url, {_SKU}, {_KG} AS name, p_brand AS brand,
      CAST(CASE WHEN p_size > 25 THEN 0 ELSE p_size END AS DECIMAL(12,2)) AS price, 'PYG' AS currency, 'kg' AS unit, 'u' AS images FROM part"""),
}


# Articles, from `orders`.
_TITLE = "'Nota ' || o_orderkey"
_WRITER = "'Autor ' || o_custkey"
_DAY = "string(date(o_orderdate))"
_O_HERE = "'https://s.test/noticias/la-capital/a-b-c-' || o_orderkey"


def _from_orders(source: str, body: Callable[[], Column]) -> Query:
    def query(spark, sf_dir):
        return _parsed(_snapshots(spark.read.parquet(f"{sf_dir}/orders.parquet"), "o_orderkey", source, F.expr(_O_HERE), body()), source)

    return query


def _story() -> Column:
    story = _json(
        canonical_url="'/n/' || o_orderkey", headlines=f"struct({_TITLE} AS basic)", credits=f"struct(array(struct({_WRITER} AS name), struct(' ' AS name)) AS by)", publish_date="''",
        display_date=f"{_DAY} || 'T00:00:00-03:00'", taxonomy="struct(struct('' AS name) AS primary_section, array(struct(o_orderpriority AS name)) AS sections, array(struct('t' AS text, '' AS slug), struct('' AS text, 's' AS slug)) AS tags)",
        content_elements="transform(array(array('text', '<p>uno <b>dos</b></p>', ''), array('text', ' ', ''), array('raw_html', 'tres', ''), array('image', '', 'http://i/in')), x -> struct(x[0] AS type, x[1] AS content, x[2] AS url))",
        promo_items="struct(struct('image' AS type, 'http://i/promo' AS url) AS basic)",
    )
    return _array(story, '{"content_elements": [', "]}")


def _post() -> Column:
    embedded = "named_struct('author', array(struct({w} AS name)), 'wp:featuredmedia', array(struct('http://i/f' AS source_url), struct('http://i/f' AS source_url)), 'wp:term', array(array(struct('category' AS taxonomy, o_orderpriority AS name)), array(struct('post_tag' AS taxonomy, 't' AS name), struct('post_tag' AS taxonomy, 's' AS name))))"
    return _array(_json(link=_O_HERE, date_gmt=f"{_DAY} || 'T03:00:00'", title=f"struct('<i>' || {_TITLE} || '</i>' AS rendered)", content="struct('<p>uno dos</p><p>tres</p>' AS rendered)", _embedded=embedded.format(w=_WRITER)))


def _ld(**more: str) -> Column:
    about = _json(**{"@type": "'NewsArticle'", "headline": _TITLE, "author": f"array(struct({_WRITER} AS name))", "datePublished": f"{_DAY} || 'T00:00:00-03:00'", "image": "array(struct('http://i/hero' AS url))"}, **more)
    return F.concat(F.lit("<script type='application/ld+json'>{\"@graph\": [{\"@type\": \"Thing\"}, "), about, F.lit("]}</script>"))


def _elnacional() -> Column:
    return F.concat(_ld(articleSection="o_orderpriority", keywords="'t, ,s'"), F.lit("<div class='content'><p>uno dos<p> <p>tres</p><img src='http://i/in'><img src='http://i/logo'></div>"))


def _ultimahora() -> Column:
    return F.concat(_ld(), F.lit("<nav class='breadcrumb'><a>"), F.col("o_orderpriority"), F.lit("</a></nav><article><p>uno dos</p><p>tres</p><img src='http://i/in'></article>"))


def _npy() -> Column:
    from ..functions.values import MONTHS

    month = F.element_at(F.array(*[F.lit(m.capitalize()) for m in MONTHS]), F.month("o_orderdate"))
    return F.concat(
        F.lit("<title>"), F.expr(_TITLE), F.lit(" | NPY</title><span>"), month,
        F.format_string(" %d, %d 3:00 a. m.", F.dayofmonth("o_orderdate"), F.year("o_orderdate")),
        F.lit("</span><article></article><main><p>uno dos</p><p>tres</p></main><img src='http://i/in'><img src='http://i/icon'>"),
    )


def _articles(url: str, images: str, writer: str = _WRITER, section: str = "o_orderpriority", tags: str = "'t|s'") -> str:
    return f"""SELECT o_orderkey AS bronze_id, {url} AS source_url, {_TITLE} AS title, 'uno dos' || chr(10) || chr(10) || 'tres' AS body, {writer} AS authors,
      date_trunc('day', o_orderdate) + INTERVAL 3 HOUR AS published_at, {section} AS section, {tags} AS tags, '{images}' AS images FROM orders"""


_ORDERS: dict[str, tuple[Query, str]] = {
    "abc_color": (_from_orders("abc_color", _story), _articles("'https://www.abc.com.py/n/' || o_orderkey", "http://i/in|http://i/promo")),
    "lanacion": (_from_orders("lanacion", _story), _articles("'https://www.lanacion.com.py/n/' || o_orderkey", "http://i/promo|http://i/in")),
    "latribuna": (_from_orders("latribuna", _story), _articles("'https://www.latribuna.com.py/n/' || o_orderkey", "http://i/promo|http://i/in")),
    "hoy": (_from_orders("hoy", _post), _articles(_O_HERE, "http://i/f")),
    "megacadena": (_from_orders("megacadena", _post), _articles(_O_HERE, "http://i/f")),
    "elnacional": (_from_orders("elnacional", _elnacional), _articles(_O_HERE, "http://i/hero|http://i/in")),
    "ultimahora": (_from_orders("ultimahora", _ultimahora), _articles(_O_HERE, "http://i/hero|http://i/in", tags="''")),
    "npy": (_from_orders("npy", _npy), _articles(_O_HERE, "http://i/in", writer="''", section="'La Capital'", tags="''")),
}


def queries() -> dict[str, Query]:
    return {f"parse_{s}": q for s, (q, _) in (_PART | _ORDERS).items()}


def oracle_sql() -> dict[str, str]:
    return {f"parse_{s}": sql for s, (_, sql) in (_PART | _ORDERS).items()}
