"""Parsers of the supermarket sources: three JSON catalogues and five sites read as pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions import url as U
from ..functions import values as V
from ..functions import variant as J
from ..functions.select import Pick, pick
from .base import Parser, json_items, with_unit
from .news import _metas, _paged, here, item, one

# Addresses of pages and images.
ARETE_IMAGE = "https://www.arete.com.py/userfiles/images/productos/%s.jpg"
CASARICA_IMAGE = "https://casarica.cdn1.dattamax.com/userfiles/images/productos/600/%s.jpg"
LOSJARDINES_IMAGE = "https://losjardines.cdn1.dattamax.com/userfiles/images/productos/600/%s.jpg"
STOCK_SITE = "https://www.stock.com.py"
BIGGIE_PAGE = "https://biggie.com.py/item/"
REALONLINE_PAGE = "https://www.realonline.com.py/p/"


def _image_of(template: str, sku: Column) -> Column:
    return F.when(sku.isNotNull(), F.array(F.format_string(template, sku)))


# Pages with the price and the code in their visible text.


def _visible(template: str) -> dict[str, Column]:
    sku = X.sku_from_text(one("page"))
    return with_unit(
        {"source_url": here(), "sku": sku, "name": F.coalesce(one("h1"), F.lit("")), "price": V.price_from_text(one("page")), "image_urls": _image_of(template, sku)}
    )


def visible_text(h1: str, template: str) -> Parser:
    return Parser("products", _paged(h1=Pick(h1, first=True), page=Pick()), lambda: _visible(template))


_CART = "button#lnk-add-to-cart[data-product_id]"


def _losjardines() -> dict[str, Column]:
    data = lambda field: X.strip_or_null(one(field))
    marked = F.filter(F.arrays_zip(F.col("p.crumb_hrefs").alias("href"), F.col("p.crumb_texts").alias("text")), lambda c: c["href"].rlike(r"-m\d+/?$"))
    sku = data("ean")
    return with_unit({
        "source_url": here(), "sku": sku, "name": F.coalesce(data("data_name"), one("h1"), F.lit("")),
        "brand": F.nullif(F.get(marked, F.lit(0))["text"], F.lit("")), "price": V.money(data("data_price")), "image_urls": _image_of(LOSJARDINES_IMAGE, sku),
    })


# Pages with linked data.


def _brand(v: Column) -> Column:
    """A brand as an object with a name, or as a string."""
    return F.coalesce(J.name(v, "$.brand.name"), J.name(v, "$.brand"))


def _stock_items(bronze: DataFrame) -> DataFrame:
    rows = bronze.withColumn(
        "p",
        pick(
            F.col("body"),
            scripts=Pick("script[type='application/ld+json']", raw=True), sku=Pick("div.sku[itemprop=sku]", sep="", first=True),
            h1=Pick("h1.productname", sep="", first=True), maker=Pick(".manufacturers a", sep="", first=True),
            main_price=Pick("span[id*='ctrlProductVariantsInGrid'][id$='lblPriceValue'].productPrice", first=True),
            any_price=Pick("span.productPrice", first=True), images=Pick("img[src]", attr="src", within="#img-slider .ubislider-inner"),
        ),
    )
    return rows.withColumn("brands", J.plucked(J.linked_all(F.col("p.scripts"), ("Product",)), _brand))


def _stock() -> dict[str, Column]:
    shown = F.regexp_extract(F.coalesce(F.get(F.col("p.main_price"), F.lit(0)), one("any_price")), r"[\d.]+", 0)
    sources = F.filter(F.transform(F.col("p.images"), X.strip), lambda s: s != "")
    return with_unit({
        "source_url": here(), "sku": X.after_colon(one("sku")), "name": F.coalesce(one("h1"), F.lit("")),
        "brand": F.coalesce(F.get(F.col("brands"), F.lit(0)), F.get(F.col("p.maker"), F.lit(0))),
        "price": V.money(F.nullif(F.replace(shown, F.lit("."), F.lit("")), F.lit(""))), "image_urls": U.ordered_distinct(U.join_all(F.lit(STOCK_SITE), sources)),
    })


def _superseis() -> dict[str, Column]:
    product = F.col("ld")
    offers = J.at(product, "$.offers")
    offer = F.when(J.kind(offers) == "ARRAY", J.at(product, "$.offers[0]")).otherwise(offers)
    pictures = J.plucked(J.members(product, "$.image"), J.name)
    single = F.filter(F.array(J.name(product, "$.image")), lambda x: x.isNotNull())
    own = F.concat(pictures, single)
    bare = F.coalesce(F.nullif(J.string(product, "$.image"), F.lit("")).isNull() & (F.size(J.members(product, "$.image")) == 0), F.lit(True))
    return with_unit({
        "source_url": here(), "sku": J.name(product, "$.sku"), "name": J.text(product, "$.name"), "brand": _brand(product),
        "price": V.money(J.scalar(offer, "$.price")), "currency": V.currency(J.string(offer, "$.priceCurrency")),
        "image_urls": F.array_distinct(F.when(product.isNotNull() & bare & one("og_image_p").isNotNull(), F.array(X.strip(one("og_image_p")))).otherwise(own)),
    })


# Catalogues.


def _biggie() -> dict[str, Column]:
    name, code = J.text(item(), "$.name"), F.coalesce(X.strip(J.scalar(item(), "$.code")), F.lit(""))
    originals = F.filter(J.objects(item(), "$.images"), lambda i: F.coalesce(F.try_variant_get(i, "$.type", "double") == 0, F.lit(False)))
    return with_unit({
        "source_url": F.concat(F.lit(BIGGIE_PAGE), X.slugify(name), F.lit("-"), code), "sku": F.nullif(code, F.lit("")), "name": name,
        "brand": J.name(item(), "$.brand.name"),
        "price": V.price_offer(J.scalar(item(), "$.price"), J.scalar(item(), "$.priceSaleOffer"), F.try_variant_get(item(), "$.isOnOffer", "boolean")),
        "image_urls": J.plucked(originals, lambda i: J.string(i, "$.src")),
    })


def _grutter() -> dict[str, Column]:
    return with_unit({
        "source_url": J.text(item(), "$.permalink"), "sku": J.name(item(), "$.sku"), "name": J.text(item(), "$.name"),
        "price": V.price_minor_units(J.scalar(item(), "$.prices.price"), F.try_variant_get(item(), "$.prices.currency_minor_unit", "int")),
        "currency": V.currency(J.string(item(), "$.prices.currency_code")),
        "image_urls": U.ordered_distinct(J.plucked(J.objects(item(), "$.images"), lambda i: J.name(i, "$.src"))),
    })


def _realonline() -> dict[str, Column]:
    chosen = F.coalesce(*[F.when(J.kind(J.at(item(), p)) != "VOID", J.at(item(), p)) for p in ("$.promotionPricePerSubUnit", "$.price")])
    whole = F.when(J.kind(chosen) == "STRING", X.strip(J.string(chosen)).try_cast("bigint")).otherwise(F.try_variant_get(chosen, "$", "double").try_cast("bigint"))
    return with_unit({
        "source_url": F.concat(F.lit(REALONLINE_PAGE), J.text(item(), "$.slug")), "sku": J.name(item(), "$.sku"), "name": J.text(item(), "$.name"), "brand": J.name(item(), "$.brand"),
        "price": V.money(whole), "image_urls": J.plucked(J.members(item(), "$.photosUrl"), J.string),
    })


PARSERS = {
    "arete": visible_text("h1", ARETE_IMAGE),
    "casarica": visible_text("h1.product_title", CASARICA_IMAGE),
    "losjardines": Parser(
        "products",
        _paged(
            ean=Pick(_CART, attr="data-product_ean", first=True), data_name=Pick(_CART, attr="data-product_name", first=True),
            data_price=Pick(_CART, attr="data-product_price", first=True), h1=Pick("h1.product_title", first=True),
            crumb_hrefs=Pick("nav.ecommercepro-breadcrumb a[href]", attr="href"), crumb_texts=Pick("nav.ecommercepro-breadcrumb a[href]"),
        ),
        _losjardines,
    ),
    "stock": Parser("products", _stock_items, _stock),
    "superseis": Parser("products", _paged(("Product",), **_metas("og:image")), _superseis),
    "biggie": Parser("products", json_items("$.items"), _biggie),
    "grutter": Parser("products", json_items("$"), _grutter),
    "realonline": Parser("products", json_items("$.data.getProductsByCategory.category.products"), _realonline),
}
