"""What a source asks for first, and which requests follow from an answer.

A page source follows links. A catalogue's further requests come from the answer's body, headers and parameters, as
columns. All requests have (url, params); the crawl drops those it has seen.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import variant as J
from ..functions.select import Pick, pick
from ..functions.url import join_site
from ..operators import frontier

REQUESTS = "array<struct<url:string,params:map<string,string>>>"
Params = dict[str, str]


def _body() -> Column:
    return F.try_parse_json("body")


def _param(name: str) -> Column:
    return F.try_element_at("params", F.lit(name))


def _query(name: str) -> Column:
    """A value of the JSON text in the parameter `query`."""
    return J.scalar(F.try_parse_json(_param("query")), f"$.{name}")


def _each(numbers: Column, params: Callable[[Column], Column]) -> Column:
    return F.transform(numbers.cast("array<int>"), lambda n: F.struct(F.col("url").alias("url"), params(n).alias("params")))


def _map(**values: Column | str) -> Column:
    parts = [x for k, v in values.items() for x in (F.lit(k), v if isinstance(v, Column) else F.lit(v))]
    return F.create_map(*parts).cast("map<string,string>")


def _text(pattern: str, *values: Column) -> Column:
    return F.format_string(pattern, *values)


@dataclass(frozen=True)
class Scraper:
    """`seeds`: parameters of the first requests. `following`: an array of requests over answers (url, params,
    response_headers, body); null marks an answer that should name its successors and doesn't. `persists`: which
    answers are stored. The wording of a JSON query is part of its request's identity."""

    model: str
    seeds: Callable[[], list[Params]]
    following: Callable[[int], Column]
    persists: Callable[[], Column] | None = None
    ciphers: str | None = None


# Catalogues that tell the number of pages in a header.


def paged_by_header(extra: Params) -> Scraper:
    first = {"per_page": "100", **extra, "orderby": "date", "order": "desc", "page": "1"}

    def following(_: int) -> Column:
        total = F.try_element_at("response_headers", F.lit("x-wp-totalpages")).try_cast("int")
        keep = {k: v for k, v in first.items() if k != "page"}
        pages = _each(frontier.pages_after_first(total, _param("page").cast("int")), lambda n: _map(**keep, page=n.cast("string")))
        return F.when((_param("page") == "1") & total.isNull(), F.lit(None)).otherwise(pages)

    return Scraper("api", lambda: [first], following)


# Sections of a feed, read one by one.
SECTIONS = (
    "/nacionales", "/internacionales", "/politica", "/economia", "/deportes", "/policiales", "/espectaculos", "/opinion", "/ciencia", "/tecnologia",
    "/locales", "/sociedad",
)


def _got() -> Column:
    return F.size(J.members(_body(), "$.content_elements"))


def _sections() -> Scraper:
    blob = '{"section_id": "%s", "sort": "display_date:desc", "limit": "100", "offset": "%s"}'

    def following(_: int) -> Column:
        after = frontier.offset_if_full(_query("offset").try_cast("int"), _got(), 100)
        return _each(after, lambda n: _map(_website="abc-color", query=_text(blob, _query("section_id"), n)))

    return Scraper("api", lambda: [{"_website": "abc-color", "query": blob % (s, 0)} for s in SECTIONS], following)


def _window() -> Scraper:
    blob = '{"feedSize": "100", "feedFrom": "%s", "website": "lanacionpy", "feedQuery": "type:story"}'

    def following(concurrency: int) -> Column:
        ahead = frontier.speculative_offsets(_query("feedFrom").try_cast("int"), _got(), 100, concurrency, 10_000)
        return _each(ahead, lambda n: _map(query=_text(blob, n)))

    return Scraper("api", lambda: [{"query": blob % 0}], following, lambda: _got() > 0)


def _open_feed() -> Scraper:
    blob = '{"query": "type:story", "offset": %s, "size": 100}'

    def following(_: int) -> Column:
        return _each(frontier.offset_if_full(_query("offset").try_cast("int"), _got(), 100), lambda n: _map(query=_text(blob, n)))

    return Scraper("api", lambda: [{"query": blob % 0}], following)


def _counted() -> Scraper:
    def following(_: int) -> Column:
        count = J.scalar(_body(), "$.count").try_cast("int")
        rest = _each(frontier.offsets_by_count(count, _param("skip").cast("int"), 50), lambda n: _map(take="50", skip=n.cast("string")))
        return F.when((_param("skip") == "0") & count.isNull(), F.lit(None)).otherwise(rest)

    return Scraper("api", lambda: [{"take": "50", "skip": "0"}], following)


# The shop's numbers, and what is asked of the graph service.
SHOP = {"clientId": "CADENA_REAL", "storeReference": "2"}
TREE_QUERY = "query GetCategoryTree($getCategoryInput: GetCategoryInput!) { getCategory(getCategoryInput: $getCategoryInput) { reference } }"
PRODUCT_QUERY = (
    "query GetProductsByCategory($getProductsByCategoryInput: GetProductsByCategoryInput!) { getProductsByCategory(getProductsByCategoryInput: "
    "$getProductsByCategoryInput) { category { reference products { name price promotionPricePerSubUnit photosUrl sku brand slug } } pagination { page pages } } }"
)


def _tree() -> Scraper:
    pages = (
        '{"getProductsByCategoryInput": {"clientId": "' + SHOP["clientId"] + '", "storeReference": "' + SHOP["storeReference"] + '", '
        '"categoryReference": "%s", "currentPage": %s, "pageSize": 100}}'
    )

    def asked(reference: Column, page: Column) -> Column:
        params = _map(operationName="GetProductsByCategory", query=PRODUCT_QUERY, variables=_text(pages, reference, page))
        return F.struct(F.col("url").alias("url"), params.alias("params"))

    def following(_: int) -> Column:
        data = J.at(_body(), "$.data")
        roots = J.plucked(J.objects(data, "$.getCategory"), lambda c: J.scalar(c, "$.reference"))
        asked_for = F.try_parse_json(_param("variables"))
        mine = J.scalar(asked_for, "$.getProductsByCategoryInput.categoryReference")
        page = J.scalar(asked_for, "$.getProductsByCategoryInput.currentPage").try_cast("int")
        count = F.coalesce(J.scalar(data, "$.getProductsByCategory.pagination.pages").try_cast("int"), F.lit(1))
        rest = F.transform(frontier.pages_after_first(count, page), lambda n: asked(mine, n))
        found = F.when(_param("operationName") == "GetCategoryTree", F.transform(roots, lambda r: asked(r, F.lit(1)))).otherwise(rest)
        return F.when(J.kind(data) == "OBJECT", found)

    seed = {"operationName": "GetCategoryTree", "query": TREE_QUERY, "variables": json.dumps({"getCategoryInput": SHOP})}
    return Scraper("api", lambda: [seed], following, lambda: F.coalesce(_param("operationName") == "GetProductsByCategory", F.lit(False)))


def links(base_url: str, ciphers: str | None = None) -> Scraper:
    """Links of a page and its next page, joined with it; a bare relative one with the site."""

    def following(_: int) -> Column:
        found = pick(F.col("body"), a=Pick("a[href]", attr="href"), next=Pick("link[rel=next][href]", attr="href"))
        joined = join_site(F.col("final_url"), F.lit(base_url), F.concat(found["a"], found["next"]))
        none = F.create_map().cast("map<string,string>")
        return F.transform(joined, lambda u: F.struct(u.alias("url"), none.alias("params")))

    return Scraper("html", lambda: [{}], following, ciphers=ciphers)


def scraper(name: str, base_url: str) -> Scraper:
    from .http import OLD_CIPHERS

    catalogues = {
        "abc_color": _sections, "lanacion": _window, "latribuna": _open_feed, "biggie": _counted, "realonline": _tree,
        "hoy": lambda: paged_by_header({"_embed": "true"}), "megacadena": lambda: paged_by_header({"_embed": "true"}), "grutter": lambda: paged_by_header({}),
    }
    return catalogues[name]() if name in catalogues else links(base_url, OLD_CIPHERS if name == "stock" else None)
