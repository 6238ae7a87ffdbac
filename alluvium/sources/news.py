"""Parsers of the news sources: feeds of two publishing systems, and three sites read as pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions import url as U
from ..functions import values as V
from ..functions import variant as J
from ..functions.select import Pick, fragment_text, fragment_texts, pick
from .base import Parser, json_items, no_strings


def item() -> Column:
    return F.col("item")


def here() -> Column:
    return F.col("request_url")


def linked() -> Column:
    return F.col("ld")


# Story feeds: {"content_elements": [story, ...]}.


def _absolute(base: str, path: Column) -> Column:
    """The path on the site; empty where there is none."""
    return F.when(path == "", "").otherwise(U.join(F.lit(base), path))


def _story(base: str, promo_first: bool) -> dict[str, Column]:
    def part(kinds: tuple[str, ...], field: str) -> Column:
        wanted = F.filter(J.objects(item(), "$.content_elements"), lambda e: F.coalesce(J.string(e, "$.type").isin(*kinds), F.lit(False)))
        return F.transform(wanted, lambda e: J.text(e, f"$.{field}"))

    promo = F.when(J.string(item(), "$.promo_items.basic.type") == "image", J.text(item(), "$.promo_items.basic.url"))
    images = [part(("image",), "url"), F.array(promo)]
    named = J.plucked(J.objects(item(), "$.taxonomy.sections"), lambda s: J.name(s, "$.name"))
    return {
        "source_url": _absolute(base, X.strip(X.first_truthy(J.string(item(), "$.canonical_url"), J.string(item(), "$.website_url"), default=""))),
        "title": J.text(item(), "$.headlines.basic"),
        "body": X.join_chunks(fragment_texts(part(("text", "raw_html"), "content"))),
        "authors": J.plucked(J.objects(item(), "$.credits.by"), lambda p: J.name(p, "$.name")),
        "published_at": V.iso_timestamp(X.first_truthy(*[J.string(item(), f"$.{d}_date") for d in ("publish", "first_publish", "display")])),
        "section": F.coalesce(J.name(item(), "$.taxonomy.primary_section.name"), F.get(named, F.lit(0))),
        "tags": J.plucked(J.objects(item(), "$.taxonomy.tags"), lambda t: X.strip(X.first_truthy(J.string(t, "$.text"), J.string(t, "$.slug")))),
        "image_urls": U.ordered_distinct(*(reversed(images) if promo_first else images)),
    }


def story_feed(base: str, promo_first: bool) -> Parser:
    return Parser("articles", json_items("$.content_elements"), lambda: _story(base, promo_first))


# Post feeds: [post, ...] with authors, terms and media embedded.


#: What is read of a post. Texts are binary, since a cast to string would take numbers and objects too; of a term's
#: taxonomy it may, for it is only held against words that none of these is written as.
POST = (
    "struct<link: binary, date: binary, date_gmt: binary, title: struct<rendered: binary>, content: struct<rendered: binary>, _embedded: struct<"
    "author: array<struct<name: binary>>, `wp:featuredmedia`: array<struct<source_url: binary>>, `wp:term`: array<array<struct<taxonomy: string, name: binary>>>>>"
)


def _post(drop_nul: bool) -> dict[str, Column]:
    tidy = X.without_nul if drop_nul else (lambda c: c)
    text = lambda f: F.col(f"item.{f}").cast("string")
    rendered = lambda f: F.coalesce(text(f"{f}.rendered"), F.lit(""))
    terms = F.flatten(F.filter("item._embedded.`wp:term`", lambda group: group.isNotNull()))
    of = lambda taxonomy: J.names(F.filter(terms, lambda t: t["taxonomy"] == taxonomy)["name"])
    return {
        "source_url": text("link"),
        "title": tidy(fragment_text(rendered("title"))),
        "body": F.nullif(tidy(fragment_text(rendered("content"), "\n\n")), F.lit("")),
        "authors": J.names(F.col("item._embedded.author.name")),
        "published_at": V.iso_timestamp(X.first_truthy(text("date_gmt"), text("date"))),
        "section": F.get(of("category"), F.lit(0)),
        "tags": of("post_tag"),
        "image_urls": F.array_distinct(J.names(F.col("item._embedded.`wp:featuredmedia`.source_url"))),
    }


def post_feed(drop_nul: bool) -> Parser:
    return Parser("articles", json_items("$", POST), lambda: _post(drop_nul))


# Pages.


def _paged(ld_types: tuple[str, ...] = (), **picks: Pick):
    """A row a page: `p` has the picks, `ld` the linked data of the types."""

    def items(bronze: DataFrame) -> DataFrame:
        scripts = {"scripts": Pick("script[type='application/ld+json']", raw=True)} if ld_types else {}
        rows = bronze.withColumn("p", pick(F.col("body"), **picks, **scripts))
        return rows.withColumn("ld", J.linked_data(F.col("p.scripts"), ld_types)) if ld_types else rows

    return items


def one(name: str) -> Column:
    """The first of a pick; null where it is empty or absent."""
    return F.nullif(F.get(F.col(f"p.{name}"), F.lit(0)), F.lit(""))


def _metas(*names: str) -> dict[str, Pick]:
    """Metas of these properties, as picks `<last part>_p` (property) and `<last part>_n` (name)."""
    short = lambda n: n.replace(":", "_")
    return {f"{short(n)}_{by[0]}": Pick(f"meta[{by}='{n}']", attr="content", first=True) for n in names for by in ("property", "name")}


def meta(name: str) -> Column:
    short = name.replace(":", "_")
    return F.coalesce(one(f"{short}_p"), one(f"{short}_n"))


ARTICLE_TYPES = ("NewsArticle", "Article")


def _ld_title() -> Column:
    return X.strip(X.first_truthy(J.string(linked(), "$.headline"), J.string(linked(), "$.name"), meta("og:title"), default=""))


def _ld_published() -> Column:
    return V.iso_timestamp(F.coalesce(F.nullif(J.string(linked(), "$.datePublished"), F.lit("")), meta("article:published_time")))


def _ld_image() -> Column:
    v = F.when(J.kind(J.at(linked(), "$.image")) == "ARRAY", J.at(linked(), "$.image[0]")).otherwise(J.at(linked(), "$.image"))
    return F.nullif(F.coalesce(J.string(v), J.string(v, "$.url")), F.lit(""))


def _person(v: Column) -> Column:
    return F.coalesce(J.name(v), X.strip_or_null(J.scalar(v, "$.name")))


def _elnacional() -> dict[str, Column]:
    author, section, words = (J.at(linked(), f"$.{f}") for f in ("author", "articleSection", "keywords"))
    listed = lambda v: F.when(J.kind(v) == "ARRAY", J.members(v)).otherwise(F.filter(F.array(v), lambda x: x.isNotNull()))
    return {
        "source_url": here(),
        "title": _ld_title(),
        "body": X.join_chunks(F.col("p.paragraphs")),
        "authors": J.plucked(listed(author), _person),
        "published_at": _ld_published(),
        "section": F.get(J.plucked(listed(section), J.name), F.lit(0)),
        "tags": F.when(J.kind(words) == "ARRAY", J.plucked(J.members(words), lambda x: X.strip(J.scalar(x)))).otherwise(X.keywords(J.string(words))),
        "image_urls": U.ordered_distinct(F.array(F.coalesce(_ld_image(), meta("og:image"))), U.images_kept(F.col("p.images"))),
    }


def _ultimahora() -> dict[str, Column]:
    author = J.at(linked(), "$.author")
    first = F.when(J.kind(author) == "ARRAY", J.at(linked(), "$.author[0]"))
    writer = F.coalesce(J.name(first), F.nullif(J.scalar(F.coalesce(first, author), "$.name"), F.lit("")))
    kept = U.images_kept(F.col("p.images"))
    shared = F.get(U.images_kept_any(F.array(meta("og:image"))), F.lit(0))
    return {
        "source_url": here(),
        "title": _ld_title(),
        "body": X.join_chunks(F.col("p.paragraphs")),
        "authors": F.filter(F.array(writer), lambda x: x.isNotNull()),
        "published_at": _ld_published(),
        "section": F.coalesce(meta("article:section"), one("crumb")),
        "tags": no_strings(),
        "image_urls": U.ordered_distinct(F.array(F.coalesce(_ld_image(), shared)), kept),
    }


# Where the body of an npy page is, in order of preference.
NPY_BODIES = ("article", ".article-body", ".story-body", ".rich-text-body", "main")


def _npy() -> dict[str, Column]:
    segments = U.segments(here())
    return {
        "source_url": here(),
        "title": F.coalesce(one("h1"), F.nullif(X.title_without_site(one("title")), F.lit("")), F.lit("")),
        "body": F.coalesce(*[X.join_chunks(F.col(f"p.body{i}")) for i in range(len(NPY_BODIES))]),
        "authors": no_strings(),
        "published_at": V.spanish_date(one("page")),
        "section": F.when(F.get(segments, F.lit(0)) == "noticias", F.nullif(X.title_case_words(F.get(segments, F.lit(1))), F.lit(""))),
        "tags": no_strings(),
        "image_urls": U.ordered_distinct(U.images_kept(F.col("p.images"))),
    }


_UH = ".RichTextArticleBody, .Page-articleBody, article"


def _articles_only(items):
    return lambda bronze: items(bronze).where("ld IS NOT NULL")


PARSERS = {
    "abc_color": story_feed("https://www.abc.com.py", promo_first=False),
    "lanacion": story_feed("https://www.lanacion.com.py", promo_first=True),
    "latribuna": story_feed("https://www.latribuna.com.py", promo_first=True),
    "hoy": post_feed(drop_nul=True),
    "megacadena": post_feed(drop_nul=False),
    "elnacional": Parser(
        "articles",
        _paged(ARTICLE_TYPES, paragraphs=Pick(".content p", sep=""), images=Pick("img[src]", attr="src", within=".content"), **_metas("og:title", "og:image", "article:published_time")),
        _elnacional,
    ),
    "ultimahora": Parser(
        "articles",
        _articles_only(
            _paged(
                ARTICLE_TYPES,
                paragraphs=Pick(".RichTextArticleBody p, .Page-articleBody p, article p", sep=""),
                images=Pick("img[src]", attr="src", within=_UH),
                crumb=Pick(".Breadcrumb a, nav.breadcrumb a", sep="", first=True),
                **_metas("og:title", "og:image", "article:published_time", "article:section"),
            )
        ),
        _ultimahora,
    ),
    "npy": Parser(
        "articles",
        _paged(
            h1=Pick("h1", first=True), title=Pick("title", first=True), page=Pick(), images=Pick("img[src]", attr="src"),
            **{f"body{i}": Pick("p", within=s) for i, s in enumerate(NPY_BODIES)},
        ),
        _npy,
    ),
}
