"""Column functions on URLs: parts, canonical form, predicates of the crawl frontier, request identity."""

from __future__ import annotations

from functools import reduce
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

# Fixed values.
TRACKING = (
    "utm_source", "utm_medium", "utm_campaign", "utm_content", "utm_term", "utm_id", "utm_name", "utm_reader",
    "fbclid", "gclid", "mc_eid", "mc_cid", "yclid", "msclkid", "_ga", "_gl",
)
SKIP_EXTENSIONS = (
    ".pdf", ".jpg", ".jpeg", ".png", ".gif", ".svg", ".webp", ".css", ".js", ".zip", ".mp4", ".mp3", ".ico", ".woff", ".woff2", ".rss", ".xml", ".atom",
)
IMAGE_BLACKLIST = ("logo", "icon", "avatar", "emoji", "gravatar", "sprite", "pixel", "tracking", "badge")

_PARTS = r"^(?:([^:/?#]+):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"


def part(url: Column, n: int) -> Column:
    return F.regexp_extract(url, _PARTS, n)


def netloc(url: Column) -> Column:
    return F.lower(part(url, 2))


def path(url: Column) -> Column:
    return part(url, 3)


def _encoded(x: Column) -> Column:
    raw = F.coalesce(F.try_url_decode(x), x)
    e = F.url_encode(raw)
    return F.replace(F.replace(F.replace(e, F.lit("+"), F.lit("%20")), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def canonical(url: Column) -> Column:
    """Scheme and host in lower case, tracking parameters and fragment off; order, blanks and path case kept."""
    pairs = F.filter(F.split(part(url, 4), "&"), lambda p: (p != "") & ~F.coalesce(F.try_url_decode(F.substring_index(p, "=", 1)), F.substring_index(p, "=", 1)).isin(*TRACKING))
    kept = F.transform(pairs, lambda p: F.concat(_encoded(F.substring_index(p, "=", 1)), F.lit("="), _encoded(F.when(F.instr(p, "=") > 0, F.regexp_replace(p, "^[^=]*=", "")).otherwise(F.lit("")))))
    query = F.array_join(kept, "&")
    scheme = F.when(part(url, 1) != "", F.concat(F.lower(part(url, 1)), F.lit(":"))).otherwise(F.lit(""))
    head = F.concat(scheme, F.when(netloc(url) != "", F.concat(F.lit("//"), netloc(url))).otherwise(F.lit("")))
    return F.concat(head, path(url), F.when(query != "", F.concat(F.lit("?"), query)).otherwise(F.lit("")))


def segments(url: Column) -> Column:
    return F.filter(F.split(path(url), "/"), lambda s: s != "")


def extension(url: Column) -> Column:
    """The suffix of the last segment, trailing slashes off; a name's first character starts none."""
    plain = F.regexp_replace(path(url), ";[^/]*$", "")  # parameters of the last segment don't belong to its name
    names = F.filter(F.split(plain, "/"), lambda s: ~s.isin("", "."))
    return F.lower(F.regexp_extract(F.coalesce(F.try_element_at(names, F.lit(-1)), F.lit("")), r"(?s)^.+(\.[^.]+)$", 1))


def repeats_segment(url: Column) -> Column:
    return F.size(segments(url)) != F.size(F.array_distinct(segments(url)))


def should_enqueue(url: Column, domains: tuple[str, ...], ignore: tuple[str, ...] = ()) -> Column:
    """For canonical addresses: a known host, no file, no path that repeats a segment, no ignored pattern."""
    ok = netloc(url).isin(*domains) & ~extension(url).isin(*SKIP_EXTENSIONS) & ~repeats_segment(url)
    return reduce(lambda a, p: a & ~url.rlike(p), ignore, ok)


def should_persist(url: Column, patterns: tuple[str, ...] = ()) -> Column:
    return reduce(lambda a, b: a | b, [url.rlike(p) for p in patterns]) if patterns else F.lit(True)


def request_key(url: Column, params: Column, headers: Column | None = None) -> Column:
    """Identity of a request: URL with sorted parameters and headers."""
    empty = F.create_map().cast("map<string,string>")
    sorted_json = lambda m: F.to_json(F.map_from_entries(F.array_sort(F.map_entries(F.coalesce(m, empty)))))
    return F.concat_ws("\n", url, sorted_json(params), sorted_json(headers if headers is not None else empty))


@F.pandas_udf(StringType())
def join(base: pd.Series, href: pd.Series) -> pd.Series:
    return pd.Series([None if h is None else urljoin(b or "", h) for b, h in zip(base, href)])


@F.pandas_udf(ArrayType(StringType()))
def join_all(base: pd.Series, hrefs: pd.Series) -> pd.Series:
    return pd.Series([[] if hs is None else [urljoin(b or "", h) for h in hs] for b, hs in zip(base, hrefs)], dtype=object)


@F.pandas_udf(ArrayType(StringType()))
def join_site(page: pd.Series, site: pd.Series, hrefs: pd.Series) -> pd.Series:
    """Links as a browser sees them from the page, but bare relative ones from the site's root; blank ones go."""

    def joined(p: str, s: str, href: str) -> str | None:
        rooted = href[0] in "/?#" or ":" in href.split("/", 1)[0]
        try:
            return urljoin(p if rooted else s.rstrip("/") + "/", href)
        except ValueError:
            return None

    def all_of(p, s, hs) -> list[str]:
        found = (joined(p or "", s, h.strip()) for h in hs if h and h.strip())
        return [u for u in found if u]

    return pd.Series([[] if hs is None else all_of(p, s, hs) for p, s, hs in zip(page, site, hrefs)], dtype=object)


def images_kept_any(urls: Column) -> Column:
    """Without logos, icons and the like; nulls go."""
    return F.filter(urls, lambda u: u.isNotNull() & ~F.lower(u).rlike("|".join(IMAGE_BLACKLIST)))


def images_kept(urls: Column) -> Column:
    return F.filter(images_kept_any(urls), lambda u: u.startswith("http"))


def ordered_distinct(*arrays: Column) -> Column:
    return F.array_distinct(F.filter(F.concat(*arrays), lambda u: u.isNotNull() & (u != "")))
