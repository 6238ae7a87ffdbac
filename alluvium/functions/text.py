"""Column functions on text: trimming, units in product names, keyword lists, slugs, titles."""

from __future__ import annotations

import unicodedata
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Unit patterns in their order; the first that matches decides. (?U) gives Unicode classes.
UNIT_PATTERNS = (
    (r"(?iU)\b(?:x\s*kg|kilos?|\d+\s*kg)\b\.?", "kg"),
    (r"(?iU)\b\d+(?:[.,]\d+)?\s*lts?\b\.?", "l"),
    (r"(?iU)\b\d+(?:[.,]\d+)?\s*l\b\.?", "l"),
    (r"(?iU)\b\d+(?:[.,]\d{1,3})?\s*ml\b\.?", "ml"),
    (r"(?iU)\b\d+\s*(?:gramos?|gr?s?)\b\.?", "g"),
    (r"(?iU)\b\d+\s*cc\b\.?", "cc"),
)


def strip(c: Column) -> Column:
    """Unicode white space off both ends."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def strip_or_null(c: Column) -> Column:
    return F.nullif(strip(c), F.lit(""))


def first_truthy(*cs: Column, default: str | None = None) -> Column:
    """The first that is neither null nor empty."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in cs], F.lit(default))


def unit_from_name(name: Column) -> Column:
    pairs = [(name.rlike(p), u) for p, u in UNIT_PATTERNS]
    return reduce(lambda rest, pu: F.when(pu[0], F.lit(pu[1])).otherwise(rest), reversed(pairs), F.lit(None).cast("string"))


def sku_from_text(c: Column) -> Column:
    return F.nullif(F.regexp_extract(c, r"(?iU)C[ÓO]DIGO\s*:\s*(\w+)", 1), F.lit(""))


def after_colon(c: Column) -> Column:
    return strip_or_null(F.regexp_extract(c, r"(?s):(.*)$", 1))


def keywords(c: Column) -> Column:
    return F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), ","), strip), lambda x: x != "")


def join_chunks(chunks: Column) -> Column:
    return F.nullif(F.array_join(F.filter(chunks, lambda x: strip(x) != ""), "\n\n"), F.lit(""))


def without_nul(c: Column) -> Column:
    return F.replace(c, F.char(F.lit(0)), F.lit(""))


def title_without_site(c: Column) -> Column:
    return strip(F.regexp_replace(c, r"(?iU)\s*[|\-–—]\s*(NPY|Noticias del Paraguay).*$", ""))


@F.pandas_udf(StringType())
def _fold(s: pd.Series) -> pd.Series:
    return s.map(lambda t: None if t is None else unicodedata.normalize("NFKD", t).encode("ascii", "ignore").decode())


def slugify(c: Column, fold: bool = True) -> Column:
    """Folded to ASCII, lower case, runs of other characters as one hyphen."""
    folded = _fold(c) if fold else c
    return F.regexp_replace(F.regexp_replace(F.lower(folded), "[^a-z0-9]+", "-"), "^-|-$", "")


def title_case_words(c: Column) -> Column:
    return F.initcap(F.replace(c, F.lit("-"), F.lit(" ")))
