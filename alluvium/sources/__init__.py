"""The sources of the library: a parser for each, by name."""

from .base import Parser


def parsers() -> dict[str, Parser]:
    from . import news, shops

    return news.PARSERS | shops.PARSERS
