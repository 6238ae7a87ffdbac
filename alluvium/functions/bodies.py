"""Bodies as zstd frames in a BINARY column, for tables that other programs read or write so.

Coding runs in Arrow batches and only on rows that are left once other columns were filtered: Spark keeps such filters
below the coding, and a projection without the body never decodes it.
"""

from __future__ import annotations

import pandas as pd
import zstandard
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the level that stored bodies have; any level can be read.
LEVEL = 6


def packed(text: Column) -> Column:
    """UTF-8 text as a zstd frame; null stays null, an empty text is a frame of nothing."""

    @F.pandas_udf(T.BinaryType())
    def run(texts: pd.Series) -> pd.Series:
        pack = zstandard.ZstdCompressor(level=LEVEL).compress
        return texts.map(lambda t: None if t is None else pack(t.encode("utf-8", "surrogatepass")))

    return run(text)


def unpacked(blob: Column) -> Column:
    """The text of a zstd frame, whether or not the frame tells its size; null where it is null or no such frame of UTF-8."""

    @F.pandas_udf(T.StringType())
    def run(blobs: pd.Series) -> pd.Series:
        def text(b: bytes | None) -> str | None:
            if b is None:
                return None
            try:
                reader = zstandard.ZstdDecompressor().decompressobj()
                found = reader.decompress(bytes(b))
                return found.decode("utf-8") if reader.eof else None
            except (zstandard.ZstdError, UnicodeDecodeError):
                return None

        return blobs.map(text)

    return run(blob)
