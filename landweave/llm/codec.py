"""Compression of texts under way, with a dictionary of their own."""

from __future__ import annotations

import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SAMPLED, SAMPLE_CHARS, DICTIONARY, LEVEL = 1000, 4000, 1 << 16, 6


def codec_dictionary(docs: DataFrame, column: str = "text") -> bytes | None:
    """A dictionary for the compression of texts under way, from the starts of at most ``SAMPLED`` texts; results don't depend on it."""
    rows = docs.select(F.substring(column, 1, SAMPLE_CHARS).alias("t")).filter(F.length("t") > 100).limit(SAMPLED).collect()
    try:
        return zstandard.train_dictionary(DICTIONARY, [r.t.encode() for r in rows]).as_bytes()
    except zstandard.ZstdError:  # too few texts
        return None


def packers(dictionary: bytes | None, level: int = LEVEL):
    """Functions that compress and restore bytes."""
    shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    return zstandard.ZstdCompressor(level=level, dict_data=shared).compress, zstandard.ZstdDecompressor(dict_data=shared).decompress
