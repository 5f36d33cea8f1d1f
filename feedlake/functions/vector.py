"""Vector expressions over `array<double>` columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedlake.schema import EMBED_DIM

_DIGEST_BYTES = 32


def norm(vector: Column) -> Column:
    return F.sqrt(F.aggregate(vector, F.lit(0.0), lambda total, x: total + x * x))


def _bound(value: Column, body) -> Column:
    """`body(value)` with the value computed once, however often body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def hash_embedding(text: Column, dim: int = EMBED_DIM) -> Column:
    """A deterministic unit vector made from the SHA-256 of a text.

    Each digest byte b stands for b / 255 - 0.5, the 32 values are repeated up
    to `dim` and the whole is scaled to length 1. Digest and length are bound
    once per row, and lambdas run over 32 values only: the repetition does not
    change the direction, and the length follows from the 32 squares. A byte is
    never exactly 127.5, so the length is positive.
    """
    if dim % _DIGEST_BYTES:
        raise ValueError(f"dim must be a multiple of {_DIGEST_BYTES}")
    copies = dim // _DIGEST_BYTES
    pairs = F.regexp_extract_all(F.sha2(text, 256), F.lit("(..)"), F.lit(1))
    values = F.transform(pairs, lambda pair: F.conv(pair, 16, 10).cast("double") / 255.0 - 0.5)

    def scaled(v: Column) -> Column:
        squares = F.aggregate(v, F.lit(0.0), lambda total, x: total + x * x)
        return _bound(F.sqrt(F.lit(float(copies)) * squares), lambda length: F.transform(v, lambda x: x / length))

    return F.flatten(F.array_repeat(_bound(values, scaled), copies))
