"""Article ids and the numeric ids of index points."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedlake.schema import ID_HEX_CHARS

_HALF = Decimal(1 << 63)


def link_id(link: Column) -> Column:
    """Leading hex digits of the SHA-256 of the link."""
    return F.substring(F.sha2(link, 256), 1, ID_HEX_CHARS)


def point_id(article_id: Column) -> Column:
    """Hex id as an unsigned 64-bit number, which needs a decimal in Spark."""
    return F.conv(article_id, 16, 10).cast("decimal(20,0)")


def point_to_long(point: Column) -> Column:
    """Order-preserving move of the unsigned range onto signed longs."""
    return (point - F.lit(_HALF)).cast("long")


def long_to_point(key: Column) -> Column:
    return (key.cast("decimal(20,0)") + F.lit(_HALF)).cast("decimal(20,0)")
