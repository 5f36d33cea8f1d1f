"""Time expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO_PATTERN = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"
RFC822_PATTERN = "dd MMM yyyy HH:mm:ss Z"


def iso(moment: Column) -> Column:
    """ISO-8601 text with offset in the session zone."""
    return F.date_format(moment, ISO_PATTERN)


def parsed(raw: Column, rfc822: bool = False) -> Column:
    """Timestamp of a text, null where it cannot be read.

    The usual feed form (`Mon, 03 Nov 2025 10:00:00 +0900`) is not readable
    without a pattern; by default it therefore gives null. With `rfc822` the
    weekday is cut and the rest read by pattern.
    """
    plain = F.try_to_timestamp(raw)
    if not rfc822:
        return plain
    dated = F.try_to_timestamp(F.substring_index(raw, ", ", -1), F.lit(RFC822_PATTERN))
    return F.coalesce(plain, dated)


def published_at(raw: Column, arrived: Column, rfc822: bool = False) -> Column:
    return F.coalesce(parsed(raw, rfc822), arrived)
