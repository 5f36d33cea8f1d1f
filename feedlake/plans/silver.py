"""Decoded events to clean articles, one per id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlake.functions.text import plain_body
from feedlake.functions.times import parsed, published_at
from feedlake.operators.dedupe import one_per_key, one_per_key_apart
from feedlake.schema import SILVER


def arrival_order() -> list[Column]:
    """First arrival first; the further columns settle equal times."""
    return [F.col("kafka_ts").asc(), F.col("source").asc(), F.col("published_raw").asc(), F.col("title").asc()]


def latest_order() -> list[Column]:
    return [F.col("kafka_ts").desc(), F.col("source").desc(), F.col("published_raw").desc(), F.col("title").desc()]


def cleaned(events: DataFrame, rfc822: bool = False) -> DataFrame:
    """Rows with a title, cleaned, not yet deduplicated."""
    moment = published_at(F.col("published_raw"), F.col("kafka_ts"), rfc822)
    return (
        events.filter(F.col("title").isNotNull() & (F.length("title") > 0))
        .withColumns(
            {
                "body": plain_body(F.col("summary")),
                "published_at": moment,
                "ingested_at": parsed(F.col("ingested_at"), rfc822),
            }
        )
        .withColumn("dt", F.to_date("published_at"))
    )


def silver(events: DataFrame, rfc822: bool = False) -> DataFrame:
    """Latest arrival per id. Null ids can match no stored row and are left out."""
    one = one_per_key(cleaned(events, rfc822).filter(F.col("id").isNotNull()), "id", latest_order())
    return one.select(*SILVER.fieldNames())


def silver_batch(events: DataFrame, rfc822: bool = False) -> DataFrame:
    """Silver rows of one batch with their arrival time, for the keyed log. The events are read several times."""
    one = one_per_key_apart(cleaned(events, rfc822), "id", latest_order())
    return one.select(*SILVER.fieldNames(), "kafka_ts")
