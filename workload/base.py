"""The feed relation that the registered queries share.

Each document becomes one feed entry, its whole text being title and summary; the event
with the same number gives its time of arrival (a fixed one where there is none). Exact
copies of a text share a link and therefore an id. Every tenth document brings a second entry, with a
negative number, that has no link. The date texts take the forms that feeds
use: ISO with offset, a plain timestamp in `updated`, RFC-822, and none.
"""

from __future__ import annotations

from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.functions.times import iso
from feedlake.plans.ingest import to_events
from feedlake.session import BROADCAST_BYTES, cut_lineage, measure

FIRST_DAY = "2024-01-01"
LAST_DROP = 2
FEED_ROOT = "https://feeds.example/"
LINK_ROOT = "https://news.example/"
RFC822 = "Mon, 03 Nov 2025 10:00:00 +0900"
NO_EVENT = "2024-01-01 00:00:00"
# Broadcasts that the arrivals may take.
MOST_PIECES = 4


# Stated, so that no job has to look for them first.
SCHEMAS = {
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
    "embeddings": "vec_id long, embedding array<float>, label int",
    "pages": "page_id long, url string, html string",
    "benchmark": "item_id long, text string",
    "conversations": "conv_id long, turn long, role string, text string",
}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf}/{name}.parquet")


def feeds(spark: SparkSession, sf: str) -> DataFrame:
    """The feed list: the sources, in the order of their numbers."""
    names = table(spark, sf, "documents").select("source").distinct()
    number = F.regexp_extract("source", "([0-9]+)$", 1).cast("int")
    return names.select(number.alias("feed_no"), F.concat(F.lit(FEED_ROOT), F.col("source")).alias("feed_url"), "source")


def dated(spark: SparkSession, sf: str, limit_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Documents with their time of arrival, `kafka_ts`.

    Of the arrivals only those of documents are kept. While they fit a few broadcasts, the texts are not shuffled, however
    often the frame is read (once per broadcast); else they are shuffled once, and the frame is stored.
    """
    documents = table(spark, sf, "documents").select(
        "doc_id",
        "source",
        "lang",
        "text",
        F.concat(F.lit(LINK_ROOT), F.md5(F.col("text"))).alias("link"),
    )
    known = documents.select("doc_id")
    if measure(known)[1] <= limit_bytes:
        known = F.broadcast(known)
    arrivals = table(spark, sf, "events").select(
        F.col("event_id").alias("doc_id"), F.col("ts").cast("timestamp").alias("_arrived")
    )
    arrivals = cut_lineage(arrivals.join(known, "doc_id", "left_semi"), "arrivals")
    pieces = max(1, ceil(measure(arrivals)[1] / max(1, limit_bytes)))
    small = pieces <= MOST_PIECES
    if small and pieces > 1:
        own = [F.pmod(F.xxhash64("doc_id"), F.lit(pieces)) == n for n in range(pieces)]
        joined = reduce(
            DataFrame.unionByName,
            [documents.filter(mine).join(F.broadcast(arrivals.filter(mine)), "doc_id", "left") for mine in own],
        )
    else:
        joined = documents.join(F.broadcast(arrivals) if small else arrivals, "doc_id", "left")
    found = joined.withColumn("kafka_ts", F.coalesce("_arrived", F.lit(NO_EVENT).cast("timestamp"))).drop("_arrived")
    return found if small else cut_lineage(found, "dated")


def entries(spark: SparkSession, sf: str) -> DataFrame:
    """One entry per document, and the linkless ones.

    A text goes through the join once, title and summary are made of it behind the join.
    """
    form = F.col("doc_id") % 4
    french = F.col("lang") == "fr"
    moment = F.col("kafka_ts")
    rows = dated(spark, sf).select(
        "doc_id",
        "source",
        F.concat(F.lit(FEED_ROOT), F.col("source")).alias("feed_url"),
        "link",
        F.concat(F.lit("  "), F.col("text"), F.lit("　")).alias("title"),
        F.when(~french, F.col("text")).alias("summary"),
        F.when(french, F.col("text")).alias("description"),
        form.alias("_form"),
        "kafka_ts",
    )
    # The second, linkless entries.
    twice = F.when(F.col("doc_id") % 10 == 0, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    return rows.withColumn("_bare", F.explode(twice)).select(
        F.when(F.col("_bare"), -1 - F.col("doc_id")).otherwise(F.col("doc_id")).alias("doc_id"),
        "source",
        "feed_url",
        F.when(F.col("_bare"), F.lit("")).otherwise(F.col("link")).alias("link"),
        "title",
        F.when(F.col("_form") == 0, F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ssxxx"))
        .when(F.col("_form") == 2, F.lit(RFC822))
        .otherwise(F.lit(""))
        .alias("published"),
        F.when(F.col("_form") == 1, F.date_format(moment, "yyyy-MM-dd HH:mm:ss")).alias("updated"),
        "summary",
        "description",
        "kafka_ts",
    )


def drop_number(moment: Column) -> Column:
    """Arrivals come in three drops: the first day, the second, all later ones."""
    days = F.datediff(F.to_date(moment), F.lit(FIRST_DAY).cast("date"))
    return F.greatest(F.lit(0), F.least(F.lit(LAST_DROP), days))


def events(spark: SparkSession, sf: str) -> DataFrame:
    """Events with arrival time and drop number."""
    stamped = entries(spark, sf).withColumn("drop_no", drop_number(F.col("kafka_ts")))
    return to_events(stamped, ingested_at=iso(F.col("kafka_ts")), keep=["kafka_ts", "drop_no"])


def shown(moment: Column) -> Column:
    """Timestamps leave the queries as text, so that both engines agree."""
    return F.date_format(moment, "yyyy-MM-dd HH:mm:ss.SSSSSS")
