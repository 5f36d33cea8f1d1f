"""Feed entries to events, first-seen filtering, and poll counters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedlake.functions.ids import link_id
from feedlake.functions.text import first_filled, strip
from feedlake.functions.times import iso
from feedlake.operators.dedupe import first_seen
from feedlake.operators.seen import first_unseen
from feedlake.schema import POLL_SECONDS
from feedlake.session import cut_lineage, list_names
from feedlake.sources.feeds import read_documents, tagged
from feedlake.sources.messages import message_files, publish_files, to_messages


def to_events(entries: DataFrame, ingested_at: Column | None = None, keep: list[str] | None = None) -> DataFrame:
    """Entries with a link as events; `keep` names further columns to carry."""
    link = F.coalesce(F.col("link"), F.lit(""))
    stamp = iso(F.current_timestamp()) if ingested_at is None else ingested_at
    return (
        entries.filter(link != "")
        .select(
            link_id(link).alias("id"),
            F.col("source"),
            strip(F.coalesce(F.col("title"), F.lit(""))).alias("title"),
            strip(first_filled(F.col("summary"), F.col("description"))).alias("summary"),
            link.alias("link"),
            first_filled(F.col("published"), F.col("updated")).alias("published_raw"),
            stamp.alias("ingested_at"),
            *(keep or []),
        )
    )


def list_order() -> list[Column]:
    """Place of the feed in the list, then place in the feed document."""
    return [F.col("feed_no").asc(), F.col("entry_no").asc(), F.col("title").asc(), F.col("published_raw").asc()]


def publish_new(
    documents: DataFrame, feeds: DataFrame, log: str, ingested_at: Column | None = None, sent_at: Column | None = None
) -> DataFrame:
    """Publish the entries of landed feed documents that the log does not hold yet.

    `documents(feed_url, xml)` are tagged by `feeds(feed_no, source, feed_url)`; of entries
    with one link the first in list order is published. Returns (feed_url, documents, unread, entries):
    per feed of the list how many documents came, could not be read, and how many entries were in them.
    """
    spark = documents.sparkSession
    sent = F.current_timestamp() if sent_at is None else sent_at
    entries, lost = read_documents(documents)
    events = to_events(tagged(entries, feeds), ingested_at, keep=["feed_no", "entry_no"])
    if list_names(spark, log):
        fresh = first_unseen(events, list_order(), message_files(spark, log).select(F.col("key").alias("id")))
    else:
        fresh = first_seen(events, list_order())
    publish_files(to_messages(fresh.withColumn("_sent", sent), "_sent"), log)
    came = documents.groupBy("feed_url").agg(F.count(F.lit(1)).alias("documents"))
    unread = lost.groupBy("feed_url").agg(F.count(F.lit(1)).alias("unread"))
    found = entries.groupBy("feed_url").agg(F.count(F.lit(1)).alias("entries"))
    report = feeds.join(came, "feed_url", "left").join(unread, "feed_url", "left").join(found, "feed_url", "left")
    counts = [F.coalesce(name, F.lit(0)).alias(name) for name in ("documents", "unread", "entries")]
    return report.orderBy("feed_no").select("feed_url", *counts)


def poll_counters(events: DataFrame, arrived: str, poll_seconds: int = POLL_SECONDS) -> DataFrame:
    """(poll_at, published_count, seen_total) per poll that published anything.

    The running total is taken within each day and shifted by the total of the
    days before it. Only the day totals, one row per day, meet in one task.
    """
    poll = F.timestamp_seconds(F.floor(F.unix_timestamp(arrived) / poll_seconds) * poll_seconds)
    counts = events.groupBy(poll.alias("poll_at")).agg(F.count(F.lit(1)).alias("published_count"))
    # One row per poll; stored, as two windows look at them.
    counts = cut_lineage(counts.withColumn("_day", F.to_date("poll_at")), "polls")
    before = Window.orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    days = counts.groupBy("_day").agg(F.sum("published_count").alias("_n"))
    shifted = days.select("_day", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    within = Window.partitionBy("_day").orderBy("poll_at").rowsBetween(Window.unboundedPreceding, 0)
    return (
        counts.withColumn("_running", F.sum("published_count").over(within))
        .join(shifted, "_day")
        .select("poll_at", "published_count", (F.col("_running") + F.col("_offset")).alias("seen_total"))
    )
