"""Running counts of published events, as a stream over the message log.

    log ─► counts per poll (window, partial counts in tasks) ─► total of the day (state per day) ─► rows

A poll is a span of event time. Its count is final when the watermark has passed its end; late events are dropped.
The second operator gets one row per poll and keeps one number per day, so that no task sees all events of
a busy day; an event-time timer at the end of the day closes it and clears its state. Totals of whole days are
added up by readers, from one row per day.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from feedlake.schema import POLL_SECONDS
from feedlake.session import path_exists
from feedlake.sources.messages import decode

COUNTERS = "day date, poll_at timestamp, published_count long, day_total long"


class DayTotal(StatefulProcessor):
    """Adds the polls of a day up. Rows out: each poll with the total so far and, when the day is over, one without a poll."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.total = handle.getValueState("total", "n long")

    def _known(self) -> int:
        return self.total.get()[0] if self.total.exists() else 0

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        total = self._known()
        if not total:
            over = dt.datetime.combine(key[0] + dt.timedelta(days=1), dt.time(), dt.timezone.utc)
            self.handle.registerTimer(int(over.timestamp() * 1000))
        # Polls of later micro-batches are later ones, as a poll ends before its count is final.
        for poll_at, count in sorted((row["poll_at"], row["published_count"]) for row in rows):
            total += count
            yield Row(day=key[0], poll_at=poll_at, published_count=count, day_total=total)
        self.total.update((total,))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        total = self._known()
        self.total.clear()
        yield Row(day=key[0], poll_at=None, published_count=0, day_total=total)

    def close(self) -> None:
        pass


def poll_counts(messages: DataFrame, delay: str, poll_seconds: int = POLL_SECONDS) -> DataFrame:
    """(day, poll_at, published_count, day_total) as a stream. Messages without an id count for nothing, but move the
    watermark: a poller that finds nothing can say so. Days are those of UTC."""
    events = decode(messages).select("id", "kafka_ts").withWatermark("kafka_ts", delay)
    polls = events.groupBy(F.window("kafka_ts", f"{poll_seconds} seconds").alias("poll"))
    counted = polls.agg(F.count("id").alias("published_count"))
    day = F.date_from_unix_date(F.floor(F.unix_seconds("poll.start") / 86400).cast("int"))
    rows = counted.select(F.window_time("poll").alias("ends"), F.col("poll.start").alias("poll_at"), "published_count", day.alias("day"))
    by_day = rows.filter("published_count > 0").groupBy("day")
    return by_day.transformWithState(DayTotal(), COUNTERS, "append", "EventTime")


def start_counters(messages: DataFrame, root: str, delay: str = "1 minute", poll_seconds: int = POLL_SECONDS, **trigger) -> StreamingQuery:
    return (
        poll_counts(messages, delay, poll_seconds)
        .writeStream.format("parquet")
        .option("path", f"{root}/polls")
        .option("checkpointLocation", f"{root}/checkpoint")
        .outputMode("append")
        .trigger(**(trigger or {"processingTime": "0 seconds"}))
        .start()
    )


def _stored(spark: SparkSession, root: str) -> DataFrame:
    if not path_exists(spark, f"{root}/polls"):
        return spark.createDataFrame([], COUNTERS)
    return spark.read.schema(COUNTERS).parquet(f"{root}/polls")


def read_counters(spark: SparkSession, root: str) -> DataFrame:
    """(poll_at, published_count, seen_total) of the polls whose counts are final."""
    rows = _stored(spark, root)
    before = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    days = rows.groupBy("day").agg(F.max("day_total").alias("_n"))
    shift = days.select("day", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    polls = rows.filter(F.col("poll_at").isNotNull()).join(F.broadcast(shift), "day")
    return polls.select("poll_at", "published_count", (F.col("day_total") + F.col("_before")).alias("seen_total"))


def closed_days(spark: SparkSession, root: str) -> DataFrame:
    """(day, published_count) of the days that are over."""
    return _stored(spark, root).filter(F.col("poll_at").isNull()).select("day", F.col("day_total").alias("published_count"))
