"""Streams from the message log into bronze and silver, and watermark dedupe.

Bronze and silver take one folder per micro-batch (see `operators.tables`). A batch
that is delivered again overwrites its own folders, so at-least-once delivery
leaves each id once. The dedupe stream keeps its ids in Spark's state store.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DateType, StructField, StructType

from feedlake.operators.dedupe import one_per_key_apart
from feedlake.operators.joins import without_keys
from feedlake.operators.tables import (
    current_rows,
    stored_keys,
    stored_rows,
    write_batch,
    write_keyed,
    write_keys,
)
from feedlake.plans.silver import arrival_order, silver_batch
from feedlake.schema import BRONZE, SILVER, SILVER_LOG, WATERMARK
from feedlake.session import path_exists
from feedlake.sources.messages import decode

# How often a running ingest looks whether a query has ended.
POLL_SECONDS = 1

FIRST = StructType([*BRONZE.fields, StructField("day", DateType())])

_CHECK = "spark.sql.streaming.unsupportedOperationCheck"


def event_stream(messages: DataFrame, delay: str = WATERMARK) -> DataFrame:
    """Decoded events; each progress report counts them and those without an id."""
    events = decode(messages).withWatermark("kafka_ts", delay)
    without_id = F.count_if(F.col("id").isNull())
    return events.observe("events", F.count(F.lit(1)).alias("total"), without_id.alias("without_id"))


def write_bronze(batch: DataFrame, batch_id: int, root: str) -> None:
    """Insert the ids of a batch that no other batch has stored; rows without one are rejected.

    Of what is stored only the key buckets are read in which the batch has ids.
    """
    fresh = batch.filter(F.col("id").isNotNull()).persist()
    try:
        known = stored_keys(fresh.select("id").distinct(), root, BRONZE, "id", without=batch_id)
        new = one_per_key_apart(without_keys(fresh, known, "id"), "id", arrival_order())
        write_batch(new.select(*BRONZE.fieldNames()), root, batch_id, "source")
        stored = batch.sparkSession.read.schema(BRONZE).parquet(f"{root}/log/batch_id={batch_id}")
        write_keys(stored.select("id"), root, batch_id, "id")
    finally:
        fresh.unpersist()


def write_silver(batch: DataFrame, batch_id: int, root: str) -> None:
    """Append the clean rows of a batch; readers take the latest per id."""
    kept = batch.persist()
    try:
        write_keyed(silver_batch(kept), root, batch_id, "id", "dt")
    finally:
        kept.unpersist()


def read_bronze(spark: SparkSession, root: str) -> DataFrame:
    return stored_rows(spark, root, BRONZE)


def read_silver(spark: SparkSession, root: str) -> DataFrame:
    return current_rows(spark, root, SILVER_LOG, "id").select(*SILVER.fieldNames())


def _start(events: DataFrame, write, root: str, trigger: dict) -> StreamingQuery:
    return (
        events.writeStream.foreachBatch(lambda batch, batch_id: write(batch, batch_id, root))
        .option("checkpointLocation", f"{root}/checkpoint")
        .outputMode("append")
        .trigger(**trigger)
        .start()
    )


def start_bronze(events: DataFrame, root: str, **trigger) -> StreamingQuery:
    return _start(events, write_bronze, root, trigger or {"processingTime": "0 seconds"})


def start_silver(events: DataFrame, root: str, **trigger) -> StreamingQuery:
    return _start(events, write_silver, root, trigger or {"processingTime": "0 seconds"})


def run_ingest(messages: DataFrame, root: str, **trigger) -> None:
    """Both tables from one definition of the events; ends when a query ends.

    With `availableNow=True` both queries are run to their end.
    """
    events = event_stream(messages)
    running = [start_bronze(events, f"{root}/bronze", **trigger), start_silver(events, f"{root}/silver", **trigger)]
    if trigger.get("availableNow"):
        for query in running:
            query.awaitTermination()
    while all(query.isActive for query in running):
        running[0].awaitTermination(POLL_SECONDS)
    for query in running:
        if query.exception() is not None:
            raise query.exception()


def first_events(messages: DataFrame, delay: str = WATERMARK) -> DataFrame:
    """The first event of each id, on Spark's own state: late events are dropped, and an id is remembered until
    the watermark has passed the time of its event by the delay.

    Across micro-batches the earlier one wins. Within one, the first by arrival among those in time wins, as the
    rows of a state partition are sorted below the operator; they are shuffled once, by id, and only ids and times are kept.
    What one micro-batch holds is bounded by `per_batch` of its source.
    """
    events = decode(messages).filter(F.col("id").isNotNull()).withWatermark("kafka_ts", delay)
    arranged = events.repartition("id").sortWithinPartitions("id", *arrival_order())
    return arranged.dropDuplicatesWithinWatermark(["id"])


@contextmanager
def _sorted_batches(spark: SparkSession):
    """Streams refuse sorts, as no order holds across micro-batches. Here one within a partition of a micro-batch is
    meant, so the check is left out for what is started inside."""
    known = spark.conf.get(_CHECK, None)
    spark.conf.set(_CHECK, "false")
    try:
        yield
    finally:
        spark.conf.unset(_CHECK) if known is None else spark.conf.set(_CHECK, known)


def start_dedupe(messages: DataFrame, root: str, delay: str = WATERMARK, **trigger) -> StreamingQuery:
    """Store the first event per id, in folders by day. The file sink lists what complete micro-batches have
    written, so a batch that is run again leaves each event once."""
    rows = first_events(messages, delay).withColumn("day", F.to_date("kafka_ts"))
    with _sorted_batches(rows.sparkSession):
        return (
            rows.writeStream.format("parquet")
            .option("path", f"{root}/first")
            .option("checkpointLocation", f"{root}/checkpoint")
            .partitionBy("day")
            .outputMode("append")
            .trigger(**(trigger or {"processingTime": "0 seconds"}))
            .start()
        )


def read_first(spark: SparkSession, root: str) -> DataFrame:
    if not path_exists(spark, f"{root}/first"):
        return spark.createDataFrame([], BRONZE)
    return spark.read.schema(FIRST).parquet(f"{root}/first").select(*BRONZE.fieldNames())


def batch_report(query: StreamingQuery) -> list[tuple[int, int, int, int, str]]:
    """(batch, rows read, rows dropped as late, rows dropped as repeated, watermark it ran with) of the latest
    micro-batches of a query with state, from its progress reports."""
    rows = []
    for progress in query.recentProgress:
        states = progress["stateOperators"]
        late = sum(state["numRowsDroppedByWatermark"] for state in states)
        repeated = sum(state.get("customMetrics", {}).get("numDroppedDuplicateRows", 0) for state in states)
        rows.append((progress["batchId"], progress["numInputRows"], late, repeated, progress.get("eventTime", {}).get("watermark")))
    return rows
