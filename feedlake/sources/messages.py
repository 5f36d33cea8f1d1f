"""The message log: (key, value, timestamp) with JSON values.

Offline the log is a folder of parquet files with these three columns; with
the Kafka connector on the class path the same frames come from and go to a
topic. The connector is not in the image, so the `kafka` forms are untested.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.schema import EVENT, EVENT_FIELDS, MESSAGE


def to_messages(events: DataFrame, timestamp: str | None = None) -> DataFrame:
    """Key and JSON value; absent fields stay in the JSON as null."""
    body = F.to_json(F.struct(*EVENT_FIELDS), {"ignoreNullFields": "false"})
    sent = F.col(timestamp) if timestamp else F.current_timestamp()
    return events.select(F.col("id").alias("key"), body.alias("value"), sent.alias("timestamp"))


def publish_files(messages: DataFrame, path: str) -> None:
    messages.write.mode("append").parquet(path)


def publish_kafka(messages: DataFrame, servers: str, topic: str) -> None:
    (
        messages.select("key", "value")
        .write.format("kafka")
        .options(**{"kafka.bootstrap.servers": servers, "topic": topic})
        .options(**{"kafka.acks": "all", "kafka.retries": "5", "kafka.linger.ms": "200"})
        .save()
    )


def message_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MESSAGE).parquet(path)


def message_file_stream(spark: SparkSession, path: str, per_batch: int | None = None) -> DataFrame:
    """The folder as a stream; `per_batch` limits the files of one micro-batch."""
    limit = {"maxFilesPerTrigger": str(per_batch)} if per_batch else {}
    return spark.readStream.schema(MESSAGE).options(**limit).parquet(path)


def message_kafka_stream(spark: SparkSession, servers: str, topic: str, per_batch: int | None = None) -> DataFrame:
    """The topic as a stream; `per_batch` limits the messages of one micro-batch."""
    limit = {"maxOffsetsPerTrigger": str(per_batch)} if per_batch else {}
    raw = (
        spark.readStream.format("kafka")
        .options(**{"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": "earliest"}, **limit)
        .load()
    )
    return raw.select("key", "value", "timestamp")


def decode(messages: DataFrame) -> DataFrame:
    """Typed event columns and `kafka_ts`; an unreadable value gives nulls."""
    parsed = F.from_json(F.col("value").cast("string"), EVENT)
    return messages.select(parsed.alias("e"), F.col("timestamp").alias("kafka_ts")).select("e.*", "kafka_ts")
