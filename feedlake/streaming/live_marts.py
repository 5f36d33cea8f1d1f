"""Daily marts kept up to date: counts of superseded articles are taken off, those of new ones are added.

Each id has a state of its own: the row that its counts come from. A micro-batch reads and writes the states of its own ids
only, and gives the rows to take off and to add. Their counts per day and key are stored as changes, one folder per batch and
mart; a mart is the sum of its changes. `fold` adds up what is there, so that readers sum fewer rows.

The last micro-batch that holds an id wins; within one, the latest arrival. So the marts equal those built from
silver after every batch.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.types import StructType

from feedlake.operators.tables import last_batch, last_snapshot, read_batches, write_batch
from feedlake.plans.marts import daily_keyword, daily_source
from feedlake.plans.silver import cleaned
from feedlake.sources.messages import decode

# name: (key column, count column)
MARTS = {"gold_daily_source": ("source", "article_count"), "gold_daily_keyword": ("token", "freq")}

_ROW = "dt date, source string, title string"
_ORDER = ("kafka_ts", "source", "published_raw", "title")


def _schema(mart: str) -> StructType:
    key, count = MARTS[mart]
    return StructType().add(key, "string").add(count, "long").add("dt", "date")


class CountedRow(StatefulProcessor):
    """The row of an id that is counted now. Rows out: the one to take off (change -1) and the one to add (change 1)."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.counted = handle.getValueState("counted", _ROW)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        # Nulls come last, as they do where rows are sorted downwards.
        best = max(rows, key=lambda row: [(row[c] is not None, row[c]) for c in _ORDER])
        new = (best["dt"], best["source"], best["title"])
        if self.counted.exists():
            old = tuple(self.counted.get())
            if old == new:
                return
            yield Row(dt=old[0], source=old[1], title=old[2], change=-1)
        self.counted.update(new)
        yield Row(dt=new[0], source=new[1], title=new[2], change=1)

    def close(self) -> None:
        pass


def changed_rows(messages: DataFrame) -> DataFrame:
    """(dt, source, title, change) of a stream of messages."""
    rows = cleaned(decode(messages)).filter(F.col("id").isNotNull()).select("id", "dt", *_ORDER)
    return rows.groupBy("id").transformWithState(CountedRow(), f"{_ROW}, change int", "append", "None")


def _net(added: DataFrame, removed: DataFrame, mart: str) -> DataFrame:
    key, count = MARTS[mart]
    signed = added.unionByName(removed.withColumn(count, -F.col(count)))
    summed = signed.groupBy("dt", key).agg(F.sum(count).alias(count))
    return summed.filter(F.col(count) != 0).select(*_schema(mart).fieldNames())


def write_changes(batch: DataFrame, batch_id: int, root: str) -> None:
    """The changes of both marts that a batch of changed rows makes."""
    rows = batch.persist()
    try:
        added, removed = rows.filter("change > 0"), rows.filter("change < 0")
        for mart, build in (("gold_daily_source", daily_source), ("gold_daily_keyword", daily_keyword)):
            write_batch(_net(build(added), build(removed), mart), f"{root}/{mart}", batch_id, "dt")
    finally:
        rows.unpersist()


def start_live_marts(messages: DataFrame, root: str, **trigger) -> StreamingQuery:
    return (
        changed_rows(messages)
        .writeStream.foreachBatch(lambda batch, batch_id: write_changes(batch, batch_id, root))
        .option("checkpointLocation", f"{root}/checkpoint")
        .outputMode("append")
        .trigger(**(trigger or {"processingTime": "0 seconds"}))
        .start()
    )


def read_live(spark: SparkSession, root: str, mart: str, upto: int | None = None, where: Column | None = None) -> DataFrame:
    """A mart as of now, or as of a batch since the last fold; `where` on `dt` prunes folders."""
    key, count = MARTS[mart]
    path, schema = f"{root}/{mart}", _schema(mart)
    base = last_snapshot(spark, path)
    rows = read_batches(spark, path, schema, after=base, upto=upto).select(*schema.fieldNames())
    if base is not None:
        rows = rows.unionByName(spark.read.schema(schema).parquet(f"{path}/snapshot/upto={base}").select(*schema.fieldNames()))
    rows = rows if where is None else rows.filter(where)
    return rows.groupBy("dt", key).agg(F.sum(count).alias(count)).filter(F.col(count) > 0)


def fold(spark: SparkSession, root: str) -> None:
    """Add up the changes stored so far. Older folders are left alone: readers may still use them."""
    for mart in MARTS:
        path = f"{root}/{mart}"
        upto = last_batch(spark, path)
        if upto is not None and upto != last_snapshot(spark, path):
            read_live(spark, root, mart).write.mode("overwrite").partitionBy("dt").parquet(f"{path}/snapshot/upto={upto}")
