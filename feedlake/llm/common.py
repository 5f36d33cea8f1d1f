"""What the operators of this folder share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.session import cut_lineage

__all__ = ["cut_lineage", "documents", "ids_and_texts", "map_rows", "table"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def ids_and_texts(docs: DataFrame) -> DataFrame:
    """Only (doc_id, text), whatever else the frame holds; null text is empty."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))


def map_rows(df: DataFrame, task: Callable[[], Callable[[dict], dict]], schema: str, arrow: pa.Schema) -> DataFrame:
    """Arrow batches through `task()`, which each task calls once to get its own
    function from a dict of column lists to a dict of column lists."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        each = task()
        for batch in batches:
            if batch.num_rows:
                out = each({name: batch.column(i).to_pylist() for i, name in enumerate(batch.schema.names)})
                yield pa.RecordBatch.from_pydict(out, schema=arrow)

    return df.mapInArrow(run, schema)
