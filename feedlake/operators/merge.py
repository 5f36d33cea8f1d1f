"""Keyed merges as functions from (target, batch) to the new target.

For tables whose format supports MERGE (a v2 catalog such as Iceberg or Delta)
the `*_table` forms issue one; the image has no such catalog, so those two are
not covered by tests.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlake.operators.dedupe import one_per_key
from feedlake.operators.joins import without_keys


def not_yet_stored(target: DataFrame, batch: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """Rows of the batch to insert: first per key, null keys rejected."""
    fresh = without_keys(batch.filter(F.col(key).isNotNull()), target, key)
    return one_per_key(fresh, key, order)


def insert_only(target: DataFrame, batch: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """Rows already stored win; new keys are added."""
    return target.unionByName(not_yet_stored(target, batch, key, order))


def upsert(target: DataFrame, batch: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """Rows of the batch replace stored rows with the same key."""
    latest = one_per_key(batch.filter(F.col(key).isNotNull()), key, order)
    return without_keys(target, batch, key).unionByName(latest.select(*target.columns))


def insert_only_table(batch: DataFrame, table: str, key: str, order: list[Column]) -> None:
    fresh = one_per_key(batch.filter(F.col(key).isNotNull()), key, order).alias("s")
    fresh.mergeInto(table, F.col(f"{table}.{key}") == F.col(f"s.{key}")).whenNotMatched().insertAll().merge()


def upsert_table(batch: DataFrame, table: str, key: str, order: list[Column]) -> None:
    latest = one_per_key(batch.filter(F.col(key).isNotNull()), key, order).alias("s")
    (
        latest.mergeInto(table, F.col(f"{table}.{key}") == F.col(f"s.{key}"))
        .whenMatched()
        .updateAll()
        .whenNotMatched()
        .insertAll()
        .merge()
    )
