"""Keep one row per key.

`row_number() = 1` is planned with a group limit on the map side, so each task
ships at most one row per key: a key that holds a third of the table reaches
its reducer as one row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedlake.session import BROADCAST_BYTES, cut_lineage, measure


def one_per_key(df: DataFrame, key: str | list[str], order: list[Column]) -> DataFrame:
    keys = [key] if isinstance(key, str) else key
    ranked = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_nth", F.row_number().over(ranked)).filter(F.col("_nth") == 1).drop("_nth")


def one_per_key_apart(df: DataFrame, key: str, order: list[Column], limit_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """The same for a frame that can be read several times: only rows whose key occurs again are shuffled.

    The keys that occur again are found among the keys alone; if they do not fit a broadcast, all rows take the shuffled way.
    Null keys are left out.
    """
    rows = df.filter(F.col(key).isNotNull())
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1)
    repeated = cut_lineage(counts.select(key), "repeated-keys")
    if measure(repeated)[1] > limit_bytes:
        return one_per_key(rows, key, order)
    few = F.broadcast(repeated)
    alone, several = (rows.join(few, key, kind).select(*df.columns) for kind in ("left_anti", "left_semi"))
    return alone.unionByName(one_per_key(several, key, order))


def first_seen(events: DataFrame, order: list[Column], published: DataFrame | None = None, key: str = "id") -> DataFrame:
    """First arrival of each key that has not been published before."""
    fresh = one_per_key(events.filter(F.col(key).isNotNull()), key, order)
    if published is None:
        return fresh
    return fresh.join(published.select(key).distinct(), key, "left_anti")
