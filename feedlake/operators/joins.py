"""Joins that stay safe when a side outgrows a broadcast or a key is hot."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake.session import BROADCAST_BYTES, cut_lineage, measure

# A key with more than one part in this many of all rows is split.
PIECES = 1000


def hot_keys(facts: DataFrame, on: str, pieces: int = PIECES) -> DataFrame:
    """(key, _pieces) of the keys that hold more than 1 / `pieces` of all rows.

    There are fewer than `pieces` of them, whatever the size of the facts.
    """
    total = facts.count()
    counts = facts.groupBy(on).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") * pieces > total)
    return counts.select(on, F.ceil(F.col("_n") * pieces / total).cast("int").alias("_pieces"))


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    on: str,
    spread_by: list[str],
    limit_bytes: int = BROADCAST_BYTES,
    pieces: int = PIECES,
) -> DataFrame:
    """Inner join of facts with a lookup table that has one row per key.

    A lookup whose measured size is below the limit is broadcast. Otherwise
    both sides are shuffled on (key, piece): rows of a hot key are spread over
    pieces by a hash of `spread_by`, which is stable when a lost task runs
    again, and only the lookup rows of hot keys are copied, once per piece.
    """
    if measure(lookup)[1] <= limit_bytes:
        return facts.join(F.broadcast(lookup), on)
    hot = F.broadcast(hot_keys(facts, on, pieces))
    count = F.coalesce("_pieces", F.lit(1))
    spread = facts.join(hot, on, "left").withColumn("_piece", F.pmod(F.xxhash64(*spread_by), count).cast("int"))
    copies = lookup.join(hot, on, "left").withColumn("_piece", F.explode(F.sequence(F.lit(0), count - 1)))
    return spread.drop("_pieces").join(copies.drop("_pieces"), [on, "_piece"]).drop("_piece")


def known_keys(
    target: DataFrame, batch_keys: DataFrame, key: str, limit_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Keys of the target that also occur in a batch (unique keys on both sides).

    For a batch below the limit the target is read once and never shuffled;
    what comes back is at most as large as the batch.
    """
    keys = target.select(key)
    if measure(batch_keys)[1] <= limit_bytes:
        return keys.join(F.broadcast(batch_keys), key, "left_semi")
    return keys.join(batch_keys, key, "left_semi")


def without_keys(rows: DataFrame, keys: DataFrame, key: str, limit_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Rows whose key is not among `keys`. The keys are stored first; while they fit a broadcast, the rows are
    not shuffled."""
    stored = cut_lineage(keys.select(key).filter(F.col(key).isNotNull()).distinct(), "keys")
    if measure(stored)[1] <= limit_bytes:
        stored = F.broadcast(stored)
    return rows.join(stored, key, "left_anti").select(*rows.columns)
