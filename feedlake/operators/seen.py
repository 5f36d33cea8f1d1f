"""Keys that a table already holds, found with a Bloom filter in front of the exact join.

The filter is a table of 64-bit words. A key sets a few bits of one word; the word is chosen by one hash and the bits
by another, so asking is a join on the number of the word. It is built with partial aggregation (a row
per word and task) and sized from the measured number of keys. While it fits a broadcast, the rows that
ask are not shuffled. A key whose bits are not all set is new for certain. The others, the known keys and few more, meet the table:
they are sent to it, so that neither its keys nor the rows that ask are shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlake.operators.dedupe import one_per_key
from feedlake.operators.joins import known_keys
from feedlake.session import BROADCAST_BYTES, cut_lineage, measure

# Bits of the filter for each key, and bits that a key sets. About four keys share a word; then less than 1 % of
# the keys that are not in the table pass, on average over the words.
BITS_PER_KEY = 16
BITS_SET = 5
FALSE_RATE = 0.01

_WORD_BITS = 64


@dataclass
class SeenFilter:
    table: DataFrame  # (_word, _bits)
    words: int


def _word(key: str, words: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(words).cast("long")).alias("_word")


def _mask(key: str) -> Column:
    """The bits of a key: six bits of a second hash choose each."""
    other = F.xxhash64(F.lit("seen"), F.col(key))
    bit = lambda n: F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftright(other, 6 * n).bitwiseAND(63).cast("int"))
    return reduce(lambda mask, n: mask.bitwiseOR(bit(n)), range(1, BITS_SET), bit(0))


def seen_filter(keys: DataFrame, key: str, n_keys: int) -> SeenFilter:
    """The filter over a table of keys; nulls are not in it."""
    words = max(1, ceil(n_keys * BITS_PER_KEY / _WORD_BITS))
    asked = keys.filter(F.col(key).isNotNull()).select(_word(key, words), _mask(key).alias("_mask"))
    return SeenFilter(cut_lineage(asked.groupBy("_word").agg(F.bit_or("_mask").alias("_bits")), "seen-filter"), words)


def with_maybe(rows: DataFrame, known: SeenFilter, key: str, limit_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """The rows with `_maybe`: false where the key is certainly not in the table."""
    table = F.broadcast(known.table) if measure(known.table)[1] <= limit_bytes else known.table
    asked = rows.withColumn("_word", _word(key, known.words)).join(table, "_word", "left")
    mask = _mask(key)
    return asked.withColumn("_maybe", F.coalesce(F.col("_bits").bitwiseAND(mask) == mask, F.lit(False))).drop("_word", "_bits")


def without_known(rows: DataFrame, stored: DataFrame, key: str) -> DataFrame:
    """Rows (one per key, no nulls) whose key the stored table does not hold. `rows` is read more than once."""
    keys = stored.select(key).filter(F.col(key).isNotNull())
    known = seen_filter(keys, key, keys.count())
    asked = with_maybe(rows, known, key)
    possible = cut_lineage(asked.filter("_maybe").select(key), "possibly-seen")
    hits = cut_lineage(known_keys(keys, possible, key).distinct(), "seen")
    if measure(hits)[1] <= BROADCAST_BYTES:
        hits = F.broadcast(hits)
    return rows.join(hits, key, "left_anti")


def first_unseen(events: DataFrame, order: list[Column], stored: DataFrame, key: str = "id") -> DataFrame:
    """First arrival of each key that the stored table does not hold."""
    fresh = one_per_key(events.filter(F.col(key).isNotNull()), key, order)
    return without_known(cut_lineage(fresh, "fresh"), stored, key)
