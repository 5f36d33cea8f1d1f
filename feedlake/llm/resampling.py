"""Importance resampling towards a target: hashed n-gram features, scored from an array, drawn by sorted noisy scores.

The words of a text make features, a feature falls into a bucket, and a bucket has a gain: the
logarithm of its share in the target over its share in the corpus. Texts are read once; the bucket numbers
of their features are stored. Totals of buckets are summed in tasks, and the gains, one number
per bucket, go to all tasks as an array that scores a document by plain indexing. With Gumbel noise
from a hash of its id added to its weight, the documents of the highest scores are a draw without replacement.

The draw needs exact ranks, which a radix sort of the composite key (score falling, id rising)
gives, least significant digit first. Rows lie in blocks of equal size, in the order so far. In
each pass the digits of a block are counted; sums of these counts over smaller digits, and over the same digit in
earlier blocks, tell where its rows of a digit begin in the new order; and a stable counting sort
within the block tells the rest. Rows then go to the block of their destination. A block, and so a task, has
the same number of rows whatever the keys are, so a score or an id that all rows share is no hot
group. Every pass is written to the shared folder.

Defined results: a null or empty text has no features and weight zero; rows with equal ids are
scored and ranked one by one, in the order of the stored table; a null id hashes as `null` and comes
after all ids of its score; very long texts are featured whole; empty tables give empty
results, and an empty target counts as zero everywhere; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedlake.llm.common import cut_lineage, ids_and_texts
from feedlake.session import BROADCAST_BYTES, measure

SEED = 2024
BUCKETS = 10_000
LONGEST_RUN = 1
LEAST_WORDS = 20
PERCENT = 10

RADIX_BITS = 11
BLOCK_ROWS = 16_384
# Beyond so many blocks they get larger instead of more.
MOST_BLOCKS = 50_000

# What stays of a text's bytes: ASCII letters in lower case, digits, and all that is not ASCII.
_WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words(text: str) -> list[bytes]:
    return text.encode().translate(_WORD_BYTES).split()


def features(found: list[bytes], longest: int) -> list[bytes]:
    """All runs of 1 to `longest` consecutive words."""
    runs = list(found)
    for size in range(2, longest + 1):
        runs += [b" ".join(found[i : i + size]) for i in range(len(found) - size + 1)]
    return runs


def featured(docs: DataFrame, longest: int = LONGEST_RUN, buckets: int = BUCKETS) -> DataFrame:
    """(doc_id, n_words, n_features, buckets): the bucket of each feature of every document."""
    kind, sql = (pa.int16(), "short") if buckets <= 1 << 15 else (pa.int32(), "int")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, sizes, parts = [], [], []
            for text in batch.column(1):
                found = words(text.as_py())
                runs = features(found, longest)
                n_words.append(len(found))
                sizes.append(len(runs))
                parts.append((np.fromiter(map(zlib.crc32, runs), np.int64, len(runs)) % buckets).astype(kind.to_pandas_dtype()))
            if sizes:
                ends = pa.array(np.cumsum([0, *sizes]), pa.int32())
                lists = pa.ListArray.from_arrays(ends, pa.array(np.concatenate(parts), kind))
                columns = [batch.column(0), pa.array(n_words, pa.int64()), pa.array(sizes, pa.int64()), lists]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "n_features", "buckets"])

    return ids_and_texts(docs).mapInArrow(run, f"doc_id long, n_words long, n_features long, buckets array<{sql}>")


def bucket_totals(rows: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features in each bucket. A task sends one number per bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            total += np.bincount(batch.column(0).flatten().to_numpy(zero_copy_only=False), minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": at.astype(np.int32), "n": total[at]})

    counted = rows.select("buckets").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for bucket, n in counted.collect():  # at most one row per bucket
        out[bucket] = n
    return out


def bucket_gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm of (share in the target / share in the corpus), one added to each count."""
    over, under = float(int(corpus.sum()) + len(corpus)), float(int(target.sum()) + len(target))
    return np.array(
        [math.floor(1000 * math.log((t + 1) * over / ((s + 1) * under))) for s, t in zip(map(float, corpus), map(float, target), strict=True)],
        np.int64,
    )


def noise(doc_id: int | None, seed: int) -> int:
    """Thousandths of a Gumbel-distributed number that belongs to the id."""
    name = "null" if doc_id is None else doc_id
    h = int(hashlib.sha256(f"{seed}:{name}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(rows: DataFrame, gains: np.ndarray, seed: int = SEED) -> DataFrame:
    """The rows with (weight, score) in place of their buckets."""
    kept = [c for c in rows.columns if c != "buckets"]
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != "buckets"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            lists = batch.column("buckets")
            before = np.concatenate([[0], np.cumsum(gains[lists.flatten().to_numpy(zero_copy_only=False)])])
            ends = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))])
            weight = before[ends[1:]] - before[ends[:-1]]
            drawn = np.array([noise(doc, seed) for doc in batch.column("doc_id").to_pylist()], np.int64)
            columns = [batch.column(c) for c in kept]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(weight), pa.array(weight + drawn)], [*kept, "weight", "score"])

    return rows.select(*kept, "buckets").mapInArrow(run, ", ".join([*fields, "weight long", "score long"]))


@dataclass(frozen=True)
class SortKey:
    """A long column without nulls and its range; compared as an unsigned distance from one end."""

    name: str
    low: int
    high: int
    falling: bool = False

    @property
    def bits(self) -> int:
        return (self.high - self.low).bit_length()

    def digits(self, column: pa.Array, shift: int, width: int) -> np.ndarray:
        value = column.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
        end = np.array([self.high if self.falling else self.low], np.int64).view(np.uint64)
        distance = end - value if self.falling else value - end
        return ((distance >> np.uint64(shift)) & np.uint64((1 << width) - 1)).astype(np.uint16)


def _digit_counts(state: DataFrame, key: SortKey, shift: int, width: int) -> DataFrame:
    """(_block, digit, n)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            block = batch.column(0).to_numpy(zero_copy_only=False)
            both = np.rec.fromarrays([block, key.digits(batch.column(1), shift, width)])
            found, n = np.unique(both, return_counts=True)
            yield pa.RecordBatch.from_pydict({"_block": found["f0"], "digit": found["f1"].astype(np.int32), "n": n})

    tasks = state.select("_block", key.name).mapInArrow(run, "_block long, digit int, n long")
    return tasks.groupBy("_block", "digit").agg(F.sum("n").alias("n"))


def _pass(state: DataFrame, key: SortKey, shift: int, width: int, block_rows: int) -> DataFrame:
    """Rows in the stable order of one digit, put into new blocks."""
    counts = cut_lineage(_digit_counts(state, key, shift, width), "radix-counts")
    totals = np.zeros(1 << width, np.int64)
    for digit, n in counts.groupBy("digit").agg(F.sum("n")).collect():  # at most one row per digit
        totals[digit] = n
    smaller = np.cumsum(totals) - totals
    earlier = Window.partitionBy("digit").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_block", "digit", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    names = [f.name for f in state.schema.fields]

    def place(rows: pa.Table, begins: pa.Table) -> pa.Table:
        begin = smaller.copy()
        begin[begins["digit"].to_numpy()] += begins["before"].to_numpy()
        rows = rows.combine_chunks().take(pa.array(np.argsort(rows["_at"].to_numpy())))
        digits = key.digits(rows[key.name], shift, width)
        order = np.argsort(digits, kind="stable")  # a counting sort for 16 bits
        digits = digits[order]
        destination = begin[digits] + np.arange(len(digits)) - np.searchsorted(digits, digits)
        rows = rows.take(pa.array(order))
        new = {"_block": pa.array(destination // block_rows), "_at": pa.array(destination % block_rows)}
        return pa.table({name: new.get(name, rows[name]) for name in names})

    both = state.groupBy("_block").cogroup(offsets.groupBy("_block"))
    return cut_lineage(both.applyInArrow(place, state.schema), "radix-pass")


def radix_ranked(
    rows: DataFrame, keys: list[SortKey], n_rows: int, radix_bits: int = RADIX_BITS, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """(_row, rank): the rank from 1 of every row in the order of `keys`, the most significant first.

    `_row` is a unique long, as `monotonically_increasing_id` gives them; equal keys keep its order. `rows`
    should be a stored table.
    """
    block_rows = max(block_rows, -(-n_rows // MOST_BLOCKS))
    # The number of the writing task stands above the first 33 bits.
    task, place = F.shiftright("_row", 33), F.col("_row").bitwiseAND((1 << 33) - 1)
    block = F.shiftleft(task, 33).bitwiseOR(F.floor(place / block_rows))
    state = rows.select(block.alias("_block"), (place % block_rows).alias("_at"), "_row", *[key.name for key in keys])
    steps = [(key, shift, min(radix_bits, key.bits - shift)) for key in reversed(keys) for shift in range(0, key.bits, radix_bits)]
    for key, shift, width in steps or [(keys[-1], 0, 1)]:
        state = _pass(state, key, shift, width, block_rows)
    return state.select("_row", (F.col("_block") * block_rows + F.col("_at") + 1).alias("rank"))


def resampled(
    docs: DataFrame,
    target: DataFrame,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    longest: int = LONGEST_RUN,
    buckets: int = BUCKETS,
    seed: int = SEED,
    radix_bits: int = RADIX_BITS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every document; rank is null for those not drawn.

    Of the documents with at least `least_words` words, `percent` hundredths (rounded down) are drawn towards
    `target(text)`.
    """
    rows = cut_lineage(featured(docs, longest, buckets).withColumn("_row", F.monotonically_increasing_id()), "resampling-features")
    asked = featured(target.select(F.lit(None).cast("long").alias("doc_id"), "text"), longest, buckets)
    gains = bucket_gains(bucket_totals(rows, buckets), bucket_totals(asked, buckets))
    rows = cut_lineage(scored(rows, gains, seed), "resampling-scores")

    long_enough = rows.filter(F.col("n_words") >= least_words)
    keyed = long_enough.select(
        "_row", "score", F.col("doc_id").isNull().cast("long").alias("_none"), F.coalesce("doc_id", F.lit(0)).alias("_id")
    )
    names = ("score", "_none", "_id")
    ends = [end(name).alias(f"{end.__name__}{name}") for name in names for end in (F.min, F.max)]
    seen = keyed.agg(F.count(F.lit(1)).alias("n"), *ends).first()
    drawn = percent * seen["n"] // 100
    rank = F.lit(None).cast("long").alias("rank")
    if not drawn:
        return rows.select("doc_id", "n_features", "weight", "score", rank)
    keys = [SortKey(name, seen[f"min{name}"], seen[f"max{name}"], name == "score") for name in names]
    ranked = radix_ranked(keyed, keys, seen["n"], radix_bits, block_rows).filter(F.col("rank") <= drawn)
    if measure(ranked)[1] <= BROADCAST_BYTES:
        ranked = F.broadcast(ranked)
    return rows.join(ranked, "_row", "left").select("doc_id", "n_features", "weight", "score", "rank")
