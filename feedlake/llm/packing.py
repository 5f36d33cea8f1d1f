"""Best-fit-decreasing packing of token sequences.

Pieces of one length are interchangeable, so the order of best-fit decreasing
is followed on the histogram of lengths, which has at most `capacity` rows
however many documents there are. A segment tree over the remaining capacities
finds the tightest open sequence for a length in log(capacity) steps; as pieces
of one length come one after another, sequences with the same remaining capacity are
filled alike and handled as a range. The outcome is a table of steps: pieces of
length L with ranks from a on go into sequences from s on, t to a sequence,
beginning at offset o. Every piece then finds its place from its rank among the pieces
of its length. Ranks are counted in two levels, by (length, bucket) and over buckets, so
that a length that holds a third of all pieces is spread over tasks.

Defined results: a null or empty text is a document of the end token alone; rows
with equal ids are packed one by one; empty tables give empty results; other columns
are ignored.
"""

from __future__ import annotations

import math
import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedlake.llm.common import cut_lineage, ids_and_texts, map_rows

CAPACITY = 2048
END_TOKEN = 0
# Pieces of a length and bucket that are ranked in one window partition.
BUCKET_PIECES = 50_000
LEAST_BUCKETS = 32

# Where both encoders are known to split alike; other texts take the slower one.
_LATIN = re.compile(r"[^\x00-ɏ]|<\|")


class Encoder:
    """Token ids of a byte-level BPE vocabulary.

    `ranks_path` may name the same vocabulary as ranks, which are merged several
    times faster; texts beyond Latin letters, or that may hold a special
    token, are left to the tokenizer itself.
    """

    def __init__(self, tokenizer_path: str, ranks_path: str | None = None, pattern: str | None = None):
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(tokenizer_path)
        self.fast = None
        if ranks_path:
            import base64

            import tiktoken

            with open(ranks_path, "rb") as lines:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def __call__(self, text: str) -> np.ndarray:
        if self.fast is not None and not _LATIN.search(text):
            try:
                return np.asarray(self.fast.encode_to_numpy(text, disallowed_special=()), dtype="<u4")
            except ValueError:
                pass  # its pattern gives up on very long runs of white space
        return np.array(self.slow.encode(text, add_special_tokens=False).ids, dtype="<u4")


def cuts(tokens: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document; only the first may be shorter than `capacity`."""
    first = tokens if tokens <= capacity else tokens % capacity or capacity
    return [(0, first), *((start, capacity) for start in range(first, tokens, capacity))]


def token_pieces(
    docs: DataFrame,
    tokenizer_path: str,
    ranks_path: str | None = None,
    pattern: str | None = None,
    capacity: int = CAPACITY,
    end_token: int = END_TOKEN,
    keep_ids: bool = False,
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) of every document."""

    def task():
        encode = Encoder(tokenizer_path, ranks_path, pattern)

        def each(rows):
            out = {name: [] for name in arrow.names}
            for doc, text in zip(rows["doc_id"], rows["text"], strict=True):
                ids = np.append(encode(text), np.array([end_token], "<u4")).astype("<u4")
                for piece, (start, length) in enumerate(cuts(len(ids), capacity)):
                    part = ids[start : start + length]
                    row = (doc, piece, start, length, zlib.crc32(part.tobytes()), part)
                    for name, value in zip(arrow.names, row, strict=False):
                        out[name].append(value)
            return out

        return each

    fields = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    if keep_ids:
        fields.append(("ids", pa.list_(pa.int64())))
        schema += ", ids array<long>"
    arrow = pa.schema(fields)
    return map_rows(ids_and_texts(docs), task, schema, arrow)


class OpenSequences:
    """Ranges of sequences by remaining capacity, under a segment tree that
    knows below each node whether any is open."""

    def __init__(self, capacity: int):
        self.leaves = 1 << (capacity + 1).bit_length()
        self.tree = bytearray(2 * self.leaves)
        self.ranges: dict[int, list[tuple[int, int]]] = {}

    def put(self, remaining: int, first: int, count: int) -> None:
        if remaining <= 0 or count <= 0:
            return
        self.ranges.setdefault(remaining, []).append((first, count))
        node = self.leaves + remaining
        while node and not self.tree[node]:
            self.tree[node] = 1
            node >>= 1

    def take(self, remaining: int) -> tuple[int, int]:
        found = self.ranges[remaining].pop()
        if not self.ranges[remaining]:
            node = self.leaves + remaining
            self.tree[node] = 0
            while node > 1 and not self.tree[node ^ 1]:
                node >>= 1
                self.tree[node] = 0
        return found

    def tightest(self, length: int) -> int | None:
        """The least remaining capacity of an open sequence that holds `length`."""
        node = self.leaves + length
        while not self.tree[node]:
            while node & 1:
                node >>= 1
            if not node:
                return None
            node += 1
        while node < self.leaves:
            node = 2 * node if self.tree[2 * node] else 2 * node + 1
        return node - self.leaves


@dataclass
class Plan:
    """Steps by (length, first rank), and the number of sequences."""

    key: np.ndarray  # length << 40 | first rank
    per_sequence: np.ndarray
    first_sequence: np.ndarray
    offset: np.ndarray
    sequences: int


def best_fit_plan(histogram: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """Best-fit decreasing for counts of pieces by length.

    Every step uses up the pieces of a length or a range of sequences, and a length
    adds three ranges at most; so the number of steps depends on the
    capacity and not on the number of pieces.
    """
    space, sequences, steps = OpenSequences(capacity), 0, []
    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            remaining = space.tightest(length)
            if remaining is None:
                remaining = capacity
                first, count = sequences, -(-left // (capacity // length))
                sequences += count
            else:
                first, count = space.take(remaining)
            each = min(left, remaining // length)
            filled = min(count, left // each)
            steps.append((length << 40 | rank, each, first, capacity - remaining))
            space.put(remaining - each * length, first, filled)
            space.put(remaining, first + filled, count - filled)
            left -= each * filled
            rank += each * filled
    key, per, first, offset = (np.array(column, dtype=np.int64) for column in zip(*sorted(steps), strict=True)) if steps else [np.empty(0, np.int64)] * 4
    return Plan(key, per, first, offset, sequences)


def packed(pieces: DataFrame, capacity: int = CAPACITY, bucket_pieces: int = BUCKET_PIECES) -> DataFrame:
    """The pieces with (sequence_id, offset). `pieces` has unique-enough (doc_id, piece)
    and a `length` of 1 to `capacity`; it is read twice and should be a stored table."""
    counted = {row["length"]: row["count"] for row in pieces.groupBy("length").count().collect()}
    if any(not 1 <= length <= capacity for length in counted):
        raise ValueError("piece lengths must be between 1 and the capacity")
    plan = best_fit_plan(counted, capacity)
    buckets = max(LEAST_BUCKETS, math.ceil(sum(counted.values()) / bucket_pieces))
    dealt = pieces.withColumn("_bucket", F.pmod(F.xxhash64("doc_id", "piece", "start", "ids_crc32"), F.lit(buckets)).cast("int"))
    order = Window.partitionBy("length", "_bucket").orderBy("doc_id", "piece", "start", "ids_crc32")
    before = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = dealt.groupBy("length", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    counts = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    ranked = dealt.withColumn("_in_bucket", F.row_number().over(order) - 1).join(counts, ["length", "_bucket"])
    ranked = ranked.withColumn("_rank", F.col("_before") + F.col("_in_bucket"))
    shared = pieces.sparkSession.sparkContext.broadcast(plan)

    @F.pandas_udf("sequence_id long, offset long")
    def place(length, rank):
        import pandas as pd

        steps = shared.value
        key = length.to_numpy() << 40 | rank.to_numpy()
        step = np.searchsorted(steps.key, key, "right") - 1
        index = key - steps.key[step]
        per = steps.per_sequence[step]
        return pd.DataFrame(
            {
                "sequence_id": steps.first_sequence[step] + index // per,
                "offset": steps.offset[step] + index % per * length.to_numpy(),
            }
        )

    placed = ranked.withColumn("_place", place("length", "_rank"))
    return placed.select(*pieces.columns, "_place.sequence_id", "_place.offset")


def pack_documents(docs: DataFrame, tokenizer_path: str, ranks_path=None, pattern=None, capacity: int = CAPACITY) -> DataFrame:
    """Documents as pieces with their places; texts are tokenized once."""
    pieces = cut_lineage(token_pieces(docs, tokenizer_path, ranks_path, pattern, capacity), "packing-pieces")
    return packed(pieces, capacity)


def sequences(placed: DataFrame) -> DataFrame:
    """(sequence_id, ids): the packed token ids, of pieces made with `keep_ids`.
    A group holds at most `capacity` tokens."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return placed.groupBy("sequence_id").agg(parts.alias("parts")).select("sequence_id", F.flatten("parts.ids").alias("ids"))
