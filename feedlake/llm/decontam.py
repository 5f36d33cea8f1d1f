"""Benchmark decontamination with spaced seeds.

A seed is a mask over token positions; positions with 0 are ignored, so that a
substituted token there does not spoil the hash. Every window of every benchmark
item is hashed under every mask, the windows of all documents are probed against
these hashes, and around each hit the item and the document are compared token by
token without gaps: all tokens that lie side by side, or else any stretch of them, are an
overlap if they are enough and enough of them are equal. Of several stretches the one with
the most equal tokens is given.

The benchmark side is what is broadcast. It is measured first and dealt into
slices of a bounded number of tokens; documents are scanned once per slice and
never shuffled, so hot sources and copies need no care.

Tokens are runs of letters and digits in lower case, and in scripts without spaces
(Chinese, Japanese, Thai and the like) each letter.

Defined results: null or empty texts overlap nothing; items with fewer than
`min_tokens` tokens are matched only as a whole, and items below `least_tokens` tokens
only as a whole with all tokens equal; an item of a single token, which is no passage, overlaps documents of
that token alone; equal items give one row each; repeated
document rows give one row each; empty tables give empty results. Columns other
than the id and the text are passed through by `clean` and ignored otherwise.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake.llm.common import cut_lineage, ids_and_texts, map_rows

# Found by search: whichever two of 13 tokens are substituted, or three of 16, some window of some
# mask keeps none of them.
MASKS = ("11000101011", "1110111", "10100100111")
MIN_TOKENS = 13
LEAST_TOKENS = 8
MIN_EQUAL = 0.8
# Long items are cut into pieces that share this many tokens with the next.
PIECE_TOKENS, PIECE_OVERLAP = 4096, 64
# Benchmark tokens in one broadcast: 24 bytes each per mask, 36 MB in all.
SLICE_TOKENS = 500_000
# Distinct words whose hash a task remembers.
WORD_CACHE = 200_000

# Kana, ideographs with their extensions, Thai to Myanmar, Khmer.
_SPACELESS = (
    "\u3041-\u3096\u309d-\u309f\u30a1-\u30fa\u30fc-\u30ff\u31f0-\u31ff\uff66-\uff9f\u3005-\u3007\u3400-\u4dbf\u4e00-\u9fff"
    "\uf900-\ufaff\U00020000-\U0003ffff\u0e00-\u0fff\u1000-\u109f\u1780-\u17ff"
)
_TOKEN = re.compile(rf"[^\W_{_SPACELESS}]+|(?!_)[{_SPACELESS}](?<=\w)")
_ASCII_TOKEN = re.compile(r"[^\W_]+")
_FACTORS = np.array([pow(0x9E3779B97F4A7C15, k + 1, 1 << 64) for k in range(64)], dtype=np.uint64)


class Words(dict):
    """Word -> 64-bit hash, remembered up to a bound."""

    def __missing__(self, word: str) -> int:
        if len(self) >= WORD_CACHE:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word.encode("utf-8", "replace"))
        return value

    def hashes(self, text: str) -> np.ndarray:
        found = (_ASCII_TOKEN if text.isascii() else _TOKEN).findall(text.lower())
        return np.fromiter(map(self.__getitem__, found), np.uint64, len(found))


def seeded(tokens: np.ndarray, mask: str) -> np.ndarray:
    """Hash of each window, over the positions that the mask keeps."""
    windows = len(tokens) - len(mask) + 1
    if windows <= 0:
        return np.empty(0, np.uint64)
    total = np.full(windows, len(mask), np.uint64)
    for k, kept in enumerate(mask):
        if kept == "1":
            total += tokens[k : k + windows] * _FACTORS[k]
    total ^= total >> np.uint64(29)
    return total * np.uint64(0xBF58476D1CE4E5B9)


@dataclass
class Index:
    """One slice of the benchmark, as broadcast."""

    items: list  # item ids, by piece
    pieces: list  # token hashes, by piece
    masks: list  # (mask, sorted hashes, piece of each, position of each, bitmap by the top 20 bits)
    min_tokens: int
    least_tokens: int
    min_equal: float


def build_index(rows: list, masks: tuple, min_tokens: int, min_equal: float, least_tokens: int = LEAST_TOKENS) -> Index:
    pieces = [np.array(row["tokens"], dtype=np.int64).view(np.uint64) for row in rows]
    longest = max(len(mask) for mask in masks)
    short = {"1" * len(p) for p in pieces if len(p) < longest}
    built = []
    for mask in [*masks, *sorted(short - set(masks))]:
        whole = mask in short and mask not in masks  # this mask stands for items of just this length
        at = [i for i, p in enumerate(pieces) if (len(p) == len(mask) if whole else len(p) >= len(mask))]
        if not at:
            continue
        values = [seeded(pieces[i], mask) for i in at]
        hashes = np.concatenate(values)
        owner = np.concatenate([np.full(len(v), i, np.int64) for i, v in zip(at, values, strict=True)])
        place = np.concatenate([np.arange(len(v)) for v in values])
        order = np.argsort(hashes, kind="stable")
        bitmap = np.zeros(1 << 20, bool)
        bitmap[hashes >> np.uint64(44)] = True
        built.append((mask, hashes[order], owner[order], place[order], bitmap))
    return Index([row["item_id"] for row in rows], pieces, built, min_tokens, least_tokens, min_equal)


def best_stretch(equal: np.ndarray, least: int, share: float) -> tuple[int, int]:
    """[from, to) of the stretch of `least` tokens or more that holds the most equal ones, of all whose
    share of equal tokens is enough, cut to the tokens it needs; the first one of equals, (0, 0) if there is none."""
    part = Fraction(share).limit_denominator(1000)
    same = np.concatenate([[0], np.cumsum(equal)])
    # A stretch has the share if its sum of these scores is not below 0. For each start the last such
    # stop is the best one: it is where the largest sum from there on falls below that of the start.
    sums = part.denominator * same - part.numerator * np.arange(len(same))
    later = np.maximum.accumulate(sums[::-1])[::-1]
    stops = np.searchsorted(-later, -sums, "right") - 1
    gains = np.where(stops - np.arange(len(same)) >= least, same[stops] - same, -1)
    start = int(np.argmax(gains))
    if gains[start] < 0:
        return 0, 0
    stop = max(int(np.searchsorted(same, same[stops[start]])), start + least)
    return min(int(np.searchsorted(same, same[start], "right")) - 1, stop - least), stop


def best_overlap(equal: np.ndarray, least: int, share: float) -> tuple[int, int]:
    """[from, to) of all tokens that lie side by side, or else of their best stretch, if it is
    long and equal enough; (0, 0) if neither is."""
    least, same = max(1, least), int(np.count_nonzero(equal))
    if len(equal) < least or same < share * least:
        return 0, 0
    return (0, len(equal)) if same >= share * len(equal) else best_stretch(equal, least, share)


def overlaps(index: Index, tokens: np.ndarray) -> dict:
    """item id -> (equal tokens, tokens, position in the document, in the piece) of its best overlap."""
    found: dict = {}
    tried, whole = set(), set()
    for mask, hashes, owner, place, bitmap in index.masks:
        if len(mask) == 1 and len(tokens) > 1:
            continue
        probes = seeded(tokens, mask)
        if not len(probes):
            continue
        hits = np.flatnonzero(bitmap[probes >> np.uint64(44)])
        first = np.searchsorted(hashes, probes[hits], "left")
        last = np.searchsorted(hashes, probes[hits], "right")
        for position, a, b in zip(hits[last > first].tolist(), first[last > first], last[last > first], strict=True):
            for k in range(a, b):
                piece = int(owner[k])
                diagonal = position - int(place[k])
                if (piece, diagonal) in tried:
                    continue
                tried.add((piece, diagonal))
                item = index.pieces[piece]
                if piece in whole:
                    continue
                low, high = max(0, diagonal), min(len(tokens), diagonal + len(item))
                equal = tokens[low:high] == item[low - diagonal : high - diagonal]
                share = index.min_equal if len(item) >= index.least_tokens else 1
                start, stop = best_overlap(equal, min(index.min_tokens, len(item)), share)
                if stop:
                    if share == 1:  # its first place is the best, and a short item may have many
                        whole.add(piece)
                    entry = (int(equal[start:stop].sum()), stop - start, -(low + start), low + start - diagonal)
                    name = index.items[piece]
                    if name not in found or entry > found[name]:
                        found[name] = entry
    return {name: (same, size, -negative, at) for name, (same, size, negative, at) in found.items()}


def _benchmark_pieces(benchmark: DataFrame) -> DataFrame:
    def task():
        words = Words()

        def each(rows):
            out = {"item_id": [], "n": [], "tokens": []}
            for item, text in zip(rows["item_id"], rows["text"], strict=True):
                tokens = words.hashes(text).view(np.int64)
                if not len(tokens):
                    continue
                for at in range(0, max(1, len(tokens) - PIECE_OVERLAP), PIECE_TOKENS - PIECE_OVERLAP):
                    piece = tokens[at : at + PIECE_TOKENS]
                    out["item_id"].append(item)
                    out["n"].append(len(piece))
                    out["tokens"].append(piece)
            return out

        return each

    arrow = pa.schema([("item_id", pa.int64()), ("n", pa.int64()), ("tokens", pa.list_(pa.int64()))])
    texts = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    return map_rows(texts, task, "item_id long, n long, tokens array<long>", arrow)


def indexes(benchmark: DataFrame, masks=MASKS, min_tokens=MIN_TOKENS, least_tokens=LEAST_TOKENS,
            min_equal=MIN_EQUAL, slice_tokens=SLICE_TOKENS) -> list:
    """The benchmark as broadcast slices, each of about `slice_tokens` tokens."""
    spark = benchmark.sparkSession
    pieces = cut_lineage(_benchmark_pieces(benchmark), "decontam-benchmark")
    total = pieces.agg(F.sum("n")).first()[0] or 0
    slices = max(1, math.ceil(total / slice_tokens))
    dealt = pieces.withColumn("slice", F.pmod(F.xxhash64("item_id", "tokens"), F.lit(slices)))
    found = []
    for k in range(slices if total else 0):
        rows = dealt.filter(F.col("slice") == k).select("item_id", "tokens").collect()
        if rows:
            found.append(spark.sparkContext.broadcast(build_index(rows, masks, min_tokens, min_equal, least_tokens)))
    return found


RESULT = "doc_id long, item_id long, equal_tokens long, overlap_tokens long, doc_token long, item_token long"


def contaminated(docs: DataFrame, benchmark: DataFrame, **settings) -> DataFrame:
    """One row per document row and item that overlap, with the best overlap."""
    fields = [part.split()[0] for part in RESULT.split(", ")]
    arrow = pa.schema([(name, pa.int64()) for name in fields])
    frames = []
    for shared in indexes(benchmark, **settings):

        def task(shared=shared):
            index, words = shared.value, Words()

            def each(rows):
                out = {name: [] for name in fields}
                for doc, text in zip(rows["doc_id"], rows["text"], strict=True):
                    for item, values in overlaps(index, words.hashes(text)).items():
                        for name, value in zip(fields, (doc, item, *values), strict=True):
                            out[name].append(value)
                return out

            return each

        frames.append(map_rows(ids_and_texts(docs), task, RESULT, arrow))
    if not frames:
        return docs.sparkSession.createDataFrame([], RESULT)
    whole = frames[0]
    for frame in frames[1:]:
        whole = whole.unionByName(frame)
    if len(frames) == 1:
        return whole
    # Pieces of one long item may lie in several slices.
    best = F.max_by(F.struct(*fields[2:]), F.struct("equal_tokens", "overlap_tokens"))
    return whole.groupBy("doc_id", "item_id").agg(best.alias("best")).select("doc_id", "item_id", "best.*")


def clean(docs: DataFrame, benchmark: DataFrame, **settings) -> DataFrame:
    """The rows of `docs` whose text overlaps no item, all columns kept."""
    for shared in indexes(benchmark, **settings):
        docs = docs.filter(_untouched(shared)(F.coalesce(docs["text"], F.lit(""))))
    return docs


def _untouched(shared):
    def each(texts: pd.Series) -> pd.Series:
        words = Words()
        return pd.Series([not overlaps(shared.value, words.hashes(text)) for text in texts], dtype=bool)

    return F.pandas_udf(each, "boolean")
