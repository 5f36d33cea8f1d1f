"""SimHash near-duplicates, found through Golay-code keys.

A fingerprint of 64 bits is cut into three segments of 22, 21 and 21 bits. Two
fingerprints that differ in at most two bits agree in one segment at least
(pigeonhole), and in the segment after it they differ in at most two bits. Two
words that close have a common neighbour within one bit of each, so the sets of
(23,12) Golay codewords to which the one-bit balls around them decode have an
index in common: one index for a word within two bits of a codeword, six at most
otherwise. The equal segment together with each such index is a key. Keys are
joined and the pairs verified by their bit distance.

A key shared by many different fingerprints is not turned into pairs. Its
members are joined through their one-bit neighbourhoods instead: two
fingerprints are within two bits if and only if they have a neighbour in
common, so a star per neighbour links the same components with 65 rows per
fingerprint.

Defined results: null text is empty; a text without words has fingerprint zero,
which is linked like any other; rows without `doc_id` are fingerprinted and
linked, but never name a component (`component_id` is null if no row of it has an
id). Repeated rows share fingerprint and component. Other columns are ignored.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlake.llm.common import cut_lineage, ids_and_texts, map_rows
from feedlake.session import BROADCAST_BYTES, measure

SHINGLE_WORDS = 3
MAX_BITS = 2
SEED = 42
SEGMENTS = ((0, 22), (22, 21), (43, 21))  # (first bit, bits)
# Up to here the members of a key are compared in pairs, beyond it through neighbours.
PAIRED_MEMBERS = 8

_GENERATOR = 0b110001110101  # x^11+x^10+x^6+x^5+x^4+x^2+1, of the (23,12) code
_PARITY_BITS = 11
_WORD_BITS = 23


def fingerprint(text: str, size: int = SHINGLE_WORDS) -> int:
    """Majority of the bits of the XXH64 values of all word shingles, unsigned."""
    words = text.encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    last = max(1, len(words) - size + 1)
    stops = ends[size - 1 :] if len(words) >= size else ends[-1:]
    hashes = np.fromiter(
        (digest(joined[a:b], SEED) for a, b in zip(starts[:last].tolist(), stops.tolist(), strict=True)), np.uint64, last
    )
    octets = hashes.astype("<u8").view(np.uint8).reshape(-1, 8)
    seen = np.bincount((octets + _octet_offsets()).ravel(), minlength=2048).reshape(8, 256)
    ones = (seen @ _octet_bits()).ravel()
    return sum(1 << int(bit) for bit in np.flatnonzero(2 * ones > last))


@lru_cache(1)
def _octet_offsets() -> np.ndarray:
    return np.arange(8, dtype=np.int64) * 256


@lru_cache(1)
def _octet_bits() -> np.ndarray:
    return np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def fingerprints(docs: DataFrame, size: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed long, one row per document."""

    def task():
        def each(rows):
            values = np.array([fingerprint(text, size) for text in rows["text"]], dtype=np.uint64)
            return {"doc_id": rows["doc_id"], "fp": values.view(np.int64)}

        return each

    arrow = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])
    return map_rows(ids_and_texts(docs), task, "doc_id long, fp long", arrow)


def remainder(words: np.ndarray) -> np.ndarray:
    """Words of 23 bits modulo the generator polynomial, that is their syndromes."""
    left = words.copy()
    for bit in range(_WORD_BITS - 1, _PARITY_BITS - 1, -1):
        left = np.where(left >> bit & 1, left ^ (_GENERATOR << (bit - _PARITY_BITS)), left)
    return left


@lru_cache(1)
def _errors_by_syndrome() -> np.ndarray:
    """The one error pattern of up to three bits for each of the 2^11 syndromes."""
    single = 1 << np.arange(_WORD_BITS, dtype=np.int64)
    a, b, c = np.meshgrid(single, single, single, indexing="ij")
    patterns = np.unique(np.concatenate([[0], (a | b | c).ravel()]))
    table = np.zeros(1 << _PARITY_BITS, dtype=np.int64)
    table[remainder(patterns)] = patterns
    return table


def decode(words: np.ndarray) -> np.ndarray:
    """Index (message bits) of the codeword nearest to each word of 23 bits."""
    return (words ^ _errors_by_syndrome()[remainder(words)]) >> _PARITY_BITS


def golay_indices(words: np.ndarray, bits: int) -> np.ndarray:
    """Codeword indices of each word and of its neighbours within its `bits`."""
    ball = np.concatenate([[0], 1 << np.arange(bits, dtype=np.int64)])
    return decode(words[:, None] ^ ball[None, :])


def golay_keys(fingerprint_values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key): the distinct keys of each fingerprint."""
    values = fingerprint_values.view(np.uint64)
    parts = [((values >> np.uint64(at)) & np.uint64((1 << bits) - 1)).astype(np.int64) for at, bits in SEGMENTS]
    rows, keys = [], []
    for i in range(len(SEGMENTS)):
        after = (i + 1) % len(SEGMENTS)
        near = np.sort(golay_indices(parts[after], SEGMENTS[after][1]), axis=1)
        fresh = np.concatenate([np.ones((len(near), 1), bool), near[:, 1:] != near[:, :-1]], axis=1)
        row, column = np.nonzero(fresh)
        rows.append(row)
        keys.append((i << 40) | (parts[i][row] << 12) | near[row, column])
    return np.concatenate(rows), np.concatenate(keys)


def _keyed(nodes: DataFrame) -> DataFrame:
    def task():
        def each(rows):
            values = np.array(rows["fp"], dtype=np.int64)
            row, key = golay_keys(values)
            return {"key": key, "fp": values[row]}

        return each

    arrow = pa.schema([("key", pa.int64()), ("fp", pa.int64())])
    return map_rows(nodes.select("fp"), task, "key long, fp long", arrow)


def links(nodes: DataFrame, max_bits: int = MAX_BITS, paired: int = PAIRED_MEMBERS) -> DataFrame:
    """(a, b), a < b: pairs of distinct fingerprints within `max_bits`, as many as
    connect what is connected. `nodes`: distinct values of `fp`."""
    if not 0 <= max_bits <= MAX_BITS:
        raise ValueError(f"the keys tolerate 0 to {MAX_BITS} bits")
    keyed = cut_lineage(_keyed(nodes), "simhash-keys")
    sizes = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    shared = cut_lineage(sizes, "simhash-shared")
    few = keyed.join(shared.filter(F.col("members") <= paired).select("key"), "key")
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits
    pairs = few.withColumnRenamed("fp", "a").join(few.withColumnRenamed("fp", "b"), "key").filter(F.col("a") < F.col("b"))
    pairs = pairs.filter(near).select("a", "b").distinct()
    many = keyed.join(shared.filter(F.col("members") > paired).select("key"), "key", "left_semi").select("fp").distinct()
    if max_bits < 2:  # a common neighbour proves two bits only
        flips = [F.lit(1 << i if i < 63 else -(1 << 63)).cast("long") for i in range(64 if max_bits else 0)]
        found = many.select("fp", F.explode(F.array(F.lit(0).cast("long"), *flips)).alias("flip"))
        other = F.col("fp").bitwiseXOR(F.col("flip"))
        found = found.select(F.col("fp").alias("a"), other.alias("b")).filter("a < b")
        return pairs.unionByName(found.join(many.withColumnRenamed("fp", "b"), "b", "left_semi").select("a", "b"))
    around = many.select("fp", F.explode(_neighbours(F.col("fp"))).alias("common"))
    around = cut_lineage(around, "simhash-neighbours")
    heads = cut_lineage(
        around.groupBy("common").agg(F.min("fp").alias("a"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"),
        "simhash-heads",
    )
    stars = around.join(heads, "common").filter("a < fp").select("a", F.col("fp").alias("b")).distinct()
    return pairs.unionByName(stars)


def _neighbours(value: Column) -> Column:
    flips = [F.lit(1 << i if i < 63 else -(1 << 63)).cast("long") for i in range(64)]
    return F.array(value, *[value.bitwiseXOR(flip) for flip in flips])


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node with an edge, root being the least node reachable.

    Alternating large-star and small-star rounds; each writes its edges, so that
    the plan stays short and a lost executor costs a task.
    """
    current = cut_lineage(edges.select("a", "b"), "components")
    before = None
    while True:
        current = cut_lineage(_small_star(_large_star(current)), "components")
        state = current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            return current.select(F.col("b").alias("node"), F.col("a").alias("root"))
        before = state


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    )
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    moved = both.filter("v > u").join(least, "u")
    return moved.select(F.col("m").alias("a"), F.col("v").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("b").agg(F.min("a").alias("m"))
    moved = edges.join(least, "b").select(F.col("m").alias("x"), F.col("a").alias("y"))
    kept = least.select(F.col("m").alias("x"), F.col("b").alias("y"))
    both = moved.unionByName(kept).filter("x != y")
    return both.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def near_duplicates(docs: DataFrame, size: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, fp, component_id), one row per document."""
    prints = cut_lineage(fingerprints(docs, size), "simhash-prints")
    nodes = cut_lineage(prints.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "simhash-nodes")
    roots = components(links(nodes, max_bits))
    placed = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    placed = cut_lineage(placed.select("fp", "least_id", F.coalesce("root", "fp").alias("root")), "simhash-placed")
    named = cut_lineage(placed.groupBy("root").agg(F.min("least_id").alias("component_id")), "simhash-named")
    of_print = cut_lineage(placed.join(named, "root").select("fp", "component_id"), "simhash-classes")
    return prints.join(of_print, "fp").select("doc_id", "fp", "component_id")


def deduplicated(
    docs: DataFrame, size: int = SHINGLE_WORDS, max_bits: int = MAX_BITS, limit_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """The rows of `docs` with the smallest id of their component, all columns kept.

    What is joined to the texts are the ids that go, which are fewer than those that stay, as a
    rule; up to `limit_bytes` of them are broadcast, and the texts are not shuffled. An id stays if any of its rows has the smallest id of its component; of rows that share an
    id one stays. Rows without an id stay.
    """
    found = near_duplicates(docs, size, max_bits)
    heads = F.max((F.col("doc_id") == F.col("component_id")).cast("int"))
    ids = found.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(heads.alias("_head"), F.count(F.lit(1)).alias("_rows"))
    ids = cut_lineage(ids.withColumnRenamed("doc_id", "_doc"), "simhash-ids")
    gone = cut_lineage(ids.filter("_head = 0").select("_doc"), "simhash-gone")
    if measure(gone)[1] <= limit_bytes:
        gone = F.broadcast(gone)
    kept = docs.join(gone, docs["doc_id"] == gone["_doc"], "left_anti")
    if ids.filter("_head = 1 AND _rows > 1").take(1):
        kept = kept.filter("doc_id IS NOT NULL").dropDuplicates(["doc_id"]).unionByName(kept.filter("doc_id IS NULL"))
    return kept


def hex_digits(value: Column) -> Column:
    return F.lower(F.lpad(F.hex(value), 16, "0"))
