"""Fixity audit of archive replicas with Merkle trees over offset ranges.

An archive file is a sequence of records at offsets. A leaf of its tree is a range
of `RANGE_BYTES` bytes and hashes the records that begin there, in order, with their
offsets, lengths and digests; a node hashes its `FANOUT` children in order, with their
ranges. Two replicas are compared from the roots down: only nodes below a mismatch are read at
the next level, and records only in leaf ranges that differ. What is reported
are the records that are changed, missing or extra, with their places.

Trees are built by grouping on (file, range): a group is a bounded range of a file, so a
file that holds a third of all records is spread like any other. Levels are stored.

Defined results: null record bytes count as empty; pages without an id lie in files below zero, dealt by their
content, equal ones one by one; records with equal file and offset are
hashed together in the order of their digests, and a multiset difference of them is
reported record by record; a file in one replica only is missing or extra as a
whole; empty tables give empty results; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedlake.llm.common import cut_lineage

RANGE_BYTES = 1 << 16
FANOUT = 16
# Pages in one archive file.
FILE_PAGES = 1000
# Equal records without an id that one row stands for.
_LOT = 1 << 16
_ENDS = "\r\n\r\n"


def warc_record(url: Column, record_id: Column, body: Column) -> Column:
    """A WARC resource record as text (UTF-8 once written)."""
    body = F.coalesce(body, F.lit(""))
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: resource\r\nWARC-Target-URI: "),
        F.coalesce(url, F.lit("")),
        F.lit("\r\nWARC-Record-ID: <urn:record:"),
        F.coalesce(record_id.cast("string"), F.lit("")),
        F.lit(">\r\nContent-Type: text/html\r\nContent-Length: "),
        F.octet_length(body).cast("string"),
        F.lit(_ENDS),
    )
    return F.concat(head, body, F.lit(_ENDS))


def _nameless(rows: DataFrame, files: int) -> DataFrame:
    """Records without a page id, dealt into files below zero by a hash. Equal ones are counted and dealt one by one, so
    that no file holds all copies of a record."""
    record = ["page_id", "_tie", "length", "digest"]
    counted = rows.groupBy(*record).agg(F.count(F.lit(1)).alias("_n"))
    lots = counted.withColumn("_lot", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1, F.lit(_LOT).cast("long"))))
    lots = lots.repartition("_tie", "_lot")  # the copies of one record are numbered by several tasks
    copies = lots.withColumn("_copy", F.explode(F.sequence("_lot", F.least(F.col("_lot") + _LOT, "_n") - 1)))
    return copies.select(*record, (-1 - F.pmod(F.xxhash64("_tie", "_copy"), F.lit(files))).cast("long").alias("file"))


def archived(
    pages: DataFrame, file_pages: int = FILE_PAGES, stored: Callable[[Column], Column] = lambda record: record
) -> DataFrame:
    """(file, offset, length, digest, page_id): pages as records, one after another, in files of
    `file_pages` consecutive page ids. `stored` is what a store gives back for a record."""
    record = warc_record(F.col("url"), F.col("page_id"), F.col("html"))
    rows = pages.select("page_id", record.alias("_record")).select(
        "page_id",
        F.xxhash64("_record").alias("_tie"),
        F.octet_length("_record").cast("long").alias("length"),
        F.sha2(stored(F.col("_record")), 256).alias("digest"),
    )
    file = F.floor(F.col("page_id") / file_pages).cast("long")
    placed = rows.filter(F.col("page_id").isNotNull()).withColumn("file", file)
    nameless = rows.filter(F.col("page_id").isNull())
    count = nameless.count()
    if count:
        placed = placed.unionByName(_nameless(nameless, -(-count // file_pages)))
    rows = placed
    order = Window.partitionBy("file").orderBy("page_id", "_tie").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.withColumn("offset", F.sum("length").over(order) - F.col("length")).drop("_tie")


def _hash_in_order(parts: list[str], order: list[str]) -> Column:
    """One digest of the rows of a group, in order."""
    rows = F.array_sort(F.collect_list(F.struct(*order, *[p for p in parts if p not in order])))
    text = F.transform(rows, lambda r: F.concat_ws(":", *[r[p].cast("string") for p in parts]))
    return F.sha2(F.array_join(text, "\n"), 256)


def merkle_levels(records: DataFrame, range_bytes: int = RANGE_BYTES, fanout: int = FANOUT) -> list[DataFrame]:
    """Stored levels (file, node, hash) from leaf ranges up to one root per file."""
    leaf = F.floor(F.col("offset") / range_bytes).cast("long")
    leaves = records.withColumn("node", leaf).groupBy("file", "node")
    level = leaves.agg(_hash_in_order(["offset", "length", "digest"], ["offset", "digest", "length"]).alias("hash"))
    levels = [cut_lineage(level, "fixity-leaves")]
    while (levels[-1].agg(F.max("node")).first()[0] or 0) > 0:
        parents = levels[-1].withColumn("parent", F.floor(F.col("node") / fanout).cast("long")).groupBy("file", "parent")
        level = parents.agg(_hash_in_order(["node", "hash"], ["node"]).alias("hash")).withColumnRenamed("parent", "node")
        levels.append(cut_lineage(level, "fixity-nodes"))
    return levels


def _mismatches(left: DataFrame, right: DataFrame) -> DataFrame:
    """(file, node) that are not the same on both sides."""
    both = left.join(right.withColumnRenamed("hash", "other"), ["file", "node"], "full")
    return both.filter(~F.col("hash").eqNullSafe(F.col("other"))).select("file", "node")


def _padded(levels: list[DataFrame], height: int) -> list[DataFrame]:
    return levels + [levels[-1]] * (height - len(levels))


def differing_ranges(left: list[DataFrame], right: list[DataFrame], fanout: int = FANOUT) -> DataFrame:
    """(file, node) of the leaf ranges that differ, found from the roots down."""
    height = max(len(left), len(right))
    left, right = _padded(left, height), _padded(right, height)
    below = cut_lineage(_mismatches(left[-1], right[-1]), "fixity-mismatch")
    for a, b in zip(left[-2::-1], right[-2::-1], strict=True):
        parents = below.select("file", F.col("node").alias("parent"))
        children = [
            level.withColumn("parent", F.floor(F.col("node") / fanout).cast("long")).join(parents, ["file", "parent"], "left_semi").drop("parent")
            for level in (a, b)
        ]
        below = cut_lineage(_mismatches(*children), "fixity-mismatch")
    return below


def audit(master: DataFrame, replica: DataFrame, range_bytes: int = RANGE_BYTES, fanout: int = FANOUT) -> DataFrame:
    """(file, offset, length, page_id, state): records of the master that are `changed` or `missing`
    in the replica, and `extra` ones there. Both: (file, offset, length, digest, page_id), stored."""
    ranges = differing_ranges(merkle_levels(master, range_bytes, fanout), merkle_levels(replica, range_bytes, fanout), fanout)
    fields = ["offset", "length", "digest", "page_id"]

    def suspects(side: DataFrame) -> DataFrame:
        at = side.withColumn("node", F.floor(F.col("offset") / range_bytes).cast("long"))
        at = at.join(ranges, ["file", "node"], "left_semi")
        copies = Window.partitionBy("file", "offset", "digest", "length").orderBy("page_id")
        return at.select("file", *fields, F.row_number().over(copies).alias("copy"))

    ours, theirs = suspects(master), suspects(replica)
    same = ["file", "offset", "digest", "length", "copy"]
    lost, added = ours.join(theirs, same, "left_anti"), theirs.join(ours, same, "left_anti")
    order = Window.partitionBy("file", "offset").orderBy("digest", "length", "copy")
    lost = lost.withColumn("turn", F.row_number().over(order))
    added = added.withColumn("turn", F.row_number().over(order))
    pairs = lost.select("file", "offset", "turn", "length", "page_id", F.lit(True).alias("_ours")).join(
        added.select("file", "offset", "turn", F.col("length").alias("_length"), F.col("page_id").alias("_page"), F.lit(True).alias("_theirs")),
        ["file", "offset", "turn"],
        "full",
    )
    state = F.when(F.col("_ours").isNull(), "extra").when(F.col("_theirs").isNull(), "missing").otherwise("changed")
    return pairs.select(
        "file", "offset", F.coalesce("length", "_length").alias("length"), F.coalesce("page_id", "_page").alias("page_id"), state.alias("state")
    )
