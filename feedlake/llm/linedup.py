"""Removal of repeated line runs, by a suffix array over sequences of line ids.

The corpus is read as sequences of line ids: the lines with a word, in the order of
(doc_id, text hash, line), cut at lines that occur once in the corpus. Distributed prefix
doubling ranks the suffixes that begin at each line: ranks by their first 2^k lines are
the order of pairs of ranks by 2^(k-1) lines, here and 2^(k-1) lines further on, found by a
range-partitioned sort of the different pairs. Suffixes of one rank are an interval of the
suffix array with a longest common prefix of at least 2^k lines; a suffix that is alone in
its interval repeats nothing that long and is ranked no further. A run of any
length l lies in the common prefix of others if both ranks by 2^k lines, 2^k <= l < 2^(k+1),
that cover it are theirs too.

A line goes if it lies in a run of at least `MIN_WORDS` words that also begins at an earlier
place. It is enough to look at the shortest such run from each line on and up to each
line: their union is that of all maximal repeated runs. These runs hold at most
`MIN_WORDS` lines, which bounds the doubling to six levels whatever the data. The
earliest place of each run comes from a pre-aggregated minimum; no pairs of places are made, and
a line or run with a third of all places leaves each task as one row. Ranks are joined to
places by plain joins of stored tables, which Spark splits where a rank is hot.

Built-in expressions only. Defined results: null texts are left as they are; blank lines
are not compared, and go when they lie between lines that go; rows with equal id and
text are one place, so both are treated alike; a document that loses all its words
is left with an empty text; rows without an id come first in the order; other columns
are passed through. Line ids are two 64-bit hashes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedlake.llm.common import cut_lineage
from feedlake.session import BROADCAST_BYTES, measure

MIN_WORDS = 50
WORD = "[^ \\t-\\r]+"
_SALT = 0x5EED
_PLACE = ("_id", "_text", "_from")


def _text_key(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def line_table(docs: DataFrame) -> DataFrame:
    """(_id, _text, _seq, _pos, _a, _b, _words): the lines with a word, numbered."""
    line = lambda x, i: F.struct(
        i.alias("_pos"), F.xxhash64(x).alias("_a"), F.xxhash64(F.lit(_SALT), x).alias("_b"), F.regexp_count(x, F.lit(WORD)).alias("_words")
    )
    lines = F.filter(F.transform(F.split("text", "\n", -1), line), lambda x: x["_words"] > 0)
    keyed = docs.filter("text IS NOT NULL").select(F.col("doc_id").cast("long").alias("_id"), _text_key(F.col("text")).alias("_text"), "text")
    return keyed.select("_id", "_text", F.posexplode(lines).alias("_seq", "_line")).select("_id", "_text", "_seq", "_line.*").distinct()


def levels(min_words: int) -> int:
    return max(1, min_words).bit_length()


def ranked(keys: DataFrame, order: list[str], name: str) -> DataFrame:
    """Different keys with their dense rank, from 1.

    The sort is dealt into ranges; within one the place is counted, and the
    ranges, as many as the sort has partitions, are offset by the sizes of those before.
    """
    sorted_keys = keys.repartitionByRange(*order).withColumn("_range", F.spark_partition_id())
    sorted_keys = cut_lineage(sorted_keys, "linedup-sorted")
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sorted_keys.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    starts = sizes.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    within = Window.partitionBy("_range").orderBy(*order)
    placed = sorted_keys.withColumn("_place", F.row_number().over(within)).join(F.broadcast(starts), "_range")
    return placed.select(*order, (F.col("_start") + F.col("_place")).alias(name))


def suffix_ranks(lines: DataFrame, count: int) -> DataFrame:
    """The repeated lines with `_part`, their sequence within the document, and `_r0`, `_r1`, …:
    the rank of the suffix that begins there by its first 1, 2, 4, … lines, null where no other
    suffix shares them."""
    repeated = lines.groupBy("_a", "_b").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").drop("_n")
    ids = cut_lineage(ranked(repeated, ["_a", "_b"], "_r0"), "linedup-ids")
    document = Window.partitionBy("_id", "_text").orderBy("_seq")
    places = lines.join(ids, ["_a", "_b"]).drop("_a", "_b")
    places = cut_lineage(places.withColumn("_part", F.col("_seq") - F.row_number().over(document)), "linedup-suffixes")
    along = Window.partitionBy("_id", "_text", "_part").orderBy("_seq")
    # Stands for no rank, and for a different one at each place, so that such rows spread over the tasks.
    none = -1 - F.pmod(F.xxhash64("_id", "_text", "_seq"), F.lit(1 << 62))
    for k in range(1, count):
        further = F.lead(f"_r{k - 1}", 1 << (k - 1)).over(along)
        halves = places.withColumns({"_left": F.col(f"_r{k - 1}"), "_right": further})
        whole = F.col("_left").isNotNull() & F.col("_right").isNotNull()
        halves = halves.withColumns({c: F.when(whole, F.col(c)).otherwise(none) for c in ("_left", "_right")})
        halves = cut_lineage(halves, "linedup-pairs")
        pairs = halves.filter("_left > 0").groupBy("_left", "_right").agg(F.count(F.lit(1)).alias("_n"))
        names = cut_lineage(ranked(pairs.filter("_n > 1").drop("_n"), ["_left", "_right"], f"_r{k}"), "linedup-ranks")
        places = halves.join(names, ["_left", "_right"], "left").drop("_left", "_right")
    return places


def runs(lines: DataFrame, min_words: int) -> DataFrame:
    """(_id, _text, _from, _to, _first, _last, _length, _left, _right): the shortest runs with `min_words` words, from each
    line on and up to each line, that lie in a common prefix, and the two ranks that cover them."""
    count = levels(min_words)
    part = Window.partitionBy("_id", "_text", "_part")
    suffixes = suffix_ranks(lines, count).withColumn("_after", F.sum("_words").over(part.orderBy("_seq")))
    suffixes = suffixes.withColumn("_before", F.col("_after") - F.col("_words"))
    onward = part.orderBy("_before").rangeBetween(Window.currentRow, min_words - 1)
    upto = part.orderBy("_after").rangeBetween(-(min_words - 1), Window.currentRow)
    enough = lambda frame: F.when(F.sum("_words").over(frame) >= min_words, F.count(F.lit(1)).over(frame).cast("int"))
    suffixes = suffixes.withColumns({"_onward": enough(onward), "_upto": enough(upto)})
    row = F.struct("_seq", "_pos", "_onward", "_upto", F.array(*[f"_r{k}" for k in range(count)]).alias("ranks"))
    parts = suffixes.groupBy("_id", "_text", "_part").agg(F.array_sort(F.collect_list(row)).alias("_rows"))

    def covered(first: Column, length: Column) -> Column:
        level = F.length(F.bin(length)) - 1
        second = first + length - F.call_function("shiftleft", F.lit(1), level)
        return F.struct(
            F.get("_rows", first)["_pos"].alias("_from"),
            F.get("_rows", first + length - 1)["_pos"].alias("_to"),
            F.get("_rows", first)["_seq"].alias("_first"),
            F.get("_rows", first + length - 1)["_seq"].alias("_last"),
            length.alias("_length"),
            F.get(F.get("_rows", first)["ranks"], level).alias("_left"),
            F.get(F.get("_rows", second)["ranks"], level).alias("_right"),
        )

    def both(x: Column, i: Column) -> Column:
        forward = F.when(x["_onward"].isNotNull(), covered(i, x["_onward"]))
        backward = F.when(x["_upto"].isNotNull(), covered(i - x["_upto"] + 1, x["_upto"]))
        return F.array(forward, backward)

    shared = lambda x: x["_left"].isNotNull() & x["_right"].isNotNull()
    found = F.filter(F.flatten(F.transform("_rows", both)), shared)
    return parts.select("_id", "_text", F.explode(found).alias("_run")).select("_id", "_text", "_run.*").distinct()


def later_copies(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(_id, _text, _from, _to): the stretches of lines to delete, none of which touch."""
    lines = cut_lineage(line_table(docs), "linedup-lines")
    named = cut_lineage(runs(lines, min_words), "linedup-runs")
    place = F.struct(*_PLACE)
    run = ["_length", "_left", "_right"]
    earliest = named.groupBy(*run).agg(F.min(place).alias("_place"), F.count(F.lit(1)).alias("_n")).filter("_n > 1").drop("_n")
    earliest = cut_lineage(earliest, "linedup-earliest")
    later = named.join(earliest, run).filter(place > F.col("_place")).select("_id", "_text", "_from", "_to", "_first", "_last")
    # Runs that touch, blank lines aside, are one stretch.
    order = Window.partitionBy("_id", "_text").orderBy("_first", "_last")
    reached = F.max("_last").over(order.rowsBetween(Window.unboundedPreceding, -1))
    islands = later.withColumn("_new", F.coalesce((F.col("_first") > reached + 1).cast("int"), F.lit(1)))
    islands = islands.withColumn("_island", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return islands.groupBy("_id", "_text", "_island").agg(F.min("_from").alias("_from"), F.max("_to").alias("_to")).drop("_island")


def _with_cuts(docs: DataFrame, min_words: int, limit_bytes: int) -> tuple[DataFrame, Column, Column]:
    """(`docs` joined with its cuts, the text that remains, the cuts). The cuts are measured: up to a limit they go to the
    texts, which are not shuffled then."""
    stretches = later_copies(docs, min_words)
    cuts = stretches.groupBy("_id", "_text").agg(F.array_sort(F.collect_list(F.struct("_from", "_to"))).alias("_cuts"))
    cuts = cut_lineage(cuts, "linedup-cuts")
    same = docs["doc_id"].cast("long").eqNullSafe(cuts["_id"]) & (_text_key(docs["text"]) == cuts["_text"])
    found = cuts["_cuts"]
    inside = lambda i: F.exists(found, lambda c: i.between(c["_from"], c["_to"]))
    rest = F.array_join(F.filter(F.split(docs["text"], "\n", -1), lambda x, i: ~inside(i)), "\n")
    text = F.when(found.isNull() | docs["text"].isNull(), docs["text"]).otherwise(rest)
    cuts = F.broadcast(cuts) if measure(cuts)[1] <= limit_bytes else cuts.hint("shuffle_hash")
    return docs.join(cuts, same, "left"), text, found


def without_copies(docs: DataFrame, min_words: int = MIN_WORDS, limit_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """`docs` with the text that remains, and last `_cuts`: the deleted stretches of lines (null if none)."""
    joined, text, cuts = _with_cuts(docs, min_words, limit_bytes)
    columns = [text.alias("text") if name == "text" else docs[name] for name in docs.columns]
    return joined.select(*columns, cuts.alias("_cuts"))


def deduplicated(docs: DataFrame, min_words: int = MIN_WORDS, limit_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """`docs` without later copies of line runs; documents that lost all their words go.
    `n_chars`, where there is one, is counted anew."""
    joined, text, cuts = _with_cuts(docs, min_words, limit_bytes)
    columns = {name: docs[name] for name in docs.columns} | {"text": text}
    if "n_chars" in columns:
        counted = F.length(text).cast(docs.schema["n_chars"].dataType)
        columns["n_chars"] = F.when(cuts.isNotNull(), counted).otherwise(docs["n_chars"])
    emptied = cuts.isNotNull() & ~text.rlike(WORD)
    return joined.filter(~emptied).select(*[column.alias(name) for name, column in columns.items()])
