"""Partitioned parquet tables: creation, batch-wise writes, replacement.

A keyed table is stored as one folder per batch,

    <root>/log/batch_id=<n>/<partition>=<value>/…

so that writing a batch again replaces exactly its own rows, and, after a
compaction, as a snapshot of all batches up to one,

    <root>/snapshot/upto=<n>/<partition>=<value>/…

Beside the rows of a batch lie its keys, dealt into hash buckets whose number is measured, and those of
its keys that an earlier batch holds too:

    <root>/keys/batch_id=<n>/of=<number of buckets>/bucket=<b>/…
    <root>/again/batch_id=<n>/…

A writer looks for its keys in their buckets only, and a reader learns from the
second, small table which stored rows are superseded, without looking at the
keys of all rows.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from feedlake.operators.joins import known_keys
from feedlake.session import BROADCAST_BYTES, list_names, measure, path_exists

# Keys of a batch are dealt into buckets of about this many.
KEYS_PER_BUCKET = 50_000
MOST_BUCKETS = 1 << 16

Finish = Callable[[DataFrame], DataFrame]


def create_database(spark: SparkSession, name: str, path: str | None = None) -> None:
    place = f" LOCATION '{path}'" if path else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{place}")


def create_table(spark: SparkSession, name: str, schema: StructType, partition_by: list[str], path: str) -> bool:
    """Create an external table unless it exists; tells whether it did."""
    if spark.catalog.tableExists(name):
        return False
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    parts = ", ".join(f"`{c}`" for c in partition_by)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet PARTITIONED BY ({parts}) LOCATION '{path}'")
    return True


def balanced(df: DataFrame, partition_by: str) -> DataFrame:
    """Bring rows of a partition value together before a write.

    The rebalance hint lets AQE split a value that holds much of the data and
    join small ones, so neither one huge task nor many tiny files result.
    """
    return df.hint("rebalance", F.col(partition_by))


def _write(
    df: DataFrame, path: str, partition_by: str | None, sort_by: str | None = None, mode: str = "overwrite",
    finish: Finish | None = None,
) -> None:
    """`finish` makes of the rows what is written, when they have been dealt and sorted."""
    if partition_by:
        df = balanced(df, partition_by)
        if sort_by:
            df = df.sortWithinPartitions(partition_by, sort_by)
    df = finish(df) if finish else df
    if partition_by:
        df.write.mode(mode).partitionBy(partition_by).parquet(path)
    else:
        df.write.mode(mode).parquet(path)


def write_batch(
    df: DataFrame, root: str, batch_id: int, partition_by: str | None = None, sort_by: str | None = None, replace: bool = True,
    finish: Finish | None = None,
) -> None:
    """Store the rows of a batch; without `replace` a number that is taken fails."""
    _write(df, f"{root}/log/batch_id={batch_id}", partition_by, sort_by, "overwrite" if replace else "errorifexists", finish)


def bucket_of(key: Column | str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def bucket_count(keys: int) -> int:
    """A power of two, so that batches of like size have the same number."""
    wanted = 1
    while wanted < MOST_BUCKETS and wanted * KEYS_PER_BUCKET < keys:
        wanted *= 2
    return wanted


def _read_keys(spark: SparkSession, root: str, schema: StructType, key: str, wanted: list[int]) -> dict[int, DataFrame]:
    """(key, bucket) of the keys of some batches, by the number of buckets that they are dealt into."""
    path = f"{root}/keys"
    wide = StructType([schema[key], StructField("bucket", IntegerType())])
    folders: dict[int, list[str]] = {}
    for n in wanted:
        batch = f"{path}/batch_id={n}"
        if path_exists(spark, f"{batch}/_SUCCESS"):
            for of in _folder_numbers(spark, batch, "of"):
                folders.setdefault(of, []).append(f"{batch}/of={of}")
    read = spark.read.schema(wide).option("basePath", path)
    return {of: read.parquet(*found).select(*wide.fieldNames()) for of, found in folders.items()}


def stored_keys(
    fresh: DataFrame, root: str, schema: StructType, key: str, before: int | None = None, without: int | None = None
) -> DataFrame:
    """Those of the (unique) keys of `fresh` that other batches hold: of batches below
    `before`, or of all but `without`. Only the buckets that occur in `fresh` are read."""
    spark = fresh.sparkSession
    numbers = _folder_numbers(spark, f"{root}/keys", "batch_id")
    wanted = [n for n in numbers if (before is None or n < before) and n != without]
    found = []
    for of, stored in _read_keys(spark, root, schema, key, wanted).items():
        if of > 1:
            touched = [row[0] for row in fresh.select(bucket_of(key, of)).distinct().collect()]  # at most one per bucket
            stored = stored.filter(F.col("bucket").isin(touched))
        found.append(stored.select(key))
    if not found:
        return spark.createDataFrame([], StructType([schema[key]]))
    return known_keys(reduce(DataFrame.unionByName, found), fresh.select(key), key).distinct()


def write_keys(fresh: DataFrame, root: str, batch_id: int, key: str) -> int:
    """Store the keys of a batch; returns their number."""
    path, count = f"{root}/keys/batch_id={batch_id}", fresh.count()
    of = bucket_count(count)
    keys = fresh.select(key, F.lit(of).alias("of"), bucket_of(key, of).alias("bucket"))
    balanced(keys, "bucket").sortWithinPartitions("bucket", key).write.mode("overwrite").partitionBy("of", "bucket").parquet(path)
    return count


def write_keyed(
    df: DataFrame, root: str, batch_id: int, key: str, partition_by: str | None = None, sort_by: str | None = None,
    replace: bool = True, finish: Finish | None = None,
) -> int:
    """Store a batch that holds a key once, with what readers need to find the latest rows;
    returns its number of rows.

    `finish` adds wide columns row by row, behind the shuffle and the sort. The batch counts as stored when the last of the three folders is complete.
    """
    spark = df.sparkSession
    write_batch(df, root, batch_id, partition_by, sort_by, replace, finish)
    schema = finish(df).schema if finish else df.schema
    written = spark.read.schema(schema).parquet(f"{root}/log/batch_id={batch_id}").select(key)
    count = write_keys(written, root, batch_id, key)
    again = stored_keys(written, root, schema, key, before=batch_id)
    _write(again, f"{root}/again/batch_id={batch_id}", None)
    return count


def _again(spark: SparkSession, root: str, schema: StructType, key: str, numbers: list[int]) -> DataFrame:
    """(key, _last): keys that batches of these numbers hold again, with the last such batch."""
    path = f"{root}/again"
    wide = StructType([schema[key], StructField("batch_id", LongType())])
    folders = [f"{path}/batch_id={n}" for n in _folder_numbers(spark, path, "batch_id") if n in numbers]
    if not folders:
        return spark.createDataFrame([], StructType([schema[key], StructField("_last", LongType())]))
    rows = spark.read.schema(wide).option("basePath", path).parquet(*folders)
    return rows.groupBy(key).agg(F.max("batch_id").alias("_last"))


def _folder_numbers(spark: SparkSession, path: str, label: str) -> list[int]:
    prefix = f"{label}="
    return sorted(int(name.removeprefix(prefix)) for name in list_names(spark, path) if name.startswith(prefix))


def _numbers(spark: SparkSession, root: str, folder: str, label: str) -> list[int]:
    """Numbers of the folders `<label>=<n>`, without one that is still being written.

    Batches and snapshots are written one after the other, so only the newest
    can be unfinished. A batch of a keyed log is complete with its `again` folder.
    """
    found = _folder_numbers(spark, f"{root}/{folder}", label)
    if found:
        last = "again" if folder == "log" and path_exists(spark, f"{root}/again") else folder
        if not path_exists(spark, f"{root}/{last}/{label}={found[-1]}/_SUCCESS"):
            found.pop()
    return found


def batch_numbers(spark: SparkSession, root: str) -> list[int]:
    return _numbers(spark, root, "log", "batch_id")


def last_batch(spark: SparkSession, root: str) -> int | None:
    return max(batch_numbers(spark, root), default=None)


def next_batch(spark: SparkSession, root: str) -> int:
    """Number for a batch that is to win over all stored ones."""
    return max((n for n in (last_batch(spark, root), last_snapshot(spark, root)) if n is not None), default=-1) + 1


def last_snapshot(spark: SparkSession, root: str) -> int | None:
    return max(_numbers(spark, root, "snapshot", "upto"), default=None)


def read_batches(
    spark: SparkSession, root: str, schema: StructType, after: int | None = None, upto: int | None = None
) -> DataFrame:
    """Stored batches with their `batch_id`; only the folders asked for are listed."""
    wide = StructType([*schema.fields, StructField("batch_id", LongType())])
    path = f"{root}/log"
    stored = batch_numbers(spark, root)
    wanted = [n for n in stored if (after is None or n > after) and (upto is None or n <= upto)]
    if not wanted:
        return spark.createDataFrame([], wide)
    folders = [f"{path}/batch_id={n}" for n in wanted]
    return spark.read.schema(wide).option("basePath", path).parquet(*folders).select(*wide.fieldNames())


def _snapshot(spark: SparkSession, root: str, schema: StructType, number: int) -> DataFrame:
    return spark.read.schema(schema).parquet(f"{root}/snapshot/upto={number}").select(*schema.fieldNames())


def stored_rows(spark: SparkSession, root: str, schema: StructType) -> DataFrame:
    """All stored rows of a table that holds each key once."""
    base = last_snapshot(spark, root)
    later = read_batches(spark, root, schema, after=base).drop("batch_id")
    return later if base is None else _snapshot(spark, root, schema, base).unionByName(later)


def current_rows(
    spark: SparkSession,
    root: str,
    schema: StructType,
    key: str,
    limit_bytes: int = BROADCAST_BYTES,
    upto: int | None = None,
) -> DataFrame:
    """Latest row per key over the snapshot and the batches after it (up to `upto`).

    A row is superseded if a later batch holds its key again. Those keys were found
    when the batches were written; while they fit a broadcast, the rows are neither
    shuffled nor sorted, and filters on them reach the scan.
    """
    base = last_snapshot(spark, root)
    numbers = [n for n in batch_numbers(spark, root) if (base is None or n > base) and (upto is None or n <= upto)]
    rows = read_batches(spark, root, schema, base, upto).withColumnRenamed("batch_id", "_version")
    if base is not None:
        stored = _snapshot(spark, root, schema, base).withColumn("_version", F.lit(base).cast("long"))
        rows = stored.unionByName(rows)
    if not numbers or (base is None and len(numbers) == 1):
        return rows.select(*schema.fieldNames())
    again = _again(spark, root, schema, key, numbers)
    if measure(again)[1] <= limit_bytes:
        again = F.broadcast(again)
    marked = rows.join(again, key, "left").filter(F.col("_last").isNull() | (F.col("_last") <= F.col("_version")))
    return marked.select(*schema.fieldNames())


def compact(
    spark: SparkSession, root: str, schema: StructType, key: str, partition_by: str | None = None, sort_by: str | None = None
) -> int:
    """Write a snapshot of everything stored so far; returns its batch number.

    Older folders are left alone: readers may still use them.
    """
    upto = last_batch(spark, root)
    if upto is None:
        raise ValueError(f"nothing stored below {root}")
    if last_snapshot(spark, root) != upto:
        rows = current_rows(spark, root, schema, key, upto=upto)
        _write(rows, f"{root}/snapshot/upto={upto}", partition_by, sort_by)
    return upto


def replace_table(df: DataFrame, path: str, partition_by: str = "dt") -> None:
    """Replace all partitions."""
    _write(df, path, partition_by)


def replace_partition(df: DataFrame, path: str, value: str, partition_by: str = "dt") -> None:
    """Replace one partition and leave the others as they are.

    Written straight to the partition's folder, so that a value without rows
    empties it; a dynamic overwrite would keep the old rows.
    """
    rows = df.filter(F.col(partition_by).cast("string") == value).drop(partition_by)
    _write(rows, f"{path}/{partition_by}={value}", None)


def save_as_table(df: DataFrame, name: str, partition_by: str = "dt") -> None:
    """Replace a catalog table, as `createOrReplace` does on a v2 catalog."""
    balanced(df, partition_by).write.mode("overwrite").format("parquet").partitionBy(partition_by).saveAsTable(name)


def checked(vector: Column, dim: int) -> Column:
    """The vector itself; the job fails on a vector of another length."""
    wrong = F.format_string("vector has %d values, the collection expects %d", F.size(vector), F.lit(dim))
    return F.when(F.size(vector) == dim, vector).otherwise(F.raise_error(wrong).cast("array<double>"))
