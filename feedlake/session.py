"""Session settings, the shared work folder, and size checks for broadcasts."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What one broadcast side may hold; larger sides take the shuffled way.
BROADCAST_BYTES = 64 * 1024 * 1024

_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Where every task's part of the smaller side is below this, AQE hashes it
    # and the wide side of a join (texts, mostly) is not sorted.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    # Longer lists of wanted ids reach the files as a list, not as their range only.
    "spark.sql.parquet.pushdown.inFilterThreshold": "1000",
    # Texts take about two thirds of the room that the default codec needs.
    "spark.sql.parquet.compression.codec": "zstd",
    # Rows with vectors reach Python in small batches, of which every task holds a few.
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
    # State of streams lies on disk beside the tasks, and only its changes go to the checkpoint.
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(
    app: str = "feedlake", master: str | None = None, zone: str = "UTC", settings: dict[str, str] | None = None
) -> SparkSession:
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false").config(map=settings or {})
    if master:
        builder = builder.master(master)
    return pin(builder.getOrCreate(), zone)


def pin(spark: SparkSession, zone: str = "UTC") -> SparkSession:
    """Fix the session zone, so that `dt` does not depend on the machine, and turn on AQE."""
    spark.conf.set("spark.sql.session.timeZone", zone)
    for name, value in _SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by `spark.checkpoint.dir`.

    Where it is not set, a local master falls back on Spark's own scratch
    folder, since driver and executors are one process there.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    return context.getConf().get("spark.local.dir", "/tmp").split(",")[0].rstrip("/")


def workspace(spark: SparkSession, label: str) -> str:
    """A new, unused folder name below the shared root.

    All of them lie in one folder of the application, which is removed when it ends.
    """
    home = f"{shared_root(spark)}/feedlake/{spark.sparkContext.applicationId}"
    target = spark._jvm.org.apache.hadoop.fs.Path(home)
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(target):
        system.mkdirs(target)
        system.deleteOnExit(target)
    return f"{home}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, label: str) -> DataFrame:
    """Write the frame once and go on from the files.

    Used where a frame has several consumers or where a loop would grow the
    plan. Unlike cached blocks, the files outlive a lost executor.
    """
    path = workspace(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder; empty if the folder does not exist."""
    if not path_exists(spark, path):
        return []
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = target.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(target)
    return [status.getPath().getName() for status in found]


def _width(value: Column, kind: T.DataType) -> Column:
    """Estimated bytes of a value, parts of nested ones included."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(value), F.lit(0)) + 24
    if isinstance(kind, T.ArrayType):
        if isinstance(kind.elementType, (T.NumericType, T.BooleanType, T.DateType, T.TimestampType)):
            inner = F.greatest(F.coalesce(F.size(value), F.lit(0)), F.lit(0)) * 8
        else:
            each = F.transform(value, lambda x: _width(x, kind.elementType).cast("long"))
            inner = F.coalesce(F.aggregate(each, F.lit(0).cast("long"), lambda total, n: total + n), F.lit(0))
        return inner + 24
    if isinstance(kind, T.MapType):
        keys, values = T.ArrayType(kind.keyType), T.ArrayType(kind.valueType)
        return _width(F.map_keys(value), keys) + _width(F.map_values(value), values)
    if isinstance(kind, T.StructType):
        total = F.lit(16)
        for field in kind.fields:
            total = total + _width(value[field.name], field.dataType)
        return total
    return F.lit(16)


def measure(df: DataFrame) -> tuple[int, int]:
    """(rows, estimated bytes) of a frame, from one aggregate row."""
    width = F.lit(0).cast("long")
    for field in df.schema.fields:
        width = width + _width(F.col(f"`{field.name}`"), field.dataType)
    row = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(width), F.lit(0)).alias("b")).first()
    return row["n"], row["b"]
