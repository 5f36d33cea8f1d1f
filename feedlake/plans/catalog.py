"""Names for the stored tables, so that SQL users can read them.

The batch folders become external tables; `silver_news` and `news_points` are
views that show the latest row per key. A row is superseded where a later batch
holds its key again, which the small `*_again` tables tell; so a filter on `dt`
prunes folders, and the rows are not shuffled while those tables fit a broadcast.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import SparkSession
from pyspark.sql.types import LongType, StructField, StructType

from feedlake.operators.tables import batch_numbers, create_database, create_table, last_snapshot
from feedlake.schema import BRONZE, POINT, POINT_LOG, SILVER, SILVER_LOG
from feedlake.session import BROADCAST_BYTES, list_names, measure, path_exists

# The folder of rows whose partition value is null or empty.
_NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"
_PARTITIONS_AT_ONCE = 200

_DAILY_SOURCE = StructType().add("source", "string").add("article_count", "long").add("dt", "date")
_DAILY_KEYWORD = StructType().add("token", "string").add("freq", "long").add("dt", "date")


def _numbered(schema: StructType, number: str) -> StructType:
    return StructType([*schema.fields, StructField(number, LongType())])


def _key(schema: StructType, key: str) -> StructType:
    return _numbered(StructType([schema[key]]), "batch_id")


# name: (columns, partition columns, folder)
_TABLES = {
    "bronze_news": (_numbered(BRONZE, "batch_id"), ["batch_id", "source"], "bronze/log"),
    "silver_log": (_numbered(SILVER_LOG, "batch_id"), ["batch_id", "dt"], "silver/log"),
    "silver_snapshot": (_numbered(SILVER_LOG, "upto"), ["upto", "dt"], "silver/snapshot"),
    "silver_again": (_key(SILVER, "id"), ["batch_id"], "silver/again"),
    "point_log": (_numbered(POINT_LOG, "batch_id"), ["batch_id", "bucket"], "points/log"),
    "point_snapshot": (_numbered(POINT_LOG, "upto"), ["upto", "bucket"], "points/snapshot"),
    "point_again": (_key(POINT, "point_id"), ["batch_id"], "points/again"),
    "gold_daily_source": (_DAILY_SOURCE, ["dt"], "gold/gold_daily_source"),
    "gold_daily_keyword": (_DAILY_KEYWORD, ["dt"], "gold/gold_daily_keyword"),
}

# view: (prefix of its tables, folder, key, columns)
_VIEWS = {
    "silver_news": ("silver", "silver", "id", SILVER),
    "news_points": ("point", "points", "point_id", POINT),
}


def open_tables(spark: SparkSession, database: str, root: str) -> list[str]:
    """Create the database and the tables that do not exist yet, and show what is stored;
    returns the new tables."""
    create_database(spark, database, f"{root}/database")
    created = [
        name
        for name, (schema, parts, folder) in _TABLES.items()
        if create_table(spark, f"{database}.{name}", schema, parts, f"{root}/{folder}")
    ]
    refresh_tables(spark, database, root)
    return created


def refresh_tables(spark: SparkSession, database: str, root: str) -> None:
    """Let the tables and views show what is stored now, without unfinished batches and snapshots."""
    for name, (_, parts, folder) in _TABLES.items():
        if not path_exists(spark, f"{root}/{folder}"):
            continue
        if parts == ["dt"]:
            spark.catalog.recoverPartitions(f"{database}.{name}")
            continue
        _add_finished(spark, f"{database}.{name}", root, folder, parts)
    for view, (prefix, folder, key, schema) in _VIEWS.items():
        _latest_view(spark, f"{database}.{view}", f"{database}.{prefix}", key, schema, last_snapshot(spark, f"{root}/{folder}"))


def _add_finished(spark: SparkSession, table: str, root: str, folder: str, parts: list[str]) -> None:
    home, kind = folder.split("/")
    base = f"{root}/{home}"
    if kind == "snapshot":
        newest = last_snapshot(spark, base)
        numbers = [] if newest is None else [newest]
    else:
        numbers = batch_numbers(spark, base)
    known = {row["partition"] for row in spark.sql(f"SHOW PARTITIONS {table}").collect()}
    for number in numbers:
        first = f"{parts[0]}={number}"
        path = f"{root}/{folder}/{first}"
        inner = [name for name in list_names(spark, path) if "=" in name] if len(parts) > 1 else [""]
        specs = ["/".join(p for p in (first, part) if p) for part in inner]
        new = [f"PARTITION ({_values(s)}) LOCATION {_literal(f'{root}/{folder}/{s}')}" for s in specs if s not in known]
        for start in range(0, len(new), _PARTITIONS_AT_ONCE):
            spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {' '.join(new[start : start + _PARTITIONS_AT_ONCE])}")
    spark.catalog.refreshTable(table)


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _values(spec: str) -> str:
    """The partition values that a folder name stands for; writers escape what a path cannot hold."""
    pairs = [part.split("=", 1) for part in spec.split("/")]
    return ", ".join(f"`{c}` = {'null' if v == _NULL_FOLDER else _literal(unquote(v))}" for c, v in pairs)


def _latest_view(spark: SparkSession, view: str, prefix: str, key: str, schema: StructType, base: int | None) -> None:
    columns = ", ".join(f"`{name}`" for name in schema.fieldNames())
    rows = f"SELECT {columns}, batch_id AS version FROM {prefix}_log"
    if base is not None:
        rows += f" WHERE batch_id > {base} UNION ALL SELECT {columns}, upto AS version FROM {prefix}_snapshot WHERE upto = {base}"
    again = f"SELECT {key} AS again, max(batch_id) AS latest FROM {prefix}_again GROUP BY {key}"
    # What the table shows changes with a refresh only, so its size is known here.
    hint = "/*+ BROADCAST(a) */ " if measure(spark.sql(again))[1] <= BROADCAST_BYTES else ""
    spark.sql(
        f"CREATE OR REPLACE VIEW {view} AS SELECT {hint}{columns} FROM ({rows}) r LEFT ANTI JOIN ({again}) a "
        f"ON r.{key} = a.again AND a.latest > r.version"
    )
