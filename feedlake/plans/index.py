"""Article index: embed recent articles, store points, search them."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from feedlake.functions.ids import long_to_point, point_id, point_to_long
from feedlake.functions.text import embed_text, head
from feedlake.functions.vector import hash_embedding
from feedlake.operators.knn import knn
from feedlake.operators.tables import bucket_of, checked, current_rows, write_keyed
from feedlake.schema import BODY_CHARS, EMBED_BATCH, EMBED_DIM, LOOKBACK_DAYS, POINT_LOG, TOP_K
from feedlake.session import BROADCAST_BYTES, cut_lineage, measure, path_exists

# Points are stored by bucket, and by id within it.
POINT_BUCKETS = 16
# Ids of hits that the scan of the payloads is given as a filter.
PUSHED_IDS = 1000

Embedder = Callable[[list[str]], list[list[float]]]
Embed = Callable[[DataFrame, Column], DataFrame]
Nearest = Callable[[DataFrame, int], DataFrame]


def recent(silver: DataFrame, as_of: Column | str | dt.date, days: int = LOOKBACK_DAYS) -> DataFrame:
    """Articles of the last `days` days up to now; pruned by partition."""
    day = as_of if isinstance(as_of, Column) else F.lit(as_of).cast("date")
    return silver.filter(F.col("dt") >= F.date_sub(day, days))


def embedded(
    df: DataFrame, text: Column, out: str = "vector", dim: int = EMBED_DIM, model: Embedder | None = None
) -> DataFrame:
    """Add a vector per row: the hash embedding, or that of a given model."""
    if model is None:
        return df.withColumn(out, hash_embedding(text, dim))
    source = df.withColumn("_text", text)
    schema = StructType([*df.schema.fields, StructField(out, ArrayType(DoubleType()))])

    def call(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, EMBED_BATCH):
                part = batch.slice(start, EMBED_BATCH)
                vectors = model(part.column("_text").to_pylist())
                columns = [part.column(i) for i in range(part.num_columns - 1)]
                names = part.schema.names[:-1]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(vectors, pa.list_(pa.float64()))], [*names, out])

    return source.mapInArrow(call, schema)


def points(
    silver: DataFrame, dim: int = EMBED_DIM, model: Embedder | None = None, embed: Embed | None = None,
    keep: list[str] | None = None,
) -> DataFrame:
    """Index points (point_id, vector, payload) of articles; `embed(rows, text)` adds the vectors in place of the model,
    `keep` names further columns to carry."""
    body = F.coalesce(F.col("body"), F.lit(""))
    text = embed_text(F.col("title"), body)
    vectors = embed(silver, text) if embed else embedded(silver, text, "vector", dim, model)
    return vectors.select(
        point_id(F.col("id")).alias("point_id"),
        checked(F.col("vector"), dim).alias("vector"),
        F.struct(
            F.col("id").alias("article_id"),
            F.col("source"),
            F.col("title"),
            head(body, BODY_CHARS).alias("body"),
            F.col("link"),
            F.col("published_at").cast("string").alias("published_at"),
        ).alias("payload"),
        *(keep or []),
    )


def open_collection(spark: SparkSession, root: str, dim: int) -> bool:
    """Create the collection if it does not exist; tells whether it did. Fails for another dimension."""
    path = f"{root}/dimension"
    if path_exists(spark, f"{path}/_SUCCESS"):
        stored = spark.read.schema("dim int").parquet(path).first()["dim"]
        if stored != dim:
            raise ValueError(f"the collection holds vectors of {stored} values, not {dim}")
        return False
    spark.createDataFrame([(dim,)], "dim int").coalesce(1).write.mode("overwrite").parquet(path)
    return True


def index_articles(
    silver: DataFrame,
    root: str,
    batch_id: int,
    dim: int = EMBED_DIM,
    model: Embedder | None = None,
    replace: bool = True,
    embed: Embed | None = None,
) -> int:
    """Upsert the points of the given articles (one row per id); returns their number, 0 if there are none.

    Two jobs that take the same new number would replace each other's points; without
    `replace` the later one fails.
    """
    open_collection(silver.sparkSession, root, dim)
    rows = silver.withColumn("vec_id", point_to_long(point_id(F.col("id"))))
    rows = rows.withColumn("bucket", bucket_of("vec_id", POINT_BUCKETS))
    made = partial(points, dim=dim, model=model, embed=embed, keep=["vec_id", "bucket"])
    if model or embed:
        return write_keyed(made(rows), root, batch_id, "point_id", "bucket", "vec_id", replace)
    # The hash embedding needs nothing but its row: the wide vectors are neither shuffled nor sorted.
    return write_keyed(rows, root, batch_id, "point_id", "bucket", "vec_id", replace, made)


def collection(spark: SparkSession, root: str) -> DataFrame:
    return current_rows(spark, root, POINT_LOG, "point_id")


def search(queries: DataFrame, stored: DataFrame, k: int = TOP_K, nearest: Nearest | None = None, **limits: int) -> DataFrame:
    """Top k points for each (qid, vector), with score and payload fields.

    `nearest(queries, k)` finds the hits in place of the exact search, as a `CellIndex` over the same points does.

    Vectors and payloads are read separately: the scan that scores carries no
    text, and the one that fetches payloads carries no vectors and reads only the buckets
    that hold a hit. Points lie sorted by id within them, and the ids of up to `PUSHED_IDS` hits are handed to the
    scan, which then skips the pages without one. The hits are stored first; if they fit a broadcast, the
    payloads are not shuffled.
    """
    found = nearest(queries, k) if nearest else knn(queries, stored.select("vec_id", "vector"), k, **limits)
    hits = cut_lineage(found, "hits")
    hits = hits.withColumn("bucket", bucket_of("vec_id", POINT_BUCKETS))
    touched = [row[0] for row in hits.select("bucket").distinct().collect()]  # at most one per bucket
    wanted = hits.select("vec_id").distinct()
    if measure(hits)[1] <= BROADCAST_BYTES:
        hits = F.broadcast(hits)
    payloads = stored.select("vec_id", "bucket", "payload").filter(F.col("bucket").isin(touched))
    ids = [row[0] for row in wanted.limit(PUSHED_IDS + 1).collect()]
    if len(ids) <= PUSHED_IDS:
        payloads = payloads.filter(F.col("vec_id").isin(ids))
    found = payloads.join(hits, ["bucket", "vec_id"])
    return found.select("qid", "rank", long_to_point(F.col("vec_id")).alias("point_id"), "score", "payload.*")


def retrieve(
    queries: DataFrame,
    stored: DataFrame,
    k: int = TOP_K,
    dim: int = EMBED_DIM,
    model: Embedder | None = None,
    nearest: Nearest | None = None,
) -> DataFrame:
    """Top k articles for each (qid, text). Questions are embedded once and stored, as the
    search looks at them more than once."""
    asked = embedded(queries, F.col("text"), "vector", dim, model).select("qid", "vector")
    return search(cut_lineage(asked, "questions"), stored, k, nearest)
