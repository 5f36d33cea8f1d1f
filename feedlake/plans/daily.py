"""The daily run: marts, then index, then briefings, all for one date."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from feedlake.operators.tables import current_rows, next_batch
from feedlake.plans.briefing import ChatModel, run_briefings, write_briefings
from feedlake.plans.index import Embedder, collection, index_articles, recent, retrieve
from feedlake.plans.marts import build_gold
from feedlake.schema import BRIEFING_TOP_K, DEFAULT_QUERY, EMBED_DIM, LOOKBACK_DAYS, MAX_LOOPS, SILVER_LOG


def run_daily(
    spark: SparkSession,
    root: str,
    date: str,
    queries: DataFrame | None = None,
    embedder: Embedder | None = None,
    model: ChatModel | None = None,
    lookback: int = LOOKBACK_DAYS,
    dim: int = EMBED_DIM,
    max_loops: int = MAX_LOOPS,
) -> DataFrame:
    """Run the three jobs for `date` on the tables below `root`.

    Running a date again replaces its marts and briefings and upserts the same
    index points.
    """
    silver = current_rows(spark, f"{root}/silver", SILVER_LOG, "id")
    build_gold(silver, f"{root}/gold", date)
    fresh = recent(silver, date, lookback)
    index_articles(fresh, f"{root}/points", next_batch(spark, f"{root}/points"), dim, embedder, replace=False)
    stored = collection(spark, f"{root}/points")
    if queries is None:
        queries = spark.createDataFrame([(1, DEFAULT_QUERY)], "qid long, query string")
    briefings = run_briefings(
        queries, lambda asked: retrieve(asked, stored, BRIEFING_TOP_K, dim, embedder), model, max_loops=max_loops
    )
    write_briefings(briefings, f"{root}/briefings", date)
    return briefings
