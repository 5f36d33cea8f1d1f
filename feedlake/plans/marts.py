"""Daily counts per source and per title keyword."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.functions.text import title_words
from feedlake.operators.tables import replace_partition, replace_table
from feedlake.operators.topk import top, top_per
from feedlake.schema import MIN_TOKEN_CHARS, STOP_WORDS

TOP_SOURCES = 10
TOP_KEYWORDS = 15


def for_date(silver: DataFrame, date: str | None) -> DataFrame:
    """One day of silver; None or '' means all of it."""
    return silver.filter(F.col("dt") == F.to_date(F.lit(date))) if date else silver


def daily_source(silver: DataFrame) -> DataFrame:
    return silver.groupBy("dt", "source").agg(F.count(F.lit(1)).alias("article_count"))


def keywords(silver: DataFrame, stop_words: list[str] = STOP_WORDS) -> DataFrame:
    """(dt, token) of each occurrence in a title; case counts."""
    words = silver.select("dt", F.explode(title_words(F.col("title"))).alias("token"))
    return words.filter((F.length("token") >= MIN_TOKEN_CHARS) & ~F.col("token").isin(stop_words))


def daily_keyword(silver: DataFrame, stop_words: list[str] = STOP_WORDS) -> DataFrame:
    """Occurrences of each token in the titles of a day."""
    return keywords(silver, stop_words).groupBy("dt", "token").agg(F.count(F.lit(1)).alias("freq"))


def top_sources(daily: DataFrame, k: int = TOP_SOURCES) -> DataFrame:
    return top(daily, k, [F.col("article_count").desc(), F.col("dt"), F.col("source")])


def top_keywords(daily: DataFrame, k: int = TOP_KEYWORDS) -> DataFrame:
    return top(daily, k, [F.col("freq").desc(), F.col("dt"), F.col("token")])


def top_keywords_per_day(daily: DataFrame, k: int = TOP_KEYWORDS) -> DataFrame:
    return top_per(daily, ["dt"], k, [F.col("freq").desc(), F.col("token").asc()])


def build_gold(silver: DataFrame, root: str, date: str | None = None) -> None:
    """Write both marts; with a date only that day's partitions are replaced.

    The columns of a single day are kept for the second mart. A full rebuild
    reads its two or three columns twice instead of storing a copy of them.
    """
    if not date:
        replace_table(daily_source(silver), f"{root}/gold_daily_source")
        replace_table(daily_keyword(silver), f"{root}/gold_daily_keyword")
        return
    day = for_date(silver, date).select("dt", "source", "title").persist()
    try:
        replace_partition(daily_source(day), f"{root}/gold_daily_source", date)
        replace_partition(daily_keyword(day), f"{root}/gold_daily_keyword", date)
    finally:
        day.unpersist()


def read_gold(spark: SparkSession, root: str, name: str) -> DataFrame:
    schema = {
        "gold_daily_source": "source string, article_count long, dt date",
        "gold_daily_keyword": "token string, freq long, dt date",
    }[name]
    return spark.read.schema(schema).parquet(f"{root}/{name}")
