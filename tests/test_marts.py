import datetime as dt

from pyspark.sql import functions as F

from feedlake.plans.marts import (
    build_gold,
    daily_keyword,
    daily_source,
    for_date,
    read_gold,
    top_keywords,
    top_keywords_per_day,
    top_sources,
)
from feedlake.plans.silver import silver
from tests.helpers import event, events, plan, values


def articles(spark, *rows):
    frame = spark.createDataFrame([(str(n), *row) for n, row in enumerate(rows)], "id string, dt string, source string, title string")
    return frame.withColumn("dt", F.to_date("dt"))


def test_keywords_of_korean_titles(spark):
    rows = articles(
        spark,
        ("2025-11-03", "s", "[속보] 삼성전자, 3분기 (종합) A·I 그 및"),
        ("2025-11-03", "s", "삼성전자 삼성전자 ai 기자 코스피"),
        ("2025-11-04", "s", "삼성전자"),
    )
    got = values(daily_keyword(rows).withColumn("dt", F.col("dt").cast("string")), "dt", "token", "freq")
    assert got == [
        ("2025-11-03", "3분기", 1),
        ("2025-11-03", "AI", 1),
        ("2025-11-03", "ai", 1),
        ("2025-11-03", "삼성전자", 3),
        ("2025-11-04", "삼성전자", 1),
    ]


def test_counts_add_up_to_silver(spark):
    rows = silver(events(spark, *[event(f"{n}", source=f"s{n % 3}") for n in range(20)], event("1"), event("", title="")))
    assert daily_source(rows).agg(F.sum("article_count")).first()[0] == rows.count() == 20


def test_date_filter_is_optional(spark):
    rows = articles(spark, ("2025-11-03", "s", "t"), ("2025-11-04", "s", "t"))
    assert for_date(rows, None).count() == for_date(rows, "").count() == 2
    assert for_date(rows, "2025-11-04").count() == 1


def test_heads_have_a_total_order(spark):
    day = dt.date(2025, 11, 3)
    rows = spark.createDataFrame([(day, f"t{n:02}", 5) for n in range(30)], "dt date, token string, freq long")
    assert [r["token"] for r in top_keywords(rows).collect()] == [f"t{n:02}" for n in range(15)]
    per_day = top_keywords_per_day(rows, 4)
    assert values(per_day, "token", "rank") == [(f"t{n:02}", n + 1) for n in range(4)]
    assert "WindowGroupLimit" in plan(per_day)
    named = rows.select("dt", F.col("token").alias("source"), F.col("freq").alias("article_count"))
    assert len(top_sources(named).collect()) == 10
    assert "TakeOrderedAndProject" in plan(top_sources(named))


def test_dated_build_replaces_that_day_only(spark, root):
    first = articles(spark, ("2025-11-03", "a", "alpha"), ("2025-11-04", "a", "beta"))
    later = articles(spark, ("2025-11-03", "b", "gamma"), ("2025-11-04", "b", "delta delta"))
    build_gold(first, root)
    build_gold(later, root, "2025-11-04")
    words = read_gold(spark, root, "gold_daily_keyword").withColumn("dt", F.col("dt").cast("string"))
    sources = read_gold(spark, root, "gold_daily_source").withColumn("dt", F.col("dt").cast("string"))
    assert values(words, "dt", "token", "freq") == [("2025-11-03", "alpha", 1), ("2025-11-04", "delta", 2)]
    assert values(sources, "dt", "source") == [("2025-11-03", "a"), ("2025-11-04", "b")]
    build_gold(later, root)
    assert read_gold(spark, root, "gold_daily_keyword").count() == 2


def test_mart_scan_reads_only_its_columns(spark, root):
    articles(spark, ("2025-11-03", "a", "alpha")).withColumn("body", F.lit("long")).write.partitionBy("dt").parquet(f"{root}/t")
    stored = spark.read.schema("id string, source string, title string, body string, dt date").parquet(f"{root}/t")
    words = daily_keyword(for_date(stored, "2025-11-03"))
    assert words.count() == 1
    text = plan(words)
    assert "ReadSchema: struct<title:string>" in text and "PartitionFilters: [isnotnull(dt" in text
