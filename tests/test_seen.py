import pytest
from pyspark.sql import functions as F

from feedlake.operators.dedupe import first_seen
from feedlake.operators.seen import FALSE_RATE, first_unseen, seen_filter, with_maybe, without_known
from feedlake.plans.silver import arrival_order
from tests.helpers import event, events, plan, values


def keys(spark, low, high):
    return spark.range(low, high).select(F.sha2(F.col("id").cast("string"), 256).alias("id"))


@pytest.mark.parametrize("n", [1, 300, 50_000])
def test_rates(spark, n):
    known = seen_filter(keys(spark, 0, n), "id", n)
    assert with_maybe(keys(spark, 0, n), known, "id").filter("not _maybe").count() == 0
    alarms = with_maybe(keys(spark, n, n + 50_000), known, "id").filter("_maybe").count()
    assert alarms <= FALSE_RATE * 50_000 * (1 if n > 1000 else 2)


def test_equal_to_the_plain_join(spark):
    rows = [event(f"id{n % 70}", title=f"t{n}", arrived=f"2025-11-03 10:{n % 60:02}:00") for n in range(200)] + [event(None)]
    stored = spark.createDataFrame([(f"id{n}",) for n in range(0, 140, 2)] + [(None,), ("id0",)], "id string")
    columns = ["id", "title"]
    got = first_unseen(events(spark, *rows), arrival_order(), stored)
    assert values(got, *columns) == values(first_seen(events(spark, *rows), arrival_order(), stored), *columns)
    assert got.columns == events(spark).columns


def test_empty_sides(spark):
    some, none = keys(spark, 0, 20), keys(spark, 0, 0)
    assert without_known(some, none, "id").count() == 20
    assert without_known(none, some, "id").count() == 0
    assert without_known(some, some, "id").count() == 0


def test_nothing_is_shuffled_by_id(spark, root):
    """Neither the rows that ask nor the stored keys; the plain join shuffles both."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        keys(spark, 0, 5000).write.parquet(f"{root}/stored")
        keys(spark, 4000, 9000).withColumn("payload", F.repeat(F.lit("x"), 500)).write.parquet(f"{root}/rows")
        stored, rows = spark.read.parquet(f"{root}/stored"), spark.read.parquet(f"{root}/rows")
        filtered, plain = without_known(rows, stored, "id"), rows.join(stored, "id", "left_anti")
        assert filtered.count() == plain.count() == 4000
        assert "Exchange hashpartitioning" not in plan(filtered) and plan(plain).count("Exchange hashpartitioning") >= 2
        asked = plan(with_maybe(rows, seen_filter(stored, "id", 5000), "id"))
        assert "Exchange hashpartitioning" not in asked and "BroadcastHashJoin" in asked
        wide = with_maybe(rows, seen_filter(stored, "id", 5000), "id", limit_bytes=10)
        assert wide.filter("_maybe").count() >= 1000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
