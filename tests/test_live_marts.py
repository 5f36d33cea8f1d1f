import random

from pyspark.sql import functions as F

from feedlake.operators.tables import last_batch, read_batches
from feedlake.plans.marts import daily_keyword, daily_source
from feedlake.plans.silver import silver
from feedlake.sources.messages import message_file_stream, publish_files, to_messages
from feedlake.streaming.live_marts import MARTS, _schema, fold, read_live, start_live_marts
from tests.helpers import event, events, plan, values


def run(spark, root, rows):
    publish_files(to_messages(events(spark, *rows), "kafka_ts"), f"{root}/inbox")
    query = start_live_marts(message_file_stream(spark, f"{root}/inbox"), f"{root}/t", availableNow=True)
    query.awaitTermination()
    return query


def compare(spark, root, rows):
    """Marts of the silver that has the rows of the given drops, the last drop winning."""
    kept = {}
    for drop in rows:
        clean = {r["id"]: r for r in silver(events(spark, *drop)).collect()}
        kept.update(clean)
    table = spark.createDataFrame(list(kept.values()), silver(events(spark)).schema)
    for mart, build in (("gold_daily_source", daily_source), ("gold_daily_keyword", daily_keyword)):
        columns = ["dt", *MARTS[mart]]
        assert values(read_live(spark, f"{root}/t", mart), *columns) == values(build(table), *columns)


def random_drop(rng, n):
    rows = []
    for _ in range(n):
        title = " ".join(rng.choice(["Growth", "report", "bank", "rates", "x"]) for _ in range(rng.randrange(4)))
        rows.append(event(rng.choice([f"id{rng.randrange(30)}", None]) if rng.random() < 0.9 else "hot", title=title, source=f"s{rng.randrange(3)}",
                          arrived=f"2025-11-0{rng.randrange(3, 6)} 10:{rng.randrange(60):02}:00"))
    return rows


def test_marts_follow_three_drops(spark, root):
    rng, drops = random.Random(5), []
    for n in (60, 25, 40):
        drops.append(random_drop(rng, n))
        run(spark, root, drops[-1])
        compare(spark, root, drops)
        if n == 25:
            fold(spark, f"{root}/t")
            compare(spark, root, drops)


def test_only_changed_keys_are_touched(spark, root):
    run(spark, root, [event(f"id{n}", title=f"word{n}", source=f"s{n}") for n in range(50)])
    query = run(spark, root, [event("id7", title="other", source="s7", arrived="2025-11-03 11:00:00"), event("id8", title="word8", source="s8")])
    progress = next(p for p in query.recentProgress if p["numInputRows"])
    state = progress["stateOperators"][0]
    assert progress["numInputRows"] == 2 and state["numRowsUpdated"] == 1 and state["numRowsTotal"] == 50
    path = f"{root}/t/gold_daily_keyword"
    changes = read_batches(spark, path, _schema("gold_daily_keyword"), after=last_batch(spark, path) - 1)
    assert values(changes, "token", "freq") == [("other", 1), ("word7", -1)]
    assert read_live(spark, f"{root}/t", "gold_daily_source").count() == 50


def test_filters_prune_days(spark, root):
    run(spark, root, [event("a", arrived="2025-11-03 10:00:00"), event("b", arrived="2025-11-04 10:00:00")])
    day = read_live(spark, f"{root}/t", "gold_daily_source", where=F.col("dt") == F.to_date(F.lit("2025-11-04")))
    assert day.count() == 1
    scan = next(line for line in plan(day).splitlines() if "FileScan" in line)
    assert "2025-11-04" in scan.split("PartitionFilters: [")[1].split("]")[0] or "dt" in scan.split("PartitionFilters: [")[1].split("]")[0]


def test_nothing_stored(spark, root):
    fold(spark, root)
    for mart in MARTS:
        assert read_live(spark, root, mart).count() == 0
