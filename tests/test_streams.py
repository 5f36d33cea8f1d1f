import os
import threading
import time

from pyspark.sql import functions as F

from feedlake.operators import tables
from feedlake.operators.tables import last_batch, stored_keys
from feedlake.plans.silver import silver
from feedlake.sources.messages import decode, message_file_stream, message_files, publish_files, to_messages
from feedlake.streaming.streams import (
    batch_report,
    event_stream,
    read_bronze,
    read_first,
    read_silver,
    run_ingest,
    start_bronze,
    start_dedupe,
    start_silver,
    write_bronze,
)
from feedlake.schema import BRONZE
from tests.helpers import event, events, plan, values

DROPS = [
    [event("a", title="a1"), event("b", title="b1"), event("a", title="a0", arrived="2025-11-03 09:00:00")],
    [event("b", title="b2", arrived="2025-11-03 12:00:00"), event("c", title="", arrived="2025-11-03 12:00:00")],
    [event("a", title="a3", arrived="2025-11-02 00:00:00", published="2025-11-01 00:00:00"), event("d", title="d3")],
]


def land(spark, path, rows):
    publish_files(to_messages(events(spark, *rows), "kafka_ts"), path)


def test_both_tables_from_one_stream(spark, root):
    inbox = f"{root}/inbox"
    for drop in DROPS:
        land(spark, inbox, drop)
        run_ingest(message_file_stream(spark, inbox), f"{root}/tables", availableNow=True)
    assert values(read_bronze(spark, f"{root}/tables/bronze"), "id", "title") == [
        ("a", "a0"), ("b", "b1"), ("c", ""), ("d", "d3"),
    ]
    # A late event still updates silver: the watermark drops nothing there.
    assert values(read_silver(spark, f"{root}/tables/silver"), "id", "title") == [("a", "a3"), ("b", "b2"), ("d", "d3")]


def test_one_drop_equals_the_batch_job(spark, root):
    land(spark, f"{root}/inbox", [row for drop in DROPS for row in drop])
    start_silver(event_stream(message_file_stream(spark, f"{root}/inbox")), f"{root}/t", availableNow=True).awaitTermination()
    want = silver(decode(message_files(spark, f"{root}/inbox")))
    assert values(read_silver(spark, f"{root}/t"), *want.columns) == values(want, *want.columns)


def test_a_stream_without_new_data_changes_nothing(spark, root):
    land(spark, f"{root}/inbox", DROPS[0])
    for _ in range(2):
        run_ingest(message_file_stream(spark, f"{root}/inbox"), f"{root}/t", availableNow=True)
    assert read_bronze(spark, f"{root}/t/bronze").count() == 2


def test_a_backlog_is_taken_in_small_batches(spark, root):
    for drop in DROPS:
        land(spark, f"{root}/inbox", drop)
    run_ingest(message_file_stream(spark, f"{root}/inbox", per_batch=1), f"{root}/t", availableNow=True)
    assert last_batch(spark, f"{root}/t/bronze") > 1
    assert values(read_bronze(spark, f"{root}/t/bronze"), "id") == [("a",), ("b",), ("c",), ("d",)]
    assert values(read_silver(spark, f"{root}/t/silver"), "id") == [("a",), ("b",), ("d",)]


def test_broken_messages_stay_out(spark, root):
    rows = events(spark, event("a"))
    broken = to_messages(rows, "kafka_ts").withColumn("value", F.lit("{oops"))
    publish_files(to_messages(rows, "kafka_ts").unionByName(broken), f"{root}/inbox")
    run_ingest(message_file_stream(spark, f"{root}/inbox"), f"{root}/t", availableNow=True)
    assert values(read_bronze(spark, f"{root}/t/bronze"), "id") == [("a",)]
    assert values(read_silver(spark, f"{root}/t/silver"), "id") == [("a",)]


def test_progress_counts_events_without_an_id(spark, root):
    land(spark, f"{root}/inbox", [event("a"), event(None), event(None)])
    query = start_bronze(event_stream(message_file_stream(spark, f"{root}/inbox")), f"{root}/t", availableNow=True)
    query.awaitTermination()
    counted = [p["observedMetrics"]["events"] for p in query.recentProgress if p["numInputRows"]]
    assert [(row["total"], row["without_id"]) for row in counted] == [(3, 2)]


def dedupe(spark, root, drops, delay):
    for drop in drops:
        land(spark, f"{root}/inbox", drop)
        start_dedupe(message_file_stream(spark, f"{root}/inbox"), f"{root}/t", delay, availableNow=True).awaitTermination()
    return values(read_first(spark, f"{root}/t"), "id", "title")


def test_dedupe_forgets_after_the_delay_and_drops_late_events(spark, root):
    got = dedupe(
        spark,
        root,
        [
            [event("a", title="first", arrived="2025-11-03 00:00:00")],
            [event("a", title="dup", arrived="2025-11-03 01:00:00"), event("b", title="b", arrived="2025-11-03 01:30:00")],
            [event("c", title="far", arrived="2025-11-04 00:00:00")],
            [event("a", title="again", arrived="2025-11-04 00:30:00"), event("late", arrived="2025-11-03 00:00:00")],
        ],
        "2 hours",
    )
    assert got == [("a", "again"), ("a", "first"), ("b", "b"), ("c", "far")]


def test_dedupe_keeps_the_first_event_of_a_batch(spark, root):
    drop = [event("a", title=f"at {m}", arrived=f"2025-11-03 10:{m:02}:00") for m in range(50, 9, -1)]
    assert dedupe(spark, root, [drop, [event("a", title="later", arrived="2025-11-03 10:55:00")]], "2 hours") == [("a", "at 10")]


def test_dedupe_settles_equal_ids_of_a_batch(spark, root):
    """The pick is the first by arrival, then by source, date text and title, whatever file a row comes from."""
    rows = [event(f"id{n % 40}", title=f"t{n:03}", source=f"s{n % 7}", arrived=f"2025-11-03 10:{n % 3:02}:00") for n in range(400)]
    land(spark, f"{root}/inbox", rows[::2])
    got = dedupe(spark, root, [rows[1::2]], "2 hours")
    want = {}
    for id, source, title, *_, arrived in sorted(rows, key=lambda r: (r[7], r[1], r[5], r[2])):
        want.setdefault(id, title)
    assert got == sorted(want.items())


def test_late_and_timely_events_of_one_id(spark, root):
    drops = [
        [event("far", arrived="2025-11-03 12:00:00")],
        [event("a", title="late", arrived="2025-11-03 09:00:00"), event("a", title="in time", arrived="2025-11-03 11:00:00")],
    ]
    assert dedupe(spark, root, drops, "2 hours") == [("a", "in time"), ("far", "title")]


def test_dedupe_reports(spark, root):
    land(spark, f"{root}/inbox", [event("a"), event("a"), event(None), event("b", arrived="2025-11-03 13:00:00")])
    run = lambda: start_dedupe(message_file_stream(spark, f"{root}/inbox"), f"{root}/t", "1 hour", availableNow=True)
    first = run()
    first.awaitTermination()
    first, last = batch_report(first)[0], batch_report(first)[-1]
    assert first[1:4] == (4, 0, 1) and last[4] == "2025-11-03T12:00:00.000Z"
    land(spark, f"{root}/inbox", [event("b", arrived="2025-11-03 13:30:00"), event("c", arrived="2025-11-03 12:00:00"), event("d", arrived="2025-11-03 12:00:01")])
    second = run()
    second.awaitTermination()
    assert batch_report(second)[0][1:4] == (3, 1, 1)
    assert values(read_first(spark, f"{root}/t"), "id") == [("a",), ("b",), ("d",)]


def test_dedupe_runs_a_lost_batch_again(spark, root):
    """A batch whose commit is lost is run again from its checkpoint, and its events are stored once."""
    spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")  # else the last batch is an empty one
    try:
        assert dedupe(spark, root, DROPS[:2], "3 hours") == [("a", "a0"), ("b", "b1"), ("c", "")]
        commits = f"{root}/t/checkpoint/commits"
        last = max(int(name) for name in os.listdir(commits) if name.isdigit())
        for name in (f"{last}", f".{last}.crc"):
            os.remove(f"{commits}/{name}")
        assert dedupe(spark, root, DROPS[2:], "3 hours") == [("a", "a0"), ("b", "b1"), ("c", ""), ("d", "d3")]
    finally:
        spark.conf.unset("spark.sql.streaming.noDataMicroBatches.enabled")


def test_dedupe_without_events(spark, root):
    assert read_first(spark, root).count() == 0 and read_first(spark, root).columns == BRONZE.fieldNames()
    assert dedupe(spark, root, [[event(None)]], "2 hours") == []


def test_dedupe_shuffles_once_and_keeps_ids(spark, root):
    land(spark, f"{root}/inbox", DROPS[0])
    query = start_dedupe(message_file_stream(spark, f"{root}/inbox"), f"{root}/t", availableNow=True)
    query.awaitTermination()
    text = query._jsq.explainInternal(False) if hasattr(query._jsq, "explainInternal") else ""
    above, below = text.split("StreamingDeduplicateWithinWatermark")[:2]
    assert below.count("Exchange") == 1 and "Sort" in below.split("Exchange")[0] and "Exchange" not in above
    assert spark.conf.get("spark.sql.streaming.unsupportedOperationCheck") == "true"
    assert "RocksDB" in spark.conf.get("spark.sql.streaming.stateStore.providerClass")


def test_only_touched_key_buckets_are_read(spark, root, monkeypatch):
    """The number of buckets follows the number of keys, so that a small batch reads a small share of them."""
    monkeypatch.setattr(tables, "KEYS_PER_BUCKET", 25)
    write_bronze(events(spark, *[event(f"id{n}") for n in range(1600)]), 0, root)
    write_bronze(events(spark, event("small")), 1, root)
    assert os.listdir(f"{root}/keys/batch_id=0")[0] != "of=1" and "of=64" in os.listdir(f"{root}/keys/batch_id=0")
    assert "of=1" in os.listdir(f"{root}/keys/batch_id=1")
    fresh = events(spark, event("id7"), event("other"), event("small"))
    known = stored_keys(fresh, root, BRONZE, "id")
    assert values(known, "id") == [("id7",), ("small",)]
    scans = [line for line in plan(known).splitlines() if "FileScan" in line and "bucket" in line]
    assert any("PartitionFilters: [" in line and "bucket" in line.split("PartitionFilters: [")[1].split("]")[0] for line in scans)
    assert not any("title" in line for line in scans)
    pruned = stored_keys(fresh.filter("id = 'id7'"), root, BRONZE, "id", before=1)
    assert pruned.count() == 1
    shown = [line for line in plan(pruned).splitlines() if "PartitionFilters" in line]
    assert len(shown) == 1
    buckets = shown[0].split("PartitionFilters: [")[1].split("]")[0]
    assert buckets.count("bucket") <= 2  # one of 64 buckets, and that it is not null


def test_key_buckets_follow_the_count():
    assert [tables.bucket_count(n) for n in (0, 1, 50_000, 50_001, 10**6, 10**9, 10**13)] == [1, 1, 1, 2, 32, 32768, 65536]


def test_run_until_a_query_ends(spark, root):
    land(spark, f"{root}/inbox", DROPS[0])
    ended = threading.Event()

    def run():
        run_ingest(message_file_stream(spark, f"{root}/inbox"), f"{root}/t", processingTime="1 second")
        ended.set()

    threading.Thread(target=run, daemon=True).start()
    for _ in range(200):
        if len(spark.streams.active) == 2 and all(q.lastProgress for q in spark.streams.active):
            break
        time.sleep(0.2)
    assert not ended.is_set()
    for query in spark.streams.active:
        query.processAllAvailable()
    spark.streams.active[0].stop()
    assert ended.wait(30)
    for query in spark.streams.active:
        query.stop()
    spark.streams.resetTerminated()
    assert values(read_bronze(spark, f"{root}/t/bronze"), "id") == [("a",), ("b",)]
