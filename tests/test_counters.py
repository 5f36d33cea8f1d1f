import datetime as dt
import random

from feedlake.plans.ingest import poll_counters
from feedlake.sources.messages import message_file_stream, publish_files, to_messages
from feedlake.streaming.counters import closed_days, read_counters, start_counters
from tests.helpers import event, events, values


def run(spark, root, rows, delay="1 minute"):
    publish_files(to_messages(events(spark, *rows), "kafka_ts"), f"{root}/inbox")
    query = start_counters(message_file_stream(spark, f"{root}/inbox"), f"{root}/t", delay, availableNow=True)
    query.awaitTermination()
    return query


def stamp(minutes):
    return (dt.datetime(2025, 11, 3, 22) + dt.timedelta(minutes=minutes)).strftime("%Y-%m-%d %H:%M:%S")


def test_three_drops_equal_the_batch_job(spark, root):
    rng = random.Random(1)
    rows = [event(f"id{n}", arrived=stamp(rng.random() * 3000)) for n in range(400)]
    rows.sort(key=lambda row: row[7])
    for part in (rows[:150], rows[150:151], rows[151:]):
        run(spark, root, part)
    run(spark, root, [event(None, arrived=stamp(6000))])
    want = poll_counters(events(spark, *rows), "kafka_ts")
    columns = ["poll_at", "published_count", "seen_total"]
    assert values(read_counters(spark, f"{root}/t"), *columns) == values(want, *columns)
    days = {}
    for row in rows:
        days[row[7].date()] = days.get(row[7].date(), 0) + 1
    assert dict(values(closed_days(spark, f"{root}/t"), "day", "published_count")) == days


def test_open_polls_wait_and_late_events_are_dropped(spark, root):
    run(spark, root, [event("a", arrived="2025-11-03 10:00:10"), event("b", arrived="2025-11-03 10:05:00")], "2 minutes")
    table = f"{root}/t"
    assert [r["published_count"] for r in read_counters(spark, table).collect()] == [1]
    late = run(spark, root, [event("late", arrived="2025-11-03 10:00:20"), event("c", arrived="2025-11-03 10:04:00")], "2 minutes")
    assert sum(s["numRowsDroppedByWatermark"] for p in late.recentProgress for s in p["stateOperators"]) == 1
    run(spark, root, [event(None, arrived="2025-11-03 10:20:00")], "2 minutes")
    rows = read_counters(spark, table).orderBy("poll_at").collect()
    assert [(r["poll_at"].minute, r["published_count"], r["seen_total"]) for r in rows] == [(0, 1, 1), (4, 1, 2), (5, 1, 3)]
    assert closed_days(spark, table).count() == 0


def test_closed_days_leave_no_state(spark, root):
    run(spark, root, [event("a"), event("b", arrived="2025-11-04 10:00:00")])
    last = run(spark, root, [event(None, arrived="2025-11-06 10:00:00")])
    states = {s["operatorName"]: s["numRowsTotal"] for s in last.recentProgress[-1]["stateOperators"]}
    assert states["transformWithStateInPySparkExec"] == 0 and closed_days(spark, f"{root}/t").count() == 2


def test_nothing_stored(spark, root):
    assert read_counters(spark, root).count() == 0 and closed_days(spark, root).count() == 0
