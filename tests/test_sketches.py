import random

import pytest
from pyspark.sql import functions as F

from feedlake.plans.marts import daily_keyword
from feedlake.plans.silver import silver
from feedlake.plans.sketches import (
    build_sketches,
    candidates,
    combined,
    keyword_sketches,
    read_sketches,
    sketched_keywords,
    sketched_per_day,
    table_size,
)
from tests.helpers import event, events, values


def articles(spark, seed, n=120, words=3000):
    """Titles over three days; a few words are frequent, most are rare."""
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        title = " ".join(f"top{rng.randrange(8)}" if rng.random() < 0.4 else f"w{rng.randrange(words)}" for _ in range(60))
        rows.append(event(f"id{k}", title=title, arrived=f"2025-11-0{3 + k % 3} 10:00:00"))
    return silver(events(spark, *rows))


def exact(rows):
    return {r["token"]: r["n"] for r in daily_keyword(rows).groupBy("token").agg(F.sum("freq").alias("n")).collect()}


def test_table_size():
    assert [table_size(n) for n in (1, 3, 4, 24, 10_000)] == [2, 4, 8, 32, 16384]


@pytest.mark.parametrize("max_items", [48, 100, 10_000])
def test_estimates_are_within_the_bound(spark, root, max_items):
    rows = articles(spark, max_items)
    build_sketches(rows, root, max_items=max_items)
    sketches, counts = read_sketches(spark, root), exact(rows)
    assert sketches.count() == 3
    found = sketched_keywords(sketches, 8, max_items).collect()
    assert all(abs(r["estimate"] - counts[r["token"]]) <= r["bound"] for r in found)
    assert {r["token"] for r in found} == {f"top{n}" for n in range(8)}
    days = {(r["dt"], r["token"]): r["freq"] for r in daily_keyword(rows).collect()}
    for r in sketched_per_day(sketches, 5, max_items).collect():
        assert abs(r["estimate"] - days[r["dt"], r["token"]]) <= r["bound"]


def test_candidates_hold_the_first_tokens(spark):
    rows = articles(spark, 3)
    counts = exact(rows)
    first = sorted(counts, key=lambda t: (-counts[t], t))[:6]
    found = {r["token"] for r in candidates(keyword_sketches(rows, 400), 6, 400).collect()}
    assert set(first) <= found and len(found) < 40
    few = candidates(keyword_sketches(rows.limit(0), 400), 6, 400)
    assert few.count() == 0


def test_a_list_beyond_the_sketch_fails(spark):
    with pytest.raises(Exception, match="too small"):
        candidates(keyword_sketches(articles(spark, 4), 48), 30, 48).count()


def test_one_day_is_replaced(spark, root):
    build_sketches(articles(spark, 5), root)
    later = articles(spark, 6)
    build_sketches(later, root, "2025-11-04")
    day = F.col("dt") == F.to_date(F.lit("2025-11-04"))
    mixed, new = read_sketches(spark, root), keyword_sketches(later)
    assert values(mixed.filter(day), "n") == values(new.filter(day), "n")
    assert values(sketched_per_day(mixed.filter(day)), "token", "estimate") == values(sketched_per_day(new.filter(day)), "token", "estimate")
    assert values(mixed.filter(~day), "n") == values(keyword_sketches(articles(spark, 5)).filter(~day), "n")


def test_combining_in_any_order_counts_alike(spark):
    sketches = keyword_sketches(articles(spark, 7))
    once = {(r["token"], r["estimate"]) for r in sketched_keywords(sketches, 500).collect()}
    again = {(r["token"], r["estimate"]) for r in sketched_keywords(sketches.repartition(3), 500).collect()}
    assert once == again and combined(sketches).first()["n"] == 120 * 60
