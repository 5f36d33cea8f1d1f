import numpy as np
import pytest
from pyspark.sql import functions as F

from feedlake.operators.knn import knn
from feedlake.plans.index import collection, embedded, index_articles, points, recent, retrieve, search
from feedlake.plans.silver import silver
from tests.helpers import event, events, plan, values

PAIR = "qid long, vector array<double>"
STORED = "vec_id long, vector array<double>"

WAYS = [{}, {"query_bytes": 900}]


def brute(queries, vectors, k):
    out = []
    unit = lambda v: np.array(v) / (np.linalg.norm(v) or 1.0)
    for qid, q in queries:
        scored = sorted((-round(float(unit(q) @ unit(v)), 8) + 0.0, vid) for vid, v in vectors)
        out += [(qid, n, vid, -s + 0.0) for n, (s, vid) in enumerate(scored[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("limits", WAYS)
@pytest.mark.parametrize("k", [1, 6, 500])
def test_against_brute_force(spark, limits, k):
    rng = np.random.default_rng(7)
    hot = rng.normal(size=8).tolist()
    vectors = [(i, hot if i % 3 == 0 else rng.normal(size=8).tolist()) for i in range(-100, 200)]
    vectors.append((1000, [0.0] * 8))
    queries = [(i, rng.normal(size=8).tolist()) for i in range(23)] + [(23, hot)]
    found = knn(spark.createDataFrame(queries, PAIR), spark.createDataFrame(vectors, STORED).repartition(5), k, **limits)
    got = sorted((r["qid"], r["rank"], r["vec_id"], round(r["score"], 8) + 0.0) for r in found.collect())
    want = brute(queries, vectors, k)
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert [g[3] for g in got] == pytest.approx([w[3] for w in want], abs=2e-8)


@pytest.mark.parametrize("limits", WAYS)
def test_empty_sides_and_missing_vectors(spark, limits):
    some = spark.createDataFrame([(1, [1.0, 0.0]), (2, None)], PAIR)
    stored = some.withColumnRenamed("qid", "vec_id")
    assert knn(some.limit(0), stored, 3, **limits).count() == 0
    assert knn(some, stored.limit(0), 3, **limits).count() == 0
    assert values(knn(some, stored, 3, **limits), "qid", "rank", "vec_id") == [(1, 1, 1)]


@pytest.mark.parametrize("cells", [1, 50, 10**6])
def test_blocks_of_any_size_agree(cells, monkeypatch):
    import feedlake.operators.knn as module

    monkeypatch.setattr(module, "_BLOCK_CELLS", cells)
    rng = np.random.default_rng(3)
    queries, vectors = rng.normal(size=(17, 4)), np.repeat(rng.normal(size=(10, 4)), 5, axis=0)
    vectors[7] = np.nan
    ids = rng.permutation(50).astype(np.int64)
    unit = lambda m: m / np.linalg.norm(m, axis=1)[:, None]
    best = module.Best(17, 8)
    for start in range(0, 50, 9):
        part = slice(start, start + 9)
        best.add(unit(queries), unit(vectors)[part], ids[part])
    kept = [n for n in range(50) if n != 7]
    want = brute(list(enumerate(queries)), [(int(ids[n]), vectors[n]) for n in kept], 8)
    got = best.rows(np.arange(17))
    assert sorted((q, v) for q, v in zip(got["qid"], got["vec_id"])) == sorted((q, v) for q, _, v, _ in want)


@pytest.mark.parametrize("bad", ["vectors", "queries"])
def test_vectors_of_another_length_fail(spark, bad):
    pair = spark.createDataFrame([(1, [1.0, 0.0])], PAIR)
    ragged = spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0, 3.0])], PAIR)
    queries, stored = (pair, ragged) if bad == "vectors" else (ragged, pair)
    with pytest.raises(Exception, match="values"):
        knn(queries, stored.withColumnRenamed("qid", "vec_id"), 1).collect()


def test_the_candidates_count_in_the_size_of_a_chunk(spark):
    rows = spark.range(40).select(F.col("id").alias("vec_id"), F.array(F.col("id").cast("double"), F.lit(1.0)).alias("vector"))
    scans = lambda k: plan(knn(rows.withColumnRenamed("vec_id", "qid"), rows, k, query_bytes=4000)).count("MapInArrow")
    assert scans(1) == 1 and scans(100) > 10


def test_all_pairs_never_become_rows(spark):
    rows = spark.range(50).select(F.col("id").alias("vec_id"), F.array(F.col("id").cast("double"), F.lit(1.0)).alias("vector"))
    found = knn(rows.withColumnRenamed("vec_id", "qid"), rows, 3)
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in text and "Cartesian" not in text and "WindowGroupLimit" in text


def articles(spark, *rows):
    return silver(events(spark, *rows))


HEX = ["00000000000000aa", "ffffffffffffffbb", "80000000000000cc"]


def test_index_search_and_payload(spark, root):
    rows = articles(spark, *[event(h, title=f"t{n}", summary="x" * 3000 if n == 1 else None) for n, h in enumerate(HEX)])
    assert index_articles(rows, root, 0) == 3
    stored = collection(spark, root)
    asked = spark.createDataFrame([(1, "t0"), (2, "t1\n" + "x" * 3000)], "qid long, text string")
    hits = retrieve(asked, stored, 2)
    best = {r["qid"]: r for r in hits.filter("rank = 1").collect()}
    assert best[1]["article_id"] == HEX[0] and best[1]["score"] == pytest.approx(1.0)
    assert best[2]["article_id"] == HEX[1] and int(best[2]["point_id"]) == int(HEX[1], 16)
    assert len(best[2]["body"]) == 2000
    assert values(hits, "qid", "rank") == [(1, 1), (1, 2), (2, 1), (2, 2)]
    assert best[1]["published_at"] == "2025-11-03 10:00:00"


def test_indexing_again_replaces(spark, root):
    index_articles(articles(spark, event(HEX[0], title="old"), event(HEX[1])), root, 0)
    for _ in range(2):
        index_articles(articles(spark, event(HEX[0], title="new"), event(HEX[2])), root, 1)
    stored = collection(spark, root)
    assert values(stored, "payload.article_id", "payload.title") == [(HEX[0], "new"), (HEX[2], "title"), (HEX[1], "title")]
    assert stored.select("point_id").distinct().count() == 3


def test_recent_days_only(spark):
    rows = articles(spark, *[event(str(d), published=f"2025-11-{d:02} 12:00:00") for d in range(1, 11)])
    assert [r[0] for r in values(recent(rows, "2025-11-10"), "id")] == ["10", "7", "8", "9"]
    assert recent(rows, "2026-01-01", 1).count() == 0


def test_a_wrong_vector_length_fails(spark):
    rows = articles(spark, event(HEX[0]))
    with pytest.raises(Exception, match="expects 64"):
        points(rows, 64, lambda texts: [[1.0, 2.0] for _ in texts]).collect()


def test_a_given_model_is_called_in_batches(spark):
    rows = spark.range(200).select("id", F.col("id").cast("string").alias("t")).coalesce(1)

    def model(texts):
        return [[float(t), float(len(texts))] for t in texts]

    got = embedded(rows, F.col("t"), "v", 2, model)
    assert got.columns == ["id", "t", "v"]
    out = got.collect()
    assert all(r["v"][0] == r["id"] for r in out)
    assert {r["v"][1] for r in out} == {64.0, 8.0}


def test_payloads_are_not_shuffled_for_few_hits(spark, root):
    index_articles(articles(spark, *[event(h) for h in HEX]), root, 0)
    asked = spark.createDataFrame([(1, "t")], "qid long, text string")
    text = retrieve(asked, collection(spark, root), 2)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_payloads_of_other_buckets_are_not_read(spark, root):
    index_articles(articles(spark, *[event(f"{n:016x}", title=f"t{n}") for n in range(60)]), root, 0)
    asked = spark.createDataFrame([(1, "t7\ntext")], "qid long, text string")
    found = retrieve(asked, collection(spark, root), 1)
    assert values(found, "title") == [("t7",)]
    scans = [line for line in plan(found).splitlines() if "FileScan" in line and "payload" in line]
    assert scans and all("bucket" in line.split("PartitionFilters: [")[1].split("]")[0] for line in scans)


def test_one_dimension_and_one_writer_per_collection(spark, root):
    rows = articles(spark, event(HEX[0]))
    index_articles(rows, root, 0, 64)
    with pytest.raises(ValueError, match="64"):
        index_articles(rows, root, 1, 32)
    with pytest.raises(Exception, match="exists"):
        index_articles(rows, root, 0, 64, replace=False)


def test_a_given_model_sees_a_question_once(spark, root):
    calls = spark.sparkContext.accumulator(0)

    def model(texts):
        calls.add(len(texts))
        return [[1.0, float(len(t))] for t in texts]

    index_articles(articles(spark, *[event(h) for h in HEX]), root, 0, 2, model)
    assert calls.value == 3
    asked = spark.createDataFrame([(1, "t"), (2, "u")], "qid long, text string")
    assert retrieve(asked, collection(spark, root), 2, 2, model).count() == 4
    assert calls.value == 5


def test_search_of_an_empty_collection(spark, root):
    index_articles(articles(spark, event(HEX[0])).limit(0), root, 0)
    asked = spark.createDataFrame([(1, [0.0] * 1536)], PAIR)
    assert search(asked, collection(spark, root), 3).count() == 0
