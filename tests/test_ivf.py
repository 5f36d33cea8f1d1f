import random

import numpy as np
import pytest

from feedlake.operators.ivf import build_index, mean_recall, open_index, recall
from feedlake.operators.knn import knn
from feedlake.plans.index import index_articles, collection, retrieve
from feedlake.plans.silver import silver
from tests.conftest import SF
from tests.helpers import event, events, plan, values
from workload.queries import queries

HIT = ["qid", "rank", "vec_id", "score"]


def clustered(seed, n, dim=8, centres=12, first=0):
    """Vectors around some directions; a third of them around one."""
    rng = np.random.default_rng(seed)
    middle = np.random.default_rng(99).normal(size=(centres, dim))
    which = np.where(rng.random(n) < 1 / 3, 0, rng.integers(0, centres, n))
    return [(first + k, (middle[c] + 0.3 * rng.normal(size=dim)).tolist()) for k, c in enumerate(which)]


def frame(spark, rows, name="vec_id"):
    return spark.createDataFrame(rows, f"{name} long, vector array<double>")


def built(spark, root, rows, **more):
    build_index(frame(spark, rows), root, **more)
    return open_index(spark, root)


def brute(queries, vectors, k):
    unit = lambda v: np.array(v) / (np.linalg.norm(v) or 1)
    out = []
    for qid, q in queries:
        scores = sorted(((-round(float(unit(q) @ unit(v)), 8) + 0.0, i) for i, v in vectors))[:k]
        out += [(qid, rank, i, -s + 0.0) for rank, (s, i) in enumerate(scores, 1)]
    return sorted(out, key=repr)


def test_every_vector_is_in_one_cell(spark, root):
    rows = clustered(1, 900)
    index = built(spark, root, [*rows, (5000, None)], n_cells=15, sample_rows=200)
    assert values(index.vectors, "vec_id") == sorted(((i,) for i, _ in rows), key=repr)
    assert index.counts.sum() == 900 and 1 < len(index.cells) <= 15
    nearest = {i: int(index.cells[np.argmax(index.centres @ v)]) for i, v in rows}
    assert dict(values(index.vectors, "vec_id", "cell")) == nearest


def test_search_reads_the_nearest_cells(spark, root):
    rows, asked = clustered(2, 900), clustered(3, 40)
    index = built(spark, root, rows, n_cells=15)
    found = index.search(frame(spark, asked, "qid"), 5, 2)
    cell = dict(values(index.vectors, "vec_id", "cell"))
    want = []
    for qid, q in asked:
        near = set(index.cells[np.argsort(-(index.centres @ q))[:2]].tolist())
        want += brute([(qid, q)], [r for r in rows if cell[r[0]] in near], 5)
    assert values(found, *HIT) == sorted(want, key=repr)
    shares = index.scanned_share(frame(spark, asked, "qid"), 2)
    assert 0 < shares < 0.6 and index.scanned_share(frame(spark, asked, "qid"), 99) == 1


def test_recall_of_clustered_vectors(spark, root):
    rows, asked = clustered(4, 2000), frame(spark, clustered(5, 60), "qid")
    index = built(spark, root, rows)
    probes = index.calibrated(asked, 6, 0.95)
    found, truth = index.search(asked, 6, probes), knn(asked, frame(spark, rows), 6)
    assert mean_recall(found, truth) >= 0.9 and index.scanned_share(asked, probes) < 0.5
    assert recall(found, truth).count() == 60
    assert mean_recall(index.search(asked, 6, len(index.cells)), truth) == 1


@pytest.mark.parametrize("query_bytes", [64 * 1024 * 1024, 2000])
def test_exact_search_through_cells(spark, root, query_bytes):
    rows, asked = clustered(6, 700), clustered(7, 30)
    index = built(spark, root, rows, n_cells=20)
    got = index.exact(frame(spark, asked, "qid"), 6, 1, query_bytes)
    assert values(got, *HIT) == brute(asked, rows, 6)
    assert values(index.search(frame(spark, asked, "qid"), 6, 99, query_bytes), *HIT) == brute(asked, rows, 6)


def test_only_asked_cells_are_read(spark, root):
    index = built(spark, root, clustered(8, 600), n_cells=12)
    text = plan(index.search(frame(spark, clustered(9, 1), "qid"), 3, 2))
    scan = next(line for line in text.splitlines() if "FileScan" in line)
    listed = scan.split("PartitionFilters: [")[1].split("]")[0]
    assert "cell" in listed and listed.count(",") <= 2 and "Exchange" not in text.split("MapInArrow")[1]


def test_ties_zero_vectors_and_small_tables(spark, root):
    rows = [(k, [1.0, 0.0]) for k in range(9, 0, -1)] + [(20, [0.0, 0.0]), (21, [-1.0, 0.0])]
    index = built(spark, root, rows, n_cells=3)
    asked = frame(spark, [(1, [2.0, 0.0]), (2, [0.0, 0.0]), (3, None)], "qid")
    assert values(index.exact(asked, 3), *HIT) == brute([(1, [2.0, 0.0]), (2, [0.0, 0.0])], rows, 3)
    assert values(index.exact(asked, 50), *HIT) == brute([(1, [2.0, 0.0]), (2, [0.0, 0.0])], rows, 50)
    assert index.search(asked.limit(0), 3, 1).count() == 0 and index.exact(asked.limit(0), 3).count() == 0
    one = built(spark, f"{root}/one", [(4, [0.5, 0.5])])
    assert [r["vec_id"] for r in one.exact(frame(spark, [(1, [1.0, 0.0])], "qid"), 2).collect()] == [4]


def test_empty_table(spark, root):
    index = built(spark, root, [])
    assert index.search(frame(spark, [(1, [1.0])], "qid"), 3, 2).count() == 0


def test_articles_through_cells(spark, root):
    rng = random.Random(1)
    rows = silver(events(spark, *[event(f"{n:016x}", title=f"title {rng.random()}") for n in range(50)]))
    index_articles(rows, f"{root}/points", 0, 64)
    stored = collection(spark, f"{root}/points")
    build_index(stored.select("vec_id", "vector"), f"{root}/cells", 5)
    asked = spark.createDataFrame([(1, "a"), (2, "b")], "qid long, text string")
    index = open_index(spark, f"{root}/cells")
    columns = ["qid", "rank", "point_id", "score", "title"]
    got = retrieve(asked, stored, 4, 64, nearest=lambda q, k: index.exact(q, k))
    assert values(got, *columns) == values(retrieve(asked, stored, 4, 64), *columns)


def test_query(spark):
    rows = queries()["ann_topk"](spark, SF).collect()
    assert len({r["qid"] for r in rows}) == 40 and rows[0]["mean_recall"] >= 0.9 and 0 < rows[0]["scanned_share"] <= 1
    exact = {(r["qid"], r["vec_id"]): r["score"] for r in queries()["knn_topk"](spark, SF).collect()}
    both = [(r["qid"], r["vec_id"]) for r in rows if (r["qid"], r["vec_id"]) in exact]
    assert len(both) / len(exact) == pytest.approx(rows[0]["mean_recall"])
    assert all(r["score"] == exact[r["qid"], r["vec_id"]] for r in rows if (r["qid"], r["vec_id"]) in exact)
    print("recall", rows[0]["mean_recall"], "scanned", rows[0]["scanned_share"])
