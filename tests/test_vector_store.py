import os

from pyspark.sql import functions as F

from feedlake.operators.tables import read_batches
from feedlake.plans.index import collection, index_articles
from feedlake.plans.silver import silver
from feedlake.plans.vector_store import VectorStore
from tests.helpers import event, events, values

ROWS = "k long, text string, vector_of string"


def rows(spark, *texts):
    return spark.createDataFrame([(k, t, "x") for k, t in enumerate(texts)], ROWS)


def counting_store(root, name="m"):
    """A store whose model notes what it is asked for in a file."""
    log = f"{root}/asked-{name}"

    def model(texts):
        with open(log, "a") as out:
            out.write("".join(t + "\n" for t in texts))
        return [[float(len(t)), float(t.count("a"))] for t in texts]

    def asked():
        if not os.path.exists(log):
            return []
        with open(log) as lines:
            return sorted(line.rstrip("\n") for line in lines)

    return VectorStore(f"{root}/store", name, 2, model), asked


def want(*texts):
    return sorted(((k, None if t is None else [float(len(t)), float(t.count("a"))]) for k, t in enumerate(texts)), key=repr)


def test_only_new_texts_reach_the_model(spark, root):
    store, asked = counting_store(root)
    first, second = ["a", "bb", "a", None, ""], ["bb", "ccc", "a", "ccc", None, "dada"]
    got = store.embedded(rows(spark, *first), F.col("text"), 0)
    assert values(got, "k", "vector") == want(*first) and asked() == ["", "a", "bb"]
    assert got.columns == ["k", "text", "vector_of", "vector"]
    got = store.embedded(rows(spark, *second), F.col("text"), 1)
    assert values(got, "k", "vector") == want(*second) and asked() == ["", "a", "bb", "ccc", "dada"]
    assert store.add(rows(spark, *first, *second), 2) == 0 and len(asked()) == 5


def test_a_batch_that_is_run_again(spark, root):
    store, asked = counting_store(root)
    store.add(rows(spark, "a", "b"), 0)
    for _ in range(2):
        assert store.add(rows(spark, "b", "c"), 1) == 1
    assert asked() == ["a", "b", "c", "c"]
    assert read_batches(spark, store.path, store.stored(spark).drop("batch_id").schema).count() == 3


def test_models_do_not_mix(spark, root):
    one, asked_one = counting_store(root, "one")
    two, asked_two = counting_store(root, "two")
    for store in (one, two):
        store.add(rows(spark, "a"), 0)
    assert asked_one() == asked_two() == ["a"]


def test_hot_texts(spark, root):
    """Most rows share a text: the model gets it once, and the rows are spread beyond a broadcast."""
    store, asked = counting_store(root)
    texts = ["same"] * 300 + [f"t{n}" for n in range(50)]
    got = store.embedded(rows(spark, *texts).repartition(6), F.col("text"), 0)
    assert values(got, "k", "vector") == want(*texts) and len(asked()) == 51


def test_nothing_to_embed(spark, root):
    store, asked = counting_store(root)
    assert store.embedded(rows(spark, "a").limit(0), F.col("text"), 0).count() == 0
    assert store.embedded(rows(spark, None), F.col("text"), 1).collect()[0]["vector"] is None and asked() == []


def test_index_through_the_store(spark, root):
    store, asked = counting_store(root)
    articles = silver(events(spark, event("00000000000000aa", title="t"), event("00000000000000bb", title="u")))
    for n in range(2):
        assert index_articles(articles, f"{root}/points", n, 2, embed=lambda df, text, n=n: store.embedded(df, text, n)) == 2
    assert asked() == ["t", "text", "text", "u"]  # two texts of two lines
    assert values(collection(spark, f"{root}/points"), "payload.title", "vector") == [("t", [6.0, 0.0]), ("u", [6.0, 0.0])]
