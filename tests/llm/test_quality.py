import collections
import itertools
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from feedlake.llm import quality
from tests.conftest import SF
from tests.llm.fixtures import documents, odd_rows, plain, words


def base(text):
    found = re.findall("[^\x20\x09-\x0d]+", text)
    windows = collections.Counter(zip(found, found[1:], found[2:]))
    inside = set()
    for i in range(len(found) - 2):
        if windows[tuple(found[i : i + 3])] > 1:
            inside |= {i, i + 1, i + 2}
    seen, repeats = set(), 0
    for line in text.split("\n"):
        if re.search("[^\x20\x09-\x0d]", line):
            repeats += line in seen
            seen.add(line)
    failed = len(found) < 50 or 100 * len(inside) > 50 * len(found)
    return len(found), sum(map(len, found)), len(re.findall(r"[#*$%&|<>]", text)), repeats, len(inside), failed


@given(st.text(alphabet="ab |#é\x0b\n \t\u00a0\U0001f600", max_size=120))
@settings(max_examples=200, deadline=None)
def test_base_counts(text):
    assert quality.judge(text, quality.prior_field(), quality.Numbers())[:6] == base(text)


def test_words_beyond_the_packed_range(monkeypatch):
    text = words(random.Random(1), 300, 20)
    numbers = quality.Numbers()
    numbers.update({f"other{i}".encode(): i for i in range(1 << 21)})
    monkeypatch.setattr(quality, "VOCABULARY", 1 << 22)
    assert quality.repeated_words(text.encode().split(), numbers) == base(text)[4]


@pytest.mark.parametrize("seed", range(20))
def test_viterbi_is_the_best_labelling(seed):
    rng = np.random.default_rng(seed)
    field = quality.Field(rng.normal(size=8) * 2, rng.normal(size=(2, 2)))
    features = rng.random((rng.integers(1, 8), 7))
    odds = features @ field.emission[1:] + field.emission[0]

    def score(labels):
        inner = sum(field.transition[a, b] for a, b in zip(labels, labels[1:]))
        return inner + sum(o for o, label in zip(odds, labels) if label)

    best = max(itertools.product((0, 1), repeat=len(odds)), key=score)
    assert score(tuple(quality.viterbi(field, features))) == pytest.approx(score(best))


def test_junk_lines_among_content():
    good = [words(random.Random(k), 30, 5000).capitalize() + "." for k in range(6)]
    junk = ["Home | About | Login | Help | Terms | More | Next | Top"] * 1 + ["### $$$ %%% &&& ### 12 ### 99"]
    rows, _, _ = quality.line_features("\n".join([*good[:3], *junk, *good[3:]]).encode())
    assert list(quality.viterbi(quality.prior_field(), rows)) == [0, 0, 0, 1, 1, 0, 0, 0]


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    field = quality.fit(docs, labels.filter("doc_id % 2 = 0"))
    held = labels.filter("doc_id % 2 = 1").join(quality.judged(docs, field), "doc_id").filter("NOT base_failed").collect()
    right = sum(row["kept"] == (row["quality"] == 1) for row in held)
    assert len(held) > 100 and right >= 0.97 * len(held)
    assert all(row["kept"] for row in held if row["quality"] == 1)


def test_without_labels_the_prior_holds(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    for field in (quality.fit(docs, None), quality.fit(docs, labels.filter("quality > 5"))):
        assert np.array_equal(field.emission, quality.PRIOR)
    found = labels.join(quality.judged(docs, quality.prior_field()), "doc_id").filter("NOT base_failed").collect()
    assert sum(row["kept"] == (row["quality"] == 1) for row in found) >= 0.95 * len(found)


def test_odd_rows(spark):
    rows = odd_rows()
    docs = documents(spark, *rows)
    labels = spark.createDataFrame([(4, 1, 0), (4, 1, 0), (None, 0, 0), (6, None, 1)], "doc_id long, quality int, toxic int")
    found = quality.judged(docs, quality.fit(docs, labels)).collect()
    assert len(found) == len(rows)
    for (doc, text), row in zip(sorted(rows, key=repr), sorted(found, key=lambda r: repr((r["doc_id"], next(t for d, t in rows if d == r["doc_id"]))))):
        assert row["doc_id"] == doc
    expected = sorted((d, *base(t or "")) for d, t in rows if d is not None)
    assert sorted(tuple(r)[:7] for r in found if r["doc_id"] is not None) == expected
    kept = quality.kept_documents(plain(spark, *rows), quality.prior_field())
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 4, 5, 6, 6, 8]


def test_empty_tables(spark):
    docs = plain(spark, (1, "a")).filter("doc_id > 1")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.judged(docs, quality.fit(docs, labels)).count() == 0
    assert quality.kept_documents(docs, quality.prior_field()).count() == 0


def test_an_id_in_very_many_rows(spark, monkeypatch):
    """Labelled ids that occur again and again: equal rows count once, and the sample stays bounded."""
    monkeypatch.setattr(quality, "SAMPLE_DOCS", 50)
    rng = random.Random(4)
    rows = [(1, words(rng, 30)) for _ in range(300)] + [(2, "same text\nand more")] * 300 + [(3, "x")]
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (3, 0, 0)], "doc_id long, quality int, toxic int")
    found = quality._sampled(documents(spark, *rows), labels).collect()
    assert len(found) == 50 and sum(r["doc_id"] == 2 for r in found) <= 1
    every = quality.fit(documents(spark, *rows), labels)
    again = quality.fit(documents(spark, *rows[::-1]).repartition(5), labels)
    assert (every.emission == again.emission).all()
