import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from feedlake.llm import packing
from feedlake.llm.queries import TOKENIZER
from tests.llm.fixtures import documents, odd_rows, plain


def naive_best_fit(histogram, capacity):
    """Free space of the sequences, one piece after another, the longest first."""
    free = []
    for length in sorted(histogram, reverse=True):
        for _ in range(histogram[length]):
            fitting = [(space, i) for i, space in enumerate(free) if space >= length]
            if fitting:
                free[min(fitting)[1]] -= length
            else:
                free.append(capacity - length)
    return sorted(free)


def placed(histogram, capacity):
    plan, used = packing.best_fit_plan(histogram, capacity), {}
    for length, count in histogram.items():
        for rank in range(count):
            step = np.searchsorted(plan.key, length << 40 | rank, "right") - 1
            index = (length << 40 | rank) - plan.key[step]
            sequence = plan.first_sequence[step] + index // plan.per_sequence[step]
            used.setdefault(int(sequence), []).append((int(plan.offset[step] + index % plan.per_sequence[step] * length), length))
    return used, plan.sequences


def gapless(parts):
    at = 0
    for offset, length in sorted(parts):
        if offset != at:
            return False
        at += length
    return True


@given(st.integers(3, 40).flatmap(lambda c: st.tuples(st.just(c), st.dictionaries(st.integers(1, c), st.integers(1, 30), max_size=c))))
@settings(max_examples=300, deadline=None)
def test_plan_is_best_fit_decreasing(case):
    capacity, histogram = case
    used, sequences = placed(histogram, capacity)
    assert all(map(gapless, used.values()))
    assert sorted(used) == list(range(sequences))
    assert sorted(capacity - sum(n for _, n in parts) for parts in used.values()) == naive_best_fit(histogram, capacity)


def test_plan_size_does_not_follow_the_number_of_pieces():
    rng = random.Random(1)
    histogram = {length: rng.randrange(1, 50) for length in range(1, 2049)}
    small = packing.best_fit_plan(histogram)
    large = packing.best_fit_plan({k: v * 100_000 for k, v in histogram.items()})
    assert len(large.key) < 4 * len(small.key) < 100_000


@pytest.mark.parametrize("tokens", [1, 7, 8, 9, 16, 17, 40])
def test_cuts(tokens):
    parts = packing.cuts(tokens, 8)
    assert sum(n for _, n in parts) == tokens
    assert all(n == 8 for _, n in parts[1:]) and 1 <= parts[0][1] <= 8
    assert [s for s, _ in parts] == [sum(n for _, n in parts[:i]) for i in range(len(parts))]


def reference_ids(text):
    from tokenizers import Tokenizer

    encoder = Tokenizer.from_file(TOKENIZER()["tokenizer_path"])
    return encoder.encode(text or "", add_special_tokens=False).ids + [0]


TEXTS = ["", "a", "Hello  world's\n\n x", "éàü ß  12ab", "日本語 текст 😀", "<|endoftext|> <|x", " \t\n ", "I'll we've DON'T 3.14"]


@pytest.mark.parametrize("text", TEXTS)
def test_ids_are_the_tokenizers(text):
    assert list(packing.Encoder(**TOKENIZER())(text)) + [0] == reference_ids(text)


def test_round_trip(spark):
    rows = [*odd_rows(), *[(100 + i, text) for i, text in enumerate(TEXTS)]]
    pieces = packing.token_pieces(documents(spark, *rows), **TOKENIZER(), keep_ids=True)
    result = packing.packed(pieces)
    found = result.collect()
    whole = {}
    for row in found:
        whole.setdefault(row["sequence_id"], []).append((row["offset"], row["length"]))
        assert row["ids_crc32"] == zlib.crc32(np.array(row["ids"], "<u4").tobytes())
    assert all(map(gapless, whole.values()))
    assert all(sum(n for _, n in parts) <= 2048 for parts in whole.values())
    expected = sorted(tuple(reference_ids(text)) for _, text in rows)
    by_document = {}
    for row in sorted(found, key=lambda r: r["start"]):
        by_document.setdefault(row["doc_id"], {}).setdefault((row["piece"], row["start"]), []).append(row["ids"])
    got = []
    for parts in by_document.values():
        if all(len(v) == len(next(iter(parts.values()))) for v in parts.values()) and len(parts) > 1:
            for k in range(len(next(iter(parts.values())))):
                got.append(tuple(t for v in parts.values() for t in v[k]))
        else:
            got += [tuple(ids) for v in parts.values() for ids in v]
    assert sorted(got) == expected
    sequences = {r["sequence_id"]: r["ids"] for r in packing.sequences(result).collect()}
    for row in found:
        assert sequences[row["sequence_id"]][row["offset"] : row["offset"] + row["length"]] == row["ids"]


def test_hot_length_is_ranked_in_buckets(spark):
    rows = [(i, "same text") for i in range(500)] + [(1000, "other longer text here")]
    pieces = packing.token_pieces(plain(spark, *rows), **TOKENIZER())
    found = packing.packed(pieces, bucket_pieces=10).collect()
    assert len({(r["sequence_id"], r["offset"]) for r in found}) == 501
    assert len({r["sequence_id"] for r in found}) == -(-sum(r["length"] for r in found) // 2048)


def test_empty_table(spark):
    docs = plain(spark, (1, "a")).filter("doc_id > 1")
    assert packing.pack_documents(docs, **TOKENIZER()).count() == 0
