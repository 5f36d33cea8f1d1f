import random

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from feedlake.llm import simhash
from tests.llm.fixtures import documents, odd_rows, plain, words


def naive_fingerprint(text, size=3):
    import re

    table = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    tokens = re.findall("[^\x20\x09-\x0d]+", text.translate(table))
    if not tokens:
        return 0
    shingles = [" ".join(tokens[i : i + size]) for i in range(len(tokens) - size + 1)] or [" ".join(tokens)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@given(st.text(alphabet="aBcÄß \t\n\x0b ", max_size=80))
@settings(max_examples=150, deadline=None)
def test_fingerprint(text):
    assert simhash.fingerprint(text) == naive_fingerprint(text)


@given(st.integers(0, 2**64 - 1), st.lists(st.integers(0, 63), max_size=2))
@settings(max_examples=300, deadline=None)
def test_close_fingerprints_share_a_key(value, bits):
    other = value
    for bit in bits:
        other ^= 1 << bit
    row, key = simhash.golay_keys(np.array([value, other], np.uint64).view(np.int64))
    assert set(key[row == 0]) & set(key[row == 1])
    assert max(np.bincount(row)) <= 18


@given(st.integers(0, 2**12 - 1), st.lists(st.integers(0, 22), max_size=3))
@settings(max_examples=200, deadline=None)
def test_golay_decodes_three_errors(index, bits):
    word = np.array([index << 11])
    word = word ^ simhash.remainder(word)
    for bit in set(bits):
        word = word ^ (1 << bit)
    assert simhash.decode(word)[0] == index


def reachable(values, bits=2):
    """Least value reachable from each, by comparing all."""
    values = sorted(set(values))
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for i, a in enumerate(values):
        for b in values[i + 1 :]:
            if ((a ^ b) & (2**64 - 1)).bit_count() <= bits:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {v: find(v) for v in values}


def clustered(seed, centres, members):
    rng = random.Random(seed)
    found = set()
    for _ in range(centres):
        value = rng.getrandbits(64)
        for _ in range(members):
            found.add(value)
            for bit in rng.sample(range(64), rng.randrange(4)):
                value ^= 1 << bit
    return [v - (1 << 64) if v >> 63 else v for v in found]


@pytest.mark.parametrize("paired", [1, 8, 1000])
@pytest.mark.parametrize("bits", [0, 1, 2])
def test_links_and_components(spark, paired, bits):
    values = clustered(paired + bits, 6, 30)
    nodes = spark.createDataFrame([(v,) for v in values], "fp long")
    edges = simhash.links(nodes, bits, paired)
    found = {row["node"]: row["root"] for row in simhash.components(edges).collect()}
    assert {v: found.get(v, v) for v in values} == reachable(values, bits)


def test_components_of_a_chain(spark):
    order = list(range(300))
    random.Random(1).shuffle(order)
    edges = spark.createDataFrame([tuple(sorted(p)) for p in zip(order, order[1:])], "a long, b long")
    assert {(r["node"], r["root"]) for r in simhash.components(edges).collect()} == {(i, 0) for i in range(1, 300)}


def test_odd_rows(spark):
    rows = odd_rows()
    found = simhash.near_duplicates(documents(spark, *rows)).collect()
    assert len(found) == len(rows)
    of = {}
    for row in found:
        of.setdefault(row["doc_id"], set()).add((row["fp"], row["component_id"]))
    assert of[1] == of[2] == of[3] == {(0, 1)}
    assert {c for _, c in of[4] | of[5]} == {4}
    assert {c for _, c in of[6]} == {6}
    for doc, text in rows:
        value = naive_fingerprint(text or "")
        assert (value - (1 << 64) if value >> 63 else value) in {f for f, _ in of[doc]}


@pytest.mark.parametrize("limit", [0, 1 << 30])
def test_one_document_stays(spark, limit):
    docs = plain(spark, *odd_rows())
    kept = simhash.deduplicated(docs, limit_bytes=limit)
    assert kept.columns == docs.columns
    ids = sorted((r["doc_id"] for r in kept.collect()), key=lambda i: (i is not None, i or 0))
    assert ids == [None, None, 1, 4, 6, 7, 8]


def test_near_copies(spark):
    rng = random.Random(3)
    base = words(rng, 600).split()
    rows = []
    for i in range(40):
        copy = list(base)
        copy[rng.randrange(600)] = "changed"
        rows.append((100 - i, " ".join(copy)))
    found = {r["doc_id"]: (r["fp"], r["component_id"]) for r in simhash.near_duplicates(plain(spark, *rows)).collect()}
    roots = reachable([fp for fp, _ in found.values()])
    least = {}
    for doc, (fp, _) in found.items():
        least[roots[fp]] = min(doc, least.get(roots[fp], doc))
    assert all(component == least[roots[fp]] for fp, component in found.values())
    assert len(set(least)) < 40


def test_empty_table(spark):
    docs = plain(spark, (1, "a")).filter("doc_id > 1")
    assert simhash.near_duplicates(docs).count() == 0
    assert simhash.deduplicated(docs).count() == 0
