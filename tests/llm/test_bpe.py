import hashlib
import json
import random

import numpy as np
import public_tokenizers as public
import pytest
from tokenizers import Tokenizer

from feedlake.llm import bpe
from feedlake.llm.queries import TOKENIZER, queries
from tests.conftest import SMALL
from tests.llm.fixtures import documents, odd_rows, plain, words

PATH = str(public.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.vocabulary(PATH)


def ids_of(vocabulary, *texts):
    return [ids.tolist() for ids in bpe.Encoder(vocabulary)(texts)]


def expected(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_random_texts(library, vocabulary):
    rng = random.Random(3)
    letters = "aab  \n\té中文😀'sthe1x<|>endoftext_--== \x1c\x85"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(40))) for _ in range(3000)]
    texts += ["".join(chr(rng.choice([rng.randrange(1, 0x3000), rng.randrange(1, 0xD800), rng.randrange(0xE000, 0x110000)])) for _ in range(30)) for _ in range(600)]
    texts += [f"{t}<|endoftext|>{t}" for t in texts[:300]]
    got = ids_of(vocabulary, *texts)
    assert got == [expected(library, t) for t in texts]
    assert [vocabulary.decode(np.array(ids, np.int64)) for ids in got] == texts


def test_all_pairs_of_some_tokens(library, vocabulary):
    """The check of a border against merging the bytes of both tokens."""
    rng = random.Random(4)
    tokens = [t for t in range(vocabulary.size) if vocabulary.usable[t] and len(vocabulary.bytes_of[t]) > 1]
    a, b = (np.array([rng.choice(tokens) for _ in range(8000)]) for _ in "ab")
    fine = vocabulary.compatible(a, b)
    exact = [vocabulary.merged(vocabulary.bytes_of[x] + vocabulary.bytes_of[y]) == [x, y] for x, y in zip(a, b, strict=True)]
    assert fine.tolist() == exact and 0 < fine.sum() < len(fine)


def test_tokens_that_their_bytes_do_not_give(vocabulary):
    merged = [t for t in range(vocabulary.size) if vocabulary.rank[t] >= 0]
    for token in random.Random(5).sample(merged, 4000) + [t for t in merged if not vocabulary.usable[t]]:
        assert vocabulary.usable[token] == (vocabulary.merged(vocabulary.bytes_of[token]) == [token])


def test_only_failing_words_are_merged(vocabulary, monkeypatch):
    redone = []
    exact = bpe.Vocabulary.merged_together
    monkeypatch.setattr(bpe.Vocabulary, "merged_together", lambda self, raw: redone.extend(raw) or exact(self, raw))
    text = "The people of the city have been there for many years and the government said that it would help them."
    ids_of(vocabulary, text)
    assert len(redone) < 3


def test_merging_together_and_one_by_one(vocabulary):
    rng = random.Random(7)
    raw = ["".join(rng.choice("aab theéx") for _ in range(rng.randrange(1, 30))).encode() for _ in range(3000)] + [b"a" * n for n in range(1, 40)]
    tokens, sizes = vocabulary.merged_together(raw)
    ends = np.cumsum(sizes)
    assert [tokens[end - n : end].tolist() for n, end in zip(sizes, ends, strict=True)] == [vocabulary.merged(word) for word in raw]
    assert [len(x) for x in vocabulary.merged_together([])] == [0, 0]


@pytest.mark.parametrize("text", [" " * 1_000_000, "\n" * 1_000_000, "a" * 300_000, "ab" * 150_000, "-+" * 400_000, "x" * 300_000 + " y", "中" * 100_000, "a b" * 400_000])
def test_long_words(library, vocabulary, text):
    assert ids_of(vocabulary, text) == [expected(library, text)]


def test_pieces_of_long_texts(library, vocabulary, monkeypatch):
    monkeypatch.setattr(bpe, "WORDS_AT_ONCE", 7)
    monkeypatch.setattr(bpe, "LONG_CHARS", 50)
    rng = random.Random(6)
    texts = [words(rng, rng.randrange(30)) if n % 4 else "" for n in range(60)]
    got = [ids.tolist() for ids in bpe.Encoder(vocabulary, remembered=20)(texts)]
    assert got == [expected(library, t) for t in texts]


def small_file(path, merges, vocab):
    with open(PATH, encoding="utf-8") as file:
        told = json.load(file)
    told["model"].update(merges=merges, vocab=vocab)
    told["added_tokens"] = []
    with open(path, "w", encoding="utf-8") as file:
        json.dump(told, file)
    return str(path)


def test_merges_that_do_not_grow(tmp_path):
    """Merges out of order, so that borders cannot be judged: everything is merged step by step."""
    letters = list(bpe._byte_letters())
    merges = [["ab", "c"], ["a", "b"], ["b", "c"], ["a", "bc"]]
    vocab = {c: n for n, c in enumerate([*letters, "abc", "ab", "bc"])}
    path = small_file(tmp_path / "t.json", merges, vocab)
    own, library = bpe.Vocabulary(path), Tokenizer.from_file(path)
    assert not own.speculates
    for text in ("abc", "abcabc ab bcabc", "aabbcc"):
        assert ids_of(own, text) == [expected(library, text)]


def test_refused_files(tmp_path):
    with open(PATH, encoding="utf-8") as file:
        told = json.load(file)
    told["normalizer"] = {"type": "Lowercase"}
    path = tmp_path / "t.json"
    path.write_text(json.dumps(told), encoding="utf-8")
    with pytest.raises(ValueError, match="normalizer"):
        bpe.Vocabulary(str(path))


def test_bytes_that_are_no_text(library, vocabulary):
    ids = [447, 247, 50256, 447, 99_999, -5, 220]
    assert vocabulary.decode(np.array(ids)) == library.decode([i for i in ids if 0 <= i < 99_999], skip_special_tokens=False)


def test_odd_rows(spark, library):
    rows = odd_rows()
    docs = documents(spark, *rows)
    want = sorted(((d, expected(library, t)) for d, t in rows), key=repr)
    tokens = bpe.encoded(docs, PATH)
    assert sorted(((r["doc_id"], r["ids"]) for r in tokens.collect()), key=repr) == want
    texts = sorted(((r["doc_id"], r["text"]) for r in bpe.decoded(tokens, PATH).collect()), key=repr)
    assert texts == sorted(((d, t or "") for d, t in rows), key=repr)
    for name in (bpe.encoded, bpe.digested):
        assert name(docs.limit(0), PATH).count() == 0
    assert bpe.decoded(tokens.limit(0), PATH).count() == 0
    nulls = spark.createDataFrame([(1, None), (2, [None, 220])], "doc_id long, ids array<int>")
    assert sorted(map(tuple, bpe.decoded(nulls, PATH).collect())) == [(1, ""), (2, " ")]


def test_query_against_the_library(spark, library):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    want = set()
    for doc, text in docs:
        ids = expected(library, text)
        back = library.decode(ids, skip_special_tokens=False)
        digest = hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in ids)).hexdigest()
        want.add((doc, len(ids), digest, hashlib.sha256(back.encode()).hexdigest()))
    assert {tuple(r) for r in queries()["op13_bpe_round_trip"](spark, SMALL).collect()} == want
    assert TOKENIZER()["tokenizer_path"] == PATH


def test_repeated_and_clashing(spark, library):
    docs = plain(spark, (1, "one two"), (1, "one two"), (1, "other"))
    assert bpe.digested(docs, PATH).groupBy("ids_sha256").count().count() == 2
