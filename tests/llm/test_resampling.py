import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from feedlake.llm import resampling
from feedlake.llm.queries import queries
from tests.conftest import SMALL
from tests.llm.fixtures import documents, odd_rows, plain, words

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def feature_list(text, longest):
    found = WORDS.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return len(found), [" ".join(found[i : i + n]) for n in range(1, longest + 1) for i in range(len(found) - n + 1)]


def brute(docs, target, longest=1, buckets=10000, least=20, percent=10):
    """(doc_id, n_features, weight, score, rank) in plain Python."""
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    made = [(doc, *feature_list(text, longest)) for doc, text in docs]
    s = Counter(bucket(f) for _, _, found in made for f in found)
    t = Counter(bucket(f) for text in target for f in feature_list(text, longest)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets))))
    rows = []
    for doc, n_words, found in made:
        h = int(hashlib.sha256(f"2024:{'null' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        weight = sum(gain(bucket(f)) for f in found)
        rows.append((doc, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n_words))
    able = sorted((r for r in rows if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    ranks = Counter()
    drawn = [(*r[:4], k + 1) for k, r in enumerate(able[: percent * len(able) // 100])]
    rest = Counter(r[:4] for r in rows)
    rest.subtract(r[:4] for r in drawn)
    ranks.update(drawn)
    ranks.update({(*r, None): n for r, n in rest.items() if n})
    return ranks


def got(df):
    return Counter(map(tuple, df.select("doc_id", "n_features", "weight", "score", "rank").collect()))


def corpus(seed, n):
    rng = random.Random(seed)
    return [(k, words(rng, rng.randrange(5, 90), 300)) for k in range(n)], [words(rng, 30, 60) for _ in range(20)]


def target_table(spark, texts):
    return spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "item_id long, text string")


@pytest.mark.parametrize("longest,buckets,percent", [(1, 10000, 10), (2, 50, 40), (3, 40_000, 100)])
def test_against_brute_force(spark, longest, buckets, percent):
    docs, texts = corpus(longest, 400)
    found = resampling.resampled(
        plain(spark, *docs).repartition(5), target_table(spark, texts), percent, longest=longest, buckets=buckets, radix_bits=6, block_rows=32
    )
    assert got(found) == brute(docs, texts, longest, buckets, percent=percent)


def test_query(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    texts = [r["text"] for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    assert got(queries()["op11_importance_resampling"](spark, SMALL)) == brute(docs, texts)


def test_words():
    text = "Ab-C9 É été_x\x00\x7f中文 [z]{~}ÀB"
    assert [w.decode() for w in resampling.words(text)] == feature_list(text, 1)[1]
    every = "a".join(map(chr, [*range(0x3000), 0x1F600]))
    assert [w.decode() for w in resampling.words(every)] == feature_list(every, 1)[1]


@pytest.mark.parametrize("hot", [False, True])
@pytest.mark.parametrize("radix_bits,block_rows", [(1, 7), (4, 50), (11, 16_384)])
def test_radix_sort(spark, hot, radix_bits, block_rows):
    """Keys over the whole range of longs, ties, and a key that most rows share; equal keys keep their order."""
    rng = random.Random(radix_bits)
    sides = [-(1 << 63), (1 << 63) - 1] if radix_bits > 1 else [-3, 4]
    a = [5 if hot and rng.random() < 0.7 else rng.choice([*sides, 0, 1, 2, rng.randrange(-3, 4)]) for _ in range(300)]
    b = [rng.randrange(3) for _ in a]
    df = spark.createDataFrame(list(zip(range(300), a, b, strict=True)), "k long, a long, b long").repartition(3)
    stored = df.coalesce(1).sortWithinPartitions("k").select("*", F.monotonically_increasing_id().alias("_row"))
    keys = [resampling.SortKey("a", min(a), max(a), True), resampling.SortKey("b", 0, 2)]
    found = {r["_row"]: r["rank"] for r in resampling.radix_ranked(stored, keys, 300, radix_bits, block_rows).collect()}
    order = sorted(range(300), key=lambda k: (-a[k], b[k], k))
    assert [found[k] for k in order] == list(range(1, 301))


def test_equal_keys(spark):
    rows = spark.range(50).select(F.col("id").alias("_row"), F.lit(4).cast("long").alias("a"))
    ranks = resampling.radix_ranked(rows, [resampling.SortKey("a", 4, 4)], 50).collect()
    assert sorted(r["rank"] for r in ranks) == list(range(1, 51))


def test_hot_keys_fill_blocks_evenly(spark):
    """A score that all rows share: no group of a pass holds more than a block."""
    rows = spark.range(1000, numPartitions=1).select(F.col("id").alias("_row"), F.lit(4).cast("long").alias("a"))
    sizes = []
    again = resampling._pass
    try:
        resampling._pass = lambda state, *more: sizes.append(max(r["count"] for r in state.groupBy("_block").count().collect())) or again(state, *more)
        resampling.radix_ranked(rows, [resampling.SortKey("a", 0, 255)], 1000, 4, 64).count()
    finally:
        resampling._pass = again
    assert sizes == [64, 64]


def test_odd_rows(spark):
    rows = odd_rows()
    texts = [rows[3][1], None, ""]
    found = resampling.resampled(documents(spark, *rows), target_table(spark, texts), 100, least_words=1)
    assert got(found) == brute(rows, texts, least=1, percent=100)
    assert found.columns == ["doc_id", "n_features", "weight", "score", "rank"]


def test_empty_tables(spark):
    docs, texts = corpus(3, 30)
    table, target = plain(spark, *docs), target_table(spark, texts)
    assert resampling.resampled(table.limit(0), target).count() == 0
    assert got(resampling.resampled(table, target.limit(0))) == brute(docs, [])
    assert got(resampling.resampled(table, target, least_words=1000)) == brute(docs, texts, least=1000)
