import hashlib
import math
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from feedlake.functions import ids, text, times, vector
from feedlake.schema import EMBED_DIM, STOP_WORDS
from tests.helpers import at


def one(spark, column, **values):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]).select(column.alias("out"))
    return row.first()["out"]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet=" \t\n\x0b\x1c\x85\xa0 　​aé가", max_size=12), min_size=1, max_size=30))
def test_strip_cuts_what_python_cuts(spark, samples):
    rows = spark.createDataFrame([(s,) for s in samples], "t string").select("t", text.strip(F.col("t")).alias("s"))
    assert all(r["s"] == r["t"].strip() for r in rows.collect())


@pytest.mark.parametrize(
    "raw, clean",
    [
        ("a<br>b", "ab"),
        ("open <d rest", "open <d rest"),
        ("x &amp; y", "x &amp; y"),
        ("a<p\nclass='x'>b", "ab"),
        ("  a \t\n b\x0bc  ", "a b c"),
        ("\xa0a　", "\xa0a　"),
        ("<>", "<>"),
        (None, ""),
    ],
)
def test_plain_body(spark, raw, clean):
    assert one(spark, text.plain_body(F.col("t").cast("string")), t=raw) == clean


def test_first_filled(spark):
    rows = spark.createDataFrame([("a", "b"), ("", "b"), (None, "b"), ("", None), (None, "")], "x string, y string")
    assert [r[0] for r in rows.select(text.first_filled(F.col("x"), F.col("y"))).collect()] == ["a", "b", "b", "", ""]


def test_words_of_a_korean_title(spark):
    words = one(spark, text.title_words(F.col("t")), t=" 삼성전자, 3분기 - (속보) A·I\xa0x 그")
    assert words == ["", "삼성전자", "3분기", "속보", "AIx", "그"]


@settings(max_examples=10, deadline=None)
@given(st.lists(st.text(alphabet=" \t\n\x0b\xa0　-.a1가é", max_size=15), min_size=1, max_size=20))
def test_words_equal_pieces_cleaned_one_by_one(spark, samples):
    rows = spark.createDataFrame([(s,) for s in samples], "t string").select("t", text.title_words(F.col("t")).alias("w"))
    for row in rows.collect():
        pieces = [re.sub("[^가-힣A-Za-z0-9]", "", p) for p in re.split("[ \t\n\x0b\f\r]+", row["t"])]
        assert [w for w in row["w"] if w] == [p for p in pieces if p]


def test_embed_text(spark):
    assert one(spark, text.embed_text(F.col("a"), F.col("b")), a=" t", b="body　") == "t\nbody"
    assert one(spark, text.embed_text(F.col("a"), F.lit(None).cast("string")), a="t") == "t"


def test_link_and_point_ids(spark):
    link = "https://뉴스.example/1"
    want = hashlib.sha256(link.encode()).hexdigest()[:16]
    assert one(spark, ids.link_id(F.col("l")), l=link) == want
    for article in (want, "0000000000000000", "7fffffffffffffff", "8000000000000000", "ffffffffffffffff"):
        point = ids.point_id(F.col("a"))
        assert int(one(spark, point, a=article)) == int(article, 16)
        assert int(one(spark, ids.long_to_point(ids.point_to_long(point)), a=article)) == int(article, 16)


def test_point_longs_keep_the_order(spark):
    hexes = ["0000000000000000", "0000000000000001", "7fffffffffffffff", "8000000000000000", "ffffffffffffffff"]
    rows = spark.createDataFrame([(h,) for h in hexes], "h string")
    longs = [r[0] for r in rows.select(ids.point_to_long(ids.point_id(F.col("h")))).collect()]
    assert longs == sorted(longs) and len(set(longs)) == 5


@pytest.mark.parametrize(
    "raw, plain, with_pattern",
    [
        ("2025-11-03T10:00:00+09:00", "2025-11-03 01:00:00", "2025-11-03 01:00:00"),
        ("2025-11-03 10:00:00", "2025-11-03 10:00:00", "2025-11-03 10:00:00"),
        ("Mon, 03 Nov 2025 10:00:00 +0900", None, "2025-11-03 01:00:00"),
        ("03 Nov 2025 10:00:00 +0000", None, "2025-11-03 10:00:00"),
        ("", None, None),
        ("soon", None, None),
        (None, None, None),
    ],
)
def test_parsed_times(spark, raw, plain, with_pattern):
    for rfc822, want in ((False, plain), (True, with_pattern)):
        got = one(spark, times.parsed(F.col("r").cast("string"), rfc822).cast("string"), r=raw)
        assert got == want


def test_missing_time_falls_back_to_arrival(spark):
    rows = spark.createDataFrame([("junk", at("2025-11-03 10:00:00"))], "r string, k timestamp")
    shown = rows.select(times.published_at(F.col("r"), F.col("k")).cast("string")).first()[0]
    assert shown == "2025-11-03 10:00:00"


def expected_vector(value, dim=EMBED_DIM):
    raw = [b / 255 - 0.5 for b in hashlib.sha256(value.encode()).digest()] * (dim // 32)
    size = math.sqrt(sum(x * x for x in raw))
    return [x / size for x in raw]


@settings(max_examples=10, deadline=None)
@given(st.lists(st.text(max_size=30), min_size=1, max_size=10))
def test_hash_embedding(spark, samples):
    rows = spark.createDataFrame([(s,) for s in samples], "t string")
    for row in rows.select("t", vector.hash_embedding(F.col("t")).alias("v")).collect():
        assert len(row["v"]) == EMBED_DIM
        assert row["v"] == pytest.approx(expected_vector(row["t"]), abs=1e-12)
        assert math.fsum(x * x for x in row["v"]) == pytest.approx(1.0)


def test_known_digest_byte(spark):
    row = spark.range(1).select(vector.hash_embedding(F.lit("abc"), 32).alias("v")).first()["v"]
    raw = [b / 255 - 0.5 for b in hashlib.sha256(b"abc").digest()]
    assert raw[0] == pytest.approx(0.2294117647)
    assert row[0] / row[1] == pytest.approx(raw[0] / raw[1])


def test_stop_words_are_the_eighteen():
    assert len(STOP_WORDS) == 18 and len(set(STOP_WORDS)) == 18
