"""One set of very long odd texts through all operators that read texts or pages."""

import time

import pytest

from feedlake.llm import bpe, decontam, lineblocks, linedup, packing, quality, resampling, secret_scan, simhash, surrogates, urlrules
from feedlake.llm.queries import TOKENIZER, URL_RULES
from tests.llm.fixtures import plain

SECONDS = 60
TEXTS = {
    "spaces": " " * 1_000_000,
    "lines": "\n" * 1_000_000,
    "links": "<a " * 330_000,
    "cells": "<tr><td>x" * 110_000,
    "dots": "a." * 500_000,
    "mixed": "-+" * 500_000,
    "mixed run": "Zk3Qp9LmT4vXc7RbN2sW+" * 25_000 + "-" * 500_000,
    "capitals": "Keller Huber " * 77_000,
    "labels": "x@" + "a." * 5_000 + "com",
    "one word": "a" * 1_000_000,
    "one line": "word " * 200_000,
    "quotes": "<a href=\"x>y</a>" * 60_000,
}


@pytest.fixture(scope="module")
def docs(spark):
    return plain(spark, *enumerate(TEXTS.values()))


def benchmark(spark):
    return spark.createDataFrame([(1, "what is the capital of this country and of that one said the old man")], "item_id long, text string")


def labels(spark):
    return spark.createDataFrame([(0, 1, 0), (5, 0, 0), (7, 1, 0)], "doc_id long, quality int, toxic int")


OPERATORS = {
    "packing": lambda spark, docs: packing.pack_documents(docs, **TOKENIZER()).filter("piece = 0"),
    "surrogates": lambda spark, docs: surrogates.pseudonymized(docs, "k"),
    "secrets": lambda spark, docs: secret_scan.scanned(docs),
    "decontamination": lambda spark, docs: decontam.clean(docs, benchmark(spark)),
    "near-duplicates": lambda spark, docs: simhash.near_duplicates(docs),
    "lines": lambda spark, docs: linedup.without_copies(docs),
    "quality": lambda spark, docs: quality.judged(docs, quality.fit(docs, labels(spark))),
    "pages": lambda spark, docs: lineblocks.extracted(docs.selectExpr("doc_id AS page_id", "'u' AS url", "text AS html")),
    "rules": lambda spark, docs: urlrules.judged(docs.selectExpr("doc_id AS page_id", "concat('http://', text) AS url"), urlrules.rule_table(spark, URL_RULES)),
    "resampling": lambda spark, docs: resampling.resampled(docs, benchmark(spark)),
    "encoding": lambda spark, docs: bpe.digested(docs, TOKENIZER()["tokenizer_path"]),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_no_text_ends_a_query(spark, docs, name):
    began = time.time()
    rows = OPERATORS[name](spark, docs).count()
    OPERATORS[name](spark, docs).write.format("noop").mode("overwrite").save()
    assert rows == len(TEXTS)
    assert time.time() - began < 2 * SECONDS


def test_packing_counts_as_the_tokenizer_does(spark, docs):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(TOKENIZER()["tokenizer_path"])
    want = {k: len(library.encode(t, add_special_tokens=False).ids) + 1 for k, t in enumerate(TEXTS.values())}
    got = {r["doc_id"]: r["n"] for r in packing.token_pieces(docs, **TOKENIZER()).groupBy("doc_id").agg({"length": "sum"}).toDF("doc_id", "n").collect()}
    assert got == want
