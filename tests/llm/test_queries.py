"""Every registered query of the folder, and the pipeline."""

import pytest

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from check import compare, connect
from feedlake.llm import decontam, linedup, quality, simhash
from feedlake.llm.oracle import oracle_sql as llm_sql
from feedlake.llm.queries import queries as llm_queries
from tests.conftest import SF, SMALL

COLUMNS = {
    "op1": ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
    "op3": ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
    "op5": ["doc_id", "fingerprint", "component_id"],
    "op8": ["page_id", "host", "path", "rule", "verdict"],
    "op9": ["page_id", "url", "text", "n_chars"],
    "op10": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
    "op11": ["doc_id", "n_features", "weight", "score", "rank"],
    "op12": ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
    "op13": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
}


def test_one_query_per_operator():
    assert sorted(int(name.split("_")[0][2:]) for name in llm_queries()) == list(range(1, 14))
    assert set(llm_queries()) | {"pipeline"} <= set(queries())
    assert set(llm_sql()) <= set(oracle_sql()) & set(llm_queries())


@pytest.mark.parametrize("name", list(llm_queries()))
def test_query_runs_over_its_table(spark, name):
    frame = llm_queries()[name](spark, SMALL)
    wanted = COLUMNS.get(name.split("_")[0], [])
    assert frame.columns[: len(wanted)] == wanted or set(wanted) <= set(frame.columns)
    rows = frame.collect()
    keys = {row[0] for row in rows}
    if name.split("_")[0] in ("op1", "op2", "op3", "op5", "op6", "op10", "op11", "op13"):
        assert keys == {r[0] for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id").collect()}
    elif name.split("_")[0] in ("op8", "op9"):
        assert keys == {r[0] for r in spark.read.parquet(f"{SMALL}/pages.parquet").select("page_id").collect()}


@pytest.mark.parametrize("name", list(llm_sql()))
def test_query_against_sql(spark, name):
    equal, rows, detail = compare(spark, connect(SF), name, SF)
    assert equal, detail
    assert rows > 0


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns = docs.columns
    sizes = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = stage(spark, docs, SMALL)
        assert docs.columns == columns, name
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        sizes.append(docs.count())
        assert {r["doc_id"] for r in docs.collect()} <= {r["doc_id"] for r in before.collect()}
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] > 0
    # Nothing that a stage decides on is left for it to decide.
    benchmark = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    assert decontam.contaminated(docs, benchmark).count() == 0
    found = simhash.near_duplicates(docs)
    assert found.select("component_id").distinct().count() == docs.count()
    assert linedup.later_copies(docs).count() == 0
    packed = corpus_pipeline.run(spark, SMALL).collect()
    assert {r["doc_id"] for r in packed} == {r["doc_id"] for r in docs.collect()}
    assert len({(r["sequence_id"], r["offset"]) for r in packed}) == len(packed)


def test_quality_stage_keeps_clean_documents(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = {r["doc_id"] for r in corpus_pipeline.quality_rules(spark, docs, SF).select("doc_id").collect()}
    good = {r["doc_id"] for r in quality.judged(docs, quality.prior_field()).filter("NOT base_failed").join(labels.filter("quality = 1"), "doc_id").collect()}
    assert good <= kept
