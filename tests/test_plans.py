"""What the plans of the registered queries must and must not contain."""

import pytest

from tests.conftest import SMALL
from tests.helpers import plan
from workload.queries import queries

DEDUPED = ["first_seen", "silver_clean", "daily_source", "daily_keyword", "top_keywords", "recent_articles"]
IN_PYTHON = {"knn_topk", "knn_cells", "ann_topk"}
RUN_STREAMS = ("stream_", "both_", "replayed_", "daily_run", "indexed_", "empty_", "live_", "late_", "embed_")


@pytest.mark.parametrize("name", [n for n in queries() if not n.startswith(RUN_STREAMS)])
def test_no_pairs_and_no_row_wise_python(spark, name):
    text = plan(queries()[name](spark, SMALL))
    for operator in ("CartesianProduct", "NestedLoop", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert operator not in text
    assert "MapInArrow" not in text or name in IN_PYTHON


@pytest.mark.parametrize("name", DEDUPED)
def test_one_row_per_key_leaves_each_task(spark, name):
    text = plan(queries()[name](spark, SMALL))
    assert "row_number(), 1, Partial" in text and "SinglePartition" not in text


def test_new_rows_meet_the_published_ids_without_a_shuffle(spark):
    """First arrivals are stored before they are asked for; neither they nor the published ids are shuffled then."""
    text = plan(queries()["new_since_published"](spark, SMALL))
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text and "Window" not in text


@pytest.mark.parametrize("name", ["daily_keyword", "daily_source", "top_keywords"])
def test_marts_do_not_carry_bodies(spark, name):
    frame = queries()[name](spark, SMALL)
    projections = [line for line in plan(frame).splitlines() if "Project [" in line]
    assert not any("summary" in line or "body" in line for line in projections)


def test_only_named_columns_are_read(spark):
    assert "ReadSchema: struct<page_id:bigint,html:string>" in plan(queries()["html_strip"](spark, SMALL))
    assert "ReadSchema: struct<event_id:bigint,props:string>" in plan(queries()["json_props"](spark, SMALL))
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan(queries()["hash_embedding"](spark, SMALL))


def test_heads_are_taken_per_task(spark):
    assert "TakeOrderedAndProject" in plan(queries()["top_sources"](spark, SMALL))
    assert "WindowGroupLimit" in plan(queries()["top_keywords_per_day"](spark, SMALL))


def test_a_named_day_prunes_folders_and_shuffles_no_rows(spark):
    text = plan(queries()["silver_by_name"](spark, SMALL))
    scans = [line for line in text.splitlines() if "FileScan parquet" in line and "title" in line]
    assert scans and all("isnotnull(dt" in line.split("PartitionFilters: [")[1].split("]")[0] for line in scans)
    assert "SortMergeJoin" not in text
