import random

import pytest
from pyspark.sql import functions as F

from feedlake.llm import fixity

PAGES = "page_id long, url string, html string, offset string, file int, node long"


def pages(spark, *rows):
    return spark.createDataFrame([(*row, "o", 1, 2) for row in rows], PAGES)


def sample(n, seed=1):
    rng = random.Random(seed)
    return [(i, f"http://x/{i}", "é<p>" + "x" * rng.randrange(3000)) for i in range(n)]


def test_records_lie_one_after_another(spark):
    rows = fixity.archived(pages(spark, *sample(50)), file_pages=20).orderBy("file", "offset").collect()
    at = {}
    for row in rows:
        assert row["offset"] == at.get(row["file"], 0)
        at[row["file"]] = row["offset"] + row["length"]
    record = spark.createDataFrame([("u", 5, "é")], "u string, i long, h string").select(fixity.warc_record(F.col("u"), F.col("i"), F.col("h"))).first()[0]
    head, body = record.split("\r\n\r\n", 1)
    assert head.startswith("WARC/1.1\r\n") and head.endswith("Content-Length: 2") and body == "é\r\n\r\n"


def test_equal_replicas(spark):
    records = fixity.archived(pages(spark, *sample(60)), file_pages=25)
    assert fixity.audit(records, records).count() == 0


@pytest.mark.parametrize("range_bytes,fanout", [(1 << 16, 16), (512, 2), (4096, 3)])
def test_damage_is_located(spark, range_bytes, fanout):
    rows = sample(120)
    page = F.col("page_id")
    master = fixity.archived(pages(spark, *rows), file_pages=50)
    copy = fixity.archived(pages(spark, *rows), 50, lambda r: F.when(page.isin(3, 77), F.concat(F.lit("!"), F.substring(r, 2, 99999))).otherwise(r))
    extra = copy.filter("page_id = 90").withColumn("offset", F.col("offset") + 7)
    replica = copy.filter("page_id NOT IN (10, 119)").unionByName(extra)
    found = {(r["page_id"], r["state"]) for r in fixity.audit(master, replica, range_bytes, fanout).collect()}
    assert found == {(3, "changed"), (77, "changed"), (10, "missing"), (119, "missing"), (90, "extra")}


def test_whole_files_and_heights(spark):
    master = fixity.archived(pages(spark, *sample(90)), file_pages=30)
    found = fixity.audit(master, master.filter("file != 1"), 256, 2)
    assert {(r["page_id"], r["state"]) for r in found.collect()} == {(i, "missing") for i in range(30, 60)}
    assert {r["state"] for r in fixity.audit(master.filter("file = 0 AND offset < 300"), master, 256, 2).collect()} == {"extra"}


def test_only_branches_below_a_mismatch_are_read(spark):
    master = fixity.archived(pages(spark, *sample(120)), file_pages=120)
    levels = fixity.merkle_levels(master, 512, 2)
    leaf = levels[0].orderBy("node").collect()[11]["node"]
    other = levels[0].withColumn("hash", F.when(F.col("node") == leaf, "x").otherwise(F.col("hash")))
    rebuilt = [other] + [level.withColumn("hash", F.when(F.col("node") == leaf >> k, "x").otherwise(F.col("hash"))) for k, level in enumerate(levels[1:], 1)]
    assert [tuple(r) for r in fixity.differing_ranges(levels, rebuilt, 2).collect()] == [(0, leaf)]


def test_odd_rows(spark):
    rows = [(None, None, None), (1, "u", None), (1, "u", None), (2, None, ""), (3, "v", "y" * 300_000), (4, "w", "z")]
    master = fixity.archived(pages(spark, *rows))
    assert master.count() == 6 and fixity.audit(master, master).count() == 0
    fewer = fixity.audit(master, master.filter("page_id IS NULL OR page_id != 1")).collect()
    assert [(r["page_id"], r["state"]) for r in fewer] == [(1, "missing"), (1, "missing")]
    empty = master.filter("page_id > 99")
    assert fixity.audit(empty, empty).count() == 0
    assert {r["state"] for r in fixity.audit(empty, master).collect()} == {"extra"}
    assert fixity.audit(master, empty).count() == 6


def test_pages_without_an_id(spark):
    """They are spread over files like any other, copies of one page too, and audited record by record."""
    rows = [(None, f"u{i % 7}" if i % 2 else "same", "x" * (i % 5) if i % 2 else "copy") for i in range(300)]
    master = fixity.archived(pages(spark, *rows, *sample(5)), file_pages=10)
    sizes = {r["file"]: r["count"] for r in master.filter("file < 0").groupBy("file").count().collect()}
    assert sum(sizes.values()) == 300 and len(sizes) == 30 and max(sizes.values()) < 40
    assert fixity.audit(master, fixity.archived(pages(spark, *rows[::-1], *sample(5)), file_pages=10)).count() == 0
    lost = master.filter("file < 0").orderBy("file", "offset").limit(3).select("file", "offset")
    found = fixity.audit(master, master.join(lost, ["file", "offset"], "left_anti"))
    assert {(r["page_id"], r["state"]) for r in found.collect()} == {(None, "missing")} and found.count() == 3
