import os
import random
import urllib.parse

import pytest
from pyspark.sql import functions as F

from feedlake.plans.ingest import poll_counters, publish_new, to_events
from feedlake.operators.dedupe import first_seen
from feedlake.sources.feeds import (
    entries_from_documents,
    feed_list,
    read_documents,
    read_feed_files,
    read_large_feeds,
    tagged,
    unread_documents,
)
from feedlake.sources.messages import decode, message_files, publish_files, to_messages
from tests.helpers import at, event, events, plan, values

RSS = """<?xml version="1.0" encoding="UTF-8"?>
<rss version="2.0" xmlns:dc="http://purl.org/dc/elements/1.1/"><channel><title>c</title>
<item><title><![CDATA[ A <b>1</b> ]]></title><link> https://n/1 </link><pubDate>Mon, 03 Nov 2025 10:00:00 +0900</pubDate>
<description>x &amp; y</description></item>
<item><title>no link</title><description>d</description></item>
<item><title>by guid</title><guid>https://n/3</guid><dc:date>2025-11-03T10:00:00Z</dc:date></item>
<item><title>id only</title><guid isPermaLink="false">tag:4</guid></item>
</channel></rss>"""

ATOM = """<feed xmlns="http://www.w3.org/2005/Atom"><title>c</title>
<entry><title>atom</title><link rel="self" href="https://n/self"/><link rel="alternate" href="https://n/5"/>
<updated>2025-11-03T10:00:00Z</updated><content type="html">body</content></entry>
<entry><title>plain link</title><link href="https://n/6"/><summary>s</summary></entry></feed>"""

RDF = """<rdf:RDF xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#"><channel><title>c</title></channel>
<item><title>old</title><link>https://n/7</link></item></rdf:RDF>"""


def test_documents_of_all_kinds(spark):
    rows = spark.createDataFrame(
        [("r", RSS), ("a", ATOM), ("d", RDF), ("broken", "<rss><channel><item>"), ("none", None)],
        "feed_url string, xml string",
    )
    got = values(entries_from_documents(rows), "feed_url", "entry_no", "link", "title", "published", "updated", "summary", "description")
    assert [(r[0], r[2]) for r in got if r[0] == "r"] == [("r", "https://n/1"), ("r", None), ("r", "https://n/3"), ("r", None)]
    by_link = {r[2]: r for r in got if r[2]}
    assert by_link["https://n/1"][4] == "Mon, 03 Nov 2025 10:00:00 +0900"
    assert by_link["https://n/1"][3].strip() == "A <b>1</b>"
    assert by_link["https://n/1"][7] == "x & y"
    assert by_link["https://n/3"][5] == "2025-11-03T10:00:00Z"
    assert by_link["https://n/5"][5:] == ("2025-11-03T10:00:00Z", None, "body")
    assert by_link["https://n/6"][6] == "s"
    assert by_link["https://n/7"][0] == "d"
    assert not [r for r in got if r[0] in ("none", "broken")]
    assert values(unread_documents(rows), "feed_url") == [("broken",), ("none",)]


def test_elements_of_other_name_spaces_are_not_mistaken(spark):
    rss = """<rss xmlns:media="m" xmlns:atom="a" xmlns:dc="d"><channel><atom:link href="self"/><item><title>own</title>
    <media:title>other</media:title><link>https://n/1</link><atom:link href="https://n/self"/><dc:date>2025</dc:date>
    <dc:title>x</dc:title></item></channel></rss>"""
    atom = """<feed xmlns="http://www.w3.org/2005/Atom" xmlns:m="m"><entry><m:title>other</m:title><title>own</title>
    <link href="https://n/2"/><m:link href="https://n/x"/></entry></feed>"""
    rows = spark.createDataFrame([(rss,), (atom,)], "xml string")
    assert values(entries_from_documents(rows), "link", "title", "updated") == [("https://n/1", "own", "2025"), ("https://n/2", "own", None)]


def test_loose_ampersands_are_mended(spark):
    loose = "<rss><channel><item><title>A & B&nbsp;C &amp; D &#65;</title><link>https://n/1?a=1&b=2</link></item></channel></rss>"
    kept = "<rss><channel><item><title><![CDATA[A & B]]></title><link>https://n/2</link></item></channel></rss>"
    rows = spark.createDataFrame([(loose,), (kept,)], "xml string")
    got = values(entries_from_documents(rows), "link", "title")
    assert got == [("https://n/1?a=1&b=2", "A & B&nbsp;C & D A"), ("https://n/2", "A & B")]


def test_landed_files_are_tagged_by_feed(spark, root):
    feeds = [("First", "https://f/one?a=1"), ("Second", "https://f/two")]
    for (_, url), body in zip(feeds, (RSS, RSS.replace("https://n/1", "https://n/9"))):
        folder = f"{root}/feed_url={urllib.parse.quote(url, safe='')}"
        os.makedirs(folder)
        with open(f"{folder}/poll.xml", "w", encoding="utf-8") as out:
            out.write(body)
    rows = tagged(entries_from_documents(read_feed_files(spark, root)), feed_list(spark, feeds))
    found = values(to_events(rows), "source", "link", "title")
    assert ("First", "https://n/1", "A <b>1</b>") in found and ("Second", "https://n/9", "A <b>1</b>") in found
    assert len(found) == 4


def test_atom_files(spark, root):
    os.makedirs(f"{root}/feed_url=u")
    with open(f"{root}/feed_url=u/poll.xml", "w", encoding="utf-8") as out:
        out.write(ATOM)
    assert values(entries_from_documents(read_feed_files(spark, root)), "link") == [("https://n/5",), ("https://n/6",)]


def test_new_entries_are_published_once_and_failures_counted(spark, root):
    item = "<item><title>{}</title><link>https://n/{}</link></item>"
    rss = lambda *items: "<rss><channel>" + "".join(item.format(t, n) for t, n in items) + "</channel></rss>"
    feeds = feed_list(spark, [("one", "u1"), ("two", "u2"), ("three", "u3")])
    polls = [
        [("u2", rss(("two a", "a"), ("two b", "b"))), ("u1", rss(("one a", "a"), ("again a", "a"))), ("u3", "<rss><chan")],
        [("u1", rss(("late a", "a"), ("one c", "c"))), ("u3", rss())],
    ]
    reports = []
    for poll in polls:
        report = publish_new(spark.createDataFrame(poll, "feed_url string, xml string"), feeds, f"{root}/log")
        reports.append([tuple(r) for r in report.collect()])
    sent = decode(message_files(spark, f"{root}/log"))
    assert values(sent, "link", "source", "title") == [("https://n/a", "one", "one a"), ("https://n/b", "two", "two b"), ("https://n/c", "one", "one c")]
    assert reports == [[("u1", 1, 0, 2), ("u2", 1, 0, 2), ("u3", 1, 1, 0)], [("u1", 1, 0, 2), ("u2", 0, 0, 0), ("u3", 1, 0, 0)]]


def test_events_from_entries(spark):
    rows = spark.createDataFrame(
        [
            ("https://n/1", " t　", "", "u", "", " d ", "s"),
            ("", "t", "p", "u", "x", "d", "s"),
            (None, "t", "p", "u", "x", "d", "s"),
            ("https://n/2", None, None, None, None, None, "s"),
        ],
        "link string, title string, published string, updated string, summary string, description string, source string",
    )
    got = values(to_events(rows), "link", "title", "summary", "published_raw")
    assert got == [("https://n/1", "t", "d", "u"), ("https://n/2", "", "", "")]
    stamp = to_events(rows).first()["ingested_at"]
    assert stamp.endswith("+00:00") and "T" in stamp


def test_first_feed_in_the_list_wins(spark):
    feeds = feed_list(spark, [("one", "u1"), ("two", "u2")])
    rows = spark.createDataFrame([("u2", "https://n/1", "t"), ("u1", "https://n/1", "t")], "feed_url string, link string, title string")
    entries = tagged(rows, feeds)
    for name in ("published", "updated", "summary", "description"):
        entries = entries.withColumn(name, F.lit(""))
    kept = first_seen(to_events(entries, keep=["feed_no"]), [F.col("feed_no")])
    assert values(kept, "source") == [("one",)]


def test_seen_ids_are_not_published_again(spark):
    rows = events(spark, event("a"), event("b"), event("b", arrived="2025-11-03 09:00:00", source="early"), event(None))
    published = spark.createDataFrame([("a",), ("a",)], "id string")
    kept = first_seen(rows, [F.col("kafka_ts")], published)
    assert values(kept, "id", "source") == [("b", "early")]


def test_poll_counters_run_on_over_days(spark):
    stamps = ["2025-11-03 10:00:01", "2025-11-03 10:00:59", "2025-11-03 10:01:00", "2025-11-05 00:00:00"]
    rows = events(spark, *[event(str(n), arrived=s) for n, s in enumerate(stamps)])
    got = values(poll_counters(rows, "kafka_ts").withColumn("p", F.col("poll_at").cast("string")), "p", "published_count", "seen_total")
    assert got == [("2025-11-03 10:00:00", 2, 2), ("2025-11-03 10:01:00", 1, 3), ("2025-11-05 00:00:00", 1, 4)]


def test_messages_round_trip(spark, root):
    rows = events(spark, event("a", title='삼성 "q" \\ \n', summary=None), event("b"))
    publish_files(to_messages(rows, "kafka_ts"), root)
    stored = message_files(spark, root)
    assert sorted(r["key"] for r in stored.collect()) == ["a", "b"]
    assert '"summary":null' in stored.filter("key = 'a'").first()["value"]
    assert "삼성" in stored.filter("key = 'a'").first()["value"]
    assert values(decode(stored), *rows.columns) == values(rows, *rows.columns)


def test_unreadable_values_become_nulls(spark):
    bodies = ['{"id":"a","title":3,"extra":1}', "not json", '{"id":"b"', "null", "", None]
    rows = spark.createDataFrame([(b, at("2025-11-03 10:00:00")) for b in bodies], "value string, timestamp timestamp")
    got = decode(rows.withColumn("value", F.col("value").cast("binary"))).collect()
    assert [(r["id"], r["title"]) for r in got][0] == ("a", "3")
    assert all(r["id"] is None and r["link"] is None for r in got[1:])
    assert all(r["kafka_ts"] is not None for r in got)


ENTRY = ["feed_url", "entry_no", "link", "title", "published", "updated", "summary", "description"]


def land_large(root, tag, n, name="1"):
    folder = f"{root}/feed_url={urllib.parse.quote('https://a/' + name, safe='')}"
    os.makedirs(folder, exist_ok=True)
    rng = random.Random(n)
    with open(f"{folder}/{name}.xml", "w", encoding="utf-8") as out:
        out.write("<?xml version='1.0'?>\n" + ("<rss xmlns:media='urn:m'><channel><title>a feed</title><items>2</items>" if tag == "item" else "<feed><title>a feed</title>"))
        for k in range(n):
            text = "".join(rng.choice(["w ", "é ", "&lt;b&gt; ", "& ", "한글 "]) for _ in range(rng.randrange(60)))
            if tag == "item":
                out.write(f"<item>\n<title>t {k} {text}</title><media:title>no</media:title>")
                out.write(f"<link>https://n/{k}</link>" if k % 3 else f"<guid>https://n/{k}</guid>")
                out.write(f"<description><![CDATA[<b>{k}</b> {text}]]></description></item>" + "\n" * (k % 2))
            else:
                out.write(f"<entry xml:lang='x'><title>t {k}</title><link rel='alternate' href='https://n/{k}'/><summary>{text}</summary></entry>\n")
        out.write("</channel></rss>" if tag == "item" else "</feed>")


@pytest.mark.parametrize("tag", ["item", "entry"])
def test_large_files_are_read_in_pieces(spark, root, tag):
    for n, name in ((4000, "1"), (3, "2"), (0, "3")):
        land_large(root, tag, n, name)
    want = values(entries_from_documents(read_feed_files(spark, root)), *ENTRY)
    assert len(want) == 4003
    size = sum(os.path.getsize(f"{folder}/{name}") for folder, _, names in os.walk(root) for name in names)
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size // 12))
    spark.conf.set("spark.sql.files.openCostInBytes", "1024")
    try:
        rows = read_large_feeds(spark, root, tag)
        assert values(rows, *ENTRY) == want
        pieces = spark.read.option("lineSep", f"</{tag}>").text(root)
        tasks = pieces.filter("value like '%<link%'").groupBy(F.spark_partition_id()).count().count()
        assert tasks >= 8  # one file, several tasks
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_entries_of_a_broken_large_file(spark, root):
    os.makedirs(f"{root}/feed_url=a")
    with open(f"{root}/feed_url=a/1.xml", "w", encoding="utf-8") as out:
        out.write("<rss><item><link>1</link></item><item><link>2<link></item><itemless/><item ><link>3</link></item><item><link>4</link>")
    rows = read_large_feeds(spark, root).filter("link is not null")
    assert values(rows, "link") == [("1",), ("3",), ("4",)]  # the last lacks its end tag only


def test_documents_are_parsed_once(spark):
    docs = spark.createDataFrame([("a", "<rss><channel><item><link>x</link></item></channel></rss>"), ("b", "no")], "feed_url string, xml string")
    entries, unread = read_documents(docs)
    assert values(entries, "feed_url", "link") == [("a", "x")] and values(unread, "feed_url") == [("b",)]
    for part in (entries, unread):
        assert "from_xml" not in plan(part) and "FileScan" in plan(part)
