import os
import urllib.parse

from feedlake.jobs import main
from feedlake.operators.tables import last_snapshot
from feedlake.plans.marts import read_gold
from feedlake.schema import FEEDS
from feedlake.sources.messages import message_files, publish_files, to_messages
from feedlake.streaming.streams import read_bronze, read_silver
from tests.helpers import event, events


def test_collect_job(spark, root, capsys):
    folder = f"{root}/feeds/feed_url={urllib.parse.quote(FEEDS[0][1], safe='')}"
    os.makedirs(folder)
    with open(f"{folder}/1.xml", "w", encoding="utf-8") as out:
        out.write("<rss><channel><item><title>t</title><link>https://n/1</link></item></channel></rss>")
    for _ in range(2):
        main(["collect", root, "--database", "jobs_collect"])
    assert message_files(spark, f"{root}/inbox").count() == 1
    main(["ingest", root, "--once", "--database", "jobs_collect"])
    assert spark.table("jobs_collect.silver_news").count() == 1
    assert spark.table("jobs_collect.bronze_news").first()["source"] == FEEDS[0][0]
    assert FEEDS[0][1] in capsys.readouterr().out.replace("...", "")


def test_all_jobs_in_order(spark, root, capsys):
    rows = [event(f"{n:016x}", title=f"Growth report {n}", published="2025-11-03 08:00:00") for n in range(5)]
    publish_files(to_messages(events(spark, *rows), "kafka_ts"), f"{root}/inbox")
    main(["ingest", root, "--once"])
    assert read_bronze(spark, f"{root}/bronze").count() == read_silver(spark, f"{root}/silver").count() == 5
    main(["gold", root])
    assert read_gold(spark, f"{root}/gold", "gold_daily_source").first()["article_count"] == 5
    main(["embed", root, "--date", "2025-11-04"])
    main(["embed", root, "--date", "2025-11-09"])
    assert "5 articles indexed" in capsys.readouterr().out
    main(["retrieve", root, "--query", "Growth", "--top-k", "2"])
    shown = capsys.readouterr().out
    assert "[2] (s) Growth report" in shown and "[3]" not in shown
    main(["brief", root, "--date", "2025-11-04"])
    assert "MOCK-LLM" in capsys.readouterr().out
    main(["compact", root])
    assert last_snapshot(spark, f"{root}/silver") == 0 and last_snapshot(spark, f"{root}/points") == 1
    main(["daily", root, "--date", "2025-11-04"])
    assert read_silver(spark, f"{root}/silver").count() == 5
