"""Jobs for spark-submit: collect, ingest, gold, embed, brief, daily, retrieve, compact."""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import SparkSession

from feedlake.operators.tables import compact, last_batch, next_batch
from feedlake.plans.briefing import contexts, run_briefings, write_briefings
from feedlake.plans.catalog import open_tables, refresh_tables
from feedlake.plans.daily import run_daily
from feedlake.plans.index import collection, index_articles, recent, retrieve
from feedlake.plans.ingest import publish_new
from feedlake.plans.marts import build_gold, read_gold, top_keywords, top_sources
from feedlake.schema import (
    BRIEFING_TOP_K,
    BRONZE,
    DEFAULT_QUERY,
    LOOKBACK_DAYS,
    MAX_LOOPS,
    POINT_LOG,
    SILVER_LOG,
    TOP_K,
)
from feedlake.session import build_session
from feedlake.sources.feeds import feed_list, read_feed_files
from feedlake.sources.messages import message_file_stream, message_kafka_stream
from feedlake.streaming.streams import run_ingest


def collect(spark: SparkSession, args: argparse.Namespace) -> None:
    """Landed feed documents to the message log; shows what came from each feed."""
    documents = read_feed_files(spark, f"{args.root}/feeds")
    publish_new(documents, feed_list(spark), f"{args.root}/inbox").show(truncate=False)


def ingest(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.servers:
        messages = message_kafka_stream(spark, args.servers, args.topic, args.per_batch)
    else:
        messages = message_file_stream(spark, f"{args.root}/inbox", args.per_batch)
    run_ingest(messages, args.root, **({"availableNow": True} if args.once else {}))


def gold(spark: SparkSession, args: argparse.Namespace) -> None:
    root = f"{args.root}/gold"
    build_gold(spark.table(f"{args.database}.silver_news"), root, args.date)
    top_sources(read_gold(spark, root, "gold_daily_source")).show(truncate=False)
    top_keywords(read_gold(spark, root, "gold_daily_keyword")).show(truncate=False)


def embed(spark: SparkSession, args: argparse.Namespace) -> None:
    root = f"{args.root}/points"
    rows = recent(spark.table(f"{args.database}.silver_news"), args.date or str(dt.date.today()), args.lookback)
    print(f"{index_articles(rows, root, next_batch(spark, root), replace=False)} articles indexed")


def _asked(spark: SparkSession, text: str, name: str):
    return spark.createDataFrame([(1, text or DEFAULT_QUERY)], f"qid long, {name} string")


def brief(spark: SparkSession, args: argparse.Namespace) -> None:
    stored = collection(spark, f"{args.root}/points")
    briefings = run_briefings(
        _asked(spark, args.query, "query"), lambda q: retrieve(q, stored, BRIEFING_TOP_K), max_loops=args.max_loops
    )
    write_briefings(briefings, f"{args.root}/briefings", args.date or str(dt.date.today()))
    briefings.select("loops", "verdict", "briefing").show(truncate=False)


def daily(spark: SparkSession, args: argparse.Namespace) -> None:
    run_daily(
        spark, args.root, args.date or str(dt.date.today()), _asked(spark, args.query, "query"),
        lookback=args.lookback, max_loops=args.max_loops,
    )


def search(spark: SparkSession, args: argparse.Namespace) -> None:
    asked = _asked(spark, args.query, "text")
    found = contexts(asked, retrieve(asked, collection(spark, f"{args.root}/points"), args.top_k))
    found.select("contexts").show(truncate=False)


def compact_all(spark: SparkSession, args: argparse.Namespace) -> None:
    for name, schema, key, part, order in (
        ("bronze", BRONZE, "id", "source", None),
        ("silver", SILVER_LOG, "id", "dt", None),
        ("points", POINT_LOG, "point_id", "bucket", "vec_id"),
    ):
        if last_batch(spark, f"{args.root}/{name}") is not None:
            compact(spark, f"{args.root}/{name}", schema, key, part, order)


JOBS = {
    "collect": collect,
    "ingest": ingest,
    "gold": gold,
    "embed": embed,
    "brief": brief,
    "daily": daily,
    "retrieve": search,
    "compact": compact_all,
}


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="feedlake.jobs", description=__doc__)
    out.add_argument("job", choices=JOBS)
    out.add_argument("root", help="folder of the tables")
    out.add_argument("--database", default="news", help="catalog database that shows the tables")
    out.add_argument("--date", help="ISO date; for gold none means all days, elsewhere today")
    out.add_argument("--query", default="")
    out.add_argument("--servers", help="Kafka bootstrap servers; without them <root>/inbox is read")
    out.add_argument("--topic", default="news.raw")
    out.add_argument("--once", action="store_true", help="stop when all present messages are in")
    out.add_argument("--per-batch", type=int, help="messages (or files of the inbox) per micro-batch")
    out.add_argument("--lookback", type=int, default=LOOKBACK_DAYS)
    out.add_argument("--max-loops", type=int, default=MAX_LOOPS)
    out.add_argument("--top-k", type=int, default=TOP_K)
    return out


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = build_session(f"feedlake-{args.job}")
    open_tables(spark, args.database, args.root)
    JOBS[args.job](spark, args)
    refresh_tables(spark, args.database, args.root)


if __name__ == "__main__":
    main()
