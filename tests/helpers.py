"""Small frames for the tests, and a look at executed plans."""

import datetime as dt

EVENT_DDL = (
    "id string, source string, title string, summary string, link string, "
    "published_raw string, ingested_at string, kafka_ts timestamp"
)


def at(text):
    return dt.datetime.fromisoformat(text).replace(tzinfo=dt.timezone.utc)


def event(id, title="title", summary="text", arrived="2025-11-03 10:00:00", published="", source="s"):
    return (id, source, title, summary, f"https://n/{id}", published, "2025-11-03T10:00:01+00:00", at(arrived))


def events(spark, *rows):
    return spark.createDataFrame(list(rows), EVENT_DDL)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def values(df, *columns):
    return sorted((tuple(row) for row in df.select(*columns).collect()), key=repr)
