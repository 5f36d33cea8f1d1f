"""Top keywords from mergeable sketches: one frequent-items sketch per day, stored, and combined over any days.

A sketch tracks a bounded number of tokens, so a day's row has a bounded size however many tokens there are, and a span of
days costs one row per day. Estimates are off by no more than `error_bound`: 3.5 times the number of tokens counted
over the size of the sketch's table, which combining keeps. Tokens beyond that bound are always tracked.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.operators.tables import replace_partition, replace_table
from feedlake.operators.topk import top, top_per
from feedlake.plans.marts import TOP_KEYWORDS, for_date, keywords

MAX_ITEMS = 10_000
# Fixed values of the frequent-items sketch: how full its table gets, and the error in parts of the counted items.
_FULL, _ERROR = 0.75, 3.5


def table_size(max_items: int) -> int:
    """The sketch's table: the power of two of which `max_items` fill three quarters."""
    size = 1
    while size * _FULL < max_items:
        size *= 2
    return size


def error_bound(n: Column, max_items: int = MAX_ITEMS) -> Column:
    """What an estimate may be off by, of so many counted tokens; nothing while all tokens have a place."""
    return F.ceil(n * F.lit(_ERROR) / F.lit(table_size(max_items)))


def keyword_sketches(silver: DataFrame, max_items: int = MAX_ITEMS) -> DataFrame:
    """(n, sketch, dt): per day, the number of tokens and their sketch. Tasks send one sketch per day."""
    sketch = F.expr(f"approx_top_k_accumulate(token, {max_items})")
    return keywords(silver).groupBy("dt").agg(F.count(F.lit(1)).alias("n"), sketch.alias("sketch")).select("n", "sketch", "dt")


def build_sketches(silver: DataFrame, root: str, date: str | None = None, max_items: int = MAX_ITEMS) -> None:
    """Store the sketches; with a date only that day's is replaced."""
    if date:
        replace_partition(keyword_sketches(for_date(silver, date), max_items), f"{root}/keyword_sketch", date)
    else:
        replace_table(keyword_sketches(silver, max_items), f"{root}/keyword_sketch")


def read_sketches(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(f"{root}/keyword_sketch")


def _estimates(rows: DataFrame, max_items: int, kept: Iterable[str]) -> DataFrame:
    """(kept, token, estimate, bound) of all tracked tokens of each sketch."""
    items = F.expr(f"approx_top_k_estimate(sketch, {max_items})")
    each = rows.select(*kept, error_bound(F.col("n"), max_items).alias("bound"), F.explode(items).alias("i"))
    return each.select(*kept, F.col("i.item").alias("token"), F.col("i.count").alias("estimate"), "bound")


def sketched_per_day(sketches: DataFrame, k: int = TOP_KEYWORDS, max_items: int = MAX_ITEMS) -> DataFrame:
    """(dt, rank, token, estimate, bound): the first k keywords of each day."""
    ranked = top_per(_estimates(sketches, max_items, ["dt"]), ["dt"], k, [F.col("estimate").desc(), F.col("token").asc()])
    return ranked.select("dt", "rank", "token", "estimate", "bound")


def combined(sketches: DataFrame, max_items: int = MAX_ITEMS) -> DataFrame:
    """(n, sketch) of all days together; no row without days, of which there is no sketch."""
    one = F.expr(f"approx_top_k_combine(sketch, {max_items})")
    return sketches.groupBy(F.lit(1).alias("_all")).agg(F.sum("n").alias("n"), one.alias("sketch")).drop("_all")


def sketched_keywords(sketches: DataFrame, k: int = TOP_KEYWORDS, max_items: int = MAX_ITEMS) -> DataFrame:
    """(token, estimate, bound): the first k keywords over all days."""
    return top(_estimates(combined(sketches, max_items), max_items, []), k, [F.col("estimate").desc(), F.col("token").asc()])


def candidates(sketches: DataFrame, k: int = TOP_KEYWORDS, max_items: int = MAX_ITEMS) -> DataFrame:
    """(token, estimate, bound): all tokens that may be among the k most frequent, at most `max_items`.

    The k-th token is as frequent as the k-th estimate less the bound, and a token's estimate is no
    less than its frequency less the bound. Where the k-th estimate is within the bounds, a token that is not tracked
    may be as frequent; this fails then, and a larger sketch or the mart itself has to answer.
    """
    rows = _estimates(combined(sketches, max_items), max_items, ["n"])
    first = top(rows, k, [F.col("estimate").desc(), F.col("token").asc()])
    last = first.agg(F.min("estimate").alias("least"), F.count(F.lit(1)).alias("found")).first()
    floor = F.lit(0) if last["found"] < k else last["least"] - 2 * F.col("bound")
    # A table that had a place for everything counted lacks no token.
    unsure = (floor <= F.col("bound")) & (F.col("n") > max_items)
    checked = F.when(unsure, F.raise_error(F.lit("the sketch is too small for this list")).cast("boolean")).otherwise(F.col("estimate") >= floor)
    return rows.filter(checked).select("token", "estimate", "bound")
