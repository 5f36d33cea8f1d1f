"""Ordered heads of tables and of groups. Every order is total."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top(df: DataFrame, k: int, order: list[Column]) -> DataFrame:
    """Head of the whole table; each task sends its own k rows only."""
    return df.orderBy(*order).limit(k)


def top_per(df: DataFrame, groups: list[str], k: int, order: list[Column], rank: str = "rank") -> DataFrame:
    """Head of each group, numbered from 1; limited per task before the shuffle."""
    window = Window.partitionBy(*groups).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= k)
