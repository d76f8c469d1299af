"""Counts per day, month or year, and what is derived from them.

A period table has `period` (a date, a `yyyy-MM` text or a year), its `year`, and `n`. It has
one row per calendar period, so the windows over all of it stay small at any input size: the
rows behind it are counted before the shuffle and never reach a window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from perigee.functions.dates import period_key, period_name, period_year


def period_counts(df: DataFrame, date_col: str, grain: str, weight: str | None = None) -> DataFrame:
    """Rows per period; null dates are a period of their own.

    With `weight`, the rows already stand for that many, as in a finer period table.
    """
    total = F.count(F.lit(1)) if weight is None else F.sum(weight)
    counts = df.groupBy(period_key(F.col(date_col), grain).alias("key")).agg(total.alias("n"))
    key = F.col("key")
    return counts.select(period_name(key, grain).alias("period"), period_year(key, grain).alias("year"), "n")


def total_count(df: DataFrame, weight: str | None = None) -> DataFrame:
    total = F.count(F.lit(1)) if weight is None else F.coalesce(F.sum(weight), F.lit(0).cast("bigint"))
    return df.agg(total.alias("n"))


def _window(within: str | None):
    return Window.partitionBy(within) if within else Window.partitionBy()


def period_average(counts: DataFrame, within: str | None = None) -> DataFrame:
    """Adds `average`: the mean `n` of all periods, or of those sharing `within`."""
    return counts.withColumn("average", F.avg("n").over(_window(within)))


def period_change(counts: DataFrame, within: str | None = None) -> DataFrame:
    """Adds `previous` and `change` against the period listed before, null for the first.

    With `within="year"` each year starts afresh. A period without rows is skipped, not zero.
    """
    previous = F.lag("n", 1).over(_window(within).orderBy("period"))
    return counts.withColumn("previous", previous).withColumn("change", F.col("n") - F.col("previous"))


def peak_periods(counts: DataFrame) -> DataFrame:
    """The periods with the highest `n`, all of them when tied."""
    rank = F.dense_rank().over(Window.orderBy(F.desc("n")))
    return counts.withColumn("rank", rank).filter(F.col("rank") == 1).drop("rank")


def top_period(counts: DataFrame) -> DataFrame:
    """The one period with the highest `n`; the earliest when tied."""
    return counts.orderBy(F.desc("n"), F.asc("period")).limit(1)
