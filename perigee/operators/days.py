"""Operators on calendar days."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def day_sequence(start: Column, end: Column) -> Column:
    """All days from `start` to `end`, both included."""
    return F.sequence(start, end, F.expr("INTERVAL 1 DAY"))


def day_range(spark: SparkSession, start: date, end: date) -> DataFrame:
    """One row per day from `start` to `end`, both included."""
    return spark.range(1).select(F.explode(day_sequence(F.lit(start), F.lit(end))).alias("day"))


def missing_days(days: DataFrame, counts: DataFrame) -> DataFrame:
    """Days of a range that have no row in a day-grain period table.

    Both sides are calendars (a few thousand rows), whatever the size of the table behind.
    """
    return days.join(counts.select(F.col("period").alias("day")), "day", "left_anti")


def newest_per_day(df: DataFrame, day: str, position: str, columns: Sequence[str], ways: int = 1) -> DataFrame:
    """For each day, `columns` of the row with the greatest `position`.

    An aggregate, not a window: each task keeps one row per day before the shuffle. A day found
    in very many tasks still sends one row from each, so with `ways` above 1 they first meet in
    that many groups per day, and then one row of each group meets the others.
    """
    if ways > 1:
        way = F.pmod(F.spark_partition_id(), F.lit(ways))
        df = _newest(df.withColumn("way", way), [day, "way"], position, columns)
    return _newest(df, [day], position, columns).select(day, *columns)


def _newest(df: DataFrame, keys: Sequence[str], position: str, columns: Sequence[str]) -> DataFrame:
    newest = F.max_by(F.struct(*columns), F.col(position)).alias("newest")
    groups = df.groupBy(*keys).agg(newest, F.max(position).alias(position))
    return groups.select(*keys, position, *(f"newest.{name}" for name in columns if name != position))
