"""Calendar columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

GRAINS = ("day", "month", "year")


def period_key(day: Column, grain: str) -> Column:
    """Numeric grouping key of a period: a date for days and months, a number for years.

    Rows are grouped on this and the `yyyy-MM` text is made from the groups, so no text is
    built or hashed per row.
    """
    if grain == "day":
        return day.cast("date")
    if grain == "month":
        return F.trunc(day.cast("date"), "MM")
    if grain == "year":
        return F.year(day)
    raise ValueError(f"grain must be one of {GRAINS}, not {grain!r}")


def period_name(key: Column, grain: str) -> Column:
    return F.date_format(key, "yyyy-MM") if grain == "month" else key


def period_year(key: Column, grain: str) -> Column:
    return key if grain == "year" else F.year(key)


def feed_day(key: Column) -> Column:
    """Date of a feed's day key, null unless the key is exactly `yyyy-MM-dd`."""
    day = key.try_cast("date")
    return F.when(F.date_format(day, "yyyy-MM-dd") == key, day)


def day_parts(day: Column) -> dict[str, Column]:
    return {"year": F.year(day), "month": F.month(day), "day": F.dayofmonth(day)}


def partition_day() -> Column:
    """The date a `year, month, day` partition stands for."""
    return F.make_date(F.col("year"), F.col("month"), F.col("day"))
