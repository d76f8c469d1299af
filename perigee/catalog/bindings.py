"""The test tables seen as approach rows and as feed documents."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from perigee.functions.documents import encode_feed
from perigee.schema import APPROACH_COLUMNS


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Approach columns as expressions on a table, valid in Spark and in the check SQL alike, but
# for the few that are given as a pair (Spark, check SQL). A few values are null on purpose.
LINEITEM = {
    "id": "CASE WHEN l_linenumber < 7 THEN CAST(l_orderkey AS STRING) END",
    "name": "concat('(', l_orderkey, ' ', l_linenumber, ')')",
    "nasa_jpl_url": "concat('https://example.org/', l_partkey)",
    "absolute_magnitude_h": "CASE WHEN l_quantity < 50 THEN 12 + l_discount * 100 END",
    "estimated_diameter_min_kilometers": "l_quantity / 8",
    "estimated_diameter_max_kilometers": "l_quantity / 4",
    "estimated_diameter_min_meters": "l_quantity * 125",
    "estimated_diameter_max_meters": "l_quantity * 250",
    "estimated_diameter_min_miles": "l_quantity / 13",
    "estimated_diameter_max_miles": "l_quantity / 6",
    "estimated_diameter_min_feet": "l_quantity * 410",
    "estimated_diameter_max_feet": "l_quantity * 820",
    "is_potentially_hazardous_asteroid": "l_returnflag = 'R'",
    "close_approach_date": "CASE WHEN l_tax < 0.08e0 OR l_quantity < 50 THEN CAST(l_shipdate AS DATE) END",
    "close_approach_date_full": (
        "date_format(l_shipdate, 'yyyy-MMM-dd HH:mm')",
        "strftime(l_shipdate, '%Y-%b-%d %H:%M')",
    ),
    "epoch_date_close_approach": (
        "CAST(datediff(l_shipdate, DATE '1970-01-01') AS BIGINT) * 86400000",
        "CAST(date_diff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE)) AS BIGINT) * 86400000",
    ),
    "relative_velocity_kilometers_per_second": "l_extendedprice / 3000",
    "relative_velocity_kilometers_per_hour": "l_extendedprice * 1.2e0",
    "relative_velocity_miles_per_hour": "l_extendedprice * 0.75e0",
    "miss_distance_astronomical": "l_tax * 15",
    "miss_distance_lunar": "l_tax * 5835",
    "miss_distance_kilometers": "l_tax * 2244000000",
    "miss_distance_miles": "l_tax * 1394000000",
    "orbiting_body": "CASE WHEN l_linenumber > 1 THEN l_linestatus END",
    "is_sentry_object": "l_linenumber = 1",
}
EVENTS = {
    "id": "CAST(event_id AS STRING)",
    "name": "event_type",
    "nasa_jpl_url": "concat('https://example.org/', user_id)",
    "absolute_magnitude_h": "10 + value / 20",
    "estimated_diameter_min_kilometers": "value / 40",
    "estimated_diameter_max_kilometers": "value / 20",
    "estimated_diameter_min_meters": "value * 25",
    "estimated_diameter_max_meters": "value * 50",
    "estimated_diameter_min_miles": "value / 64",
    "estimated_diameter_max_miles": "value / 32",
    "estimated_diameter_min_feet": "value * 82",
    "estimated_diameter_max_feet": "value * 164",
    "is_potentially_hazardous_asteroid": "event_type = 'error'",
    "close_approach_date": "CAST(ts AS DATE)",
    "close_approach_date_full": ("date_format(ts, 'yyyy-MMM-dd HH:mm')", "strftime(ts, '%Y-%b-%d %H:%M')"),
    "epoch_date_close_approach": (
        "CAST(datediff(ts, DATE '1970-01-01') AS BIGINT) * 86400000",
        "CAST(date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS BIGINT) * 86400000",
    ),
    "relative_velocity_kilometers_per_second": "value / 6",
    "relative_velocity_kilometers_per_hour": "value * 600",
    "relative_velocity_miles_per_hour": "value * 373",
    "miss_distance_astronomical": "value / 100",
    "miss_distance_lunar": "value * 4",
    "miss_distance_kilometers": "value * 1496000",
    "miss_distance_miles": "value * 930000",
    "orbiting_body": "event_type",
    "is_sentry_object": "user_id < 20",
}


def _pair(expression: str | tuple[str, str]) -> tuple[str, str]:
    return expression if isinstance(expression, tuple) else (expression, expression)


def approaches(df: DataFrame, binding: dict, *also: Column) -> DataFrame:
    """A table's rows as the 25 approach columns, and `also`."""
    return df.select(*also, *(F.expr(_pair(binding[name])[0]).alias(name) for name in APPROACH_COLUMNS))


def approaches_sql(name: str, binding: dict, also: str = "") -> str:
    columns = ", ".join(f"{_pair(binding[column])[1]} AS {column}" for column in APPROACH_COLUMNS)
    return f"SELECT {also}{columns} FROM {name}"


def lineitem_approaches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return approaches(table(spark, sf_dir, "lineitem"), LINEITEM)


LINEITEM_SQL = approaches_sql("lineitem", LINEITEM)


def events_approaches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as approach rows, with the day they would be stored under as `feed_date`."""
    return approaches(table(spark, sf_dir, "events"), EVENTS, F.expr("CAST(ts AS DATE)").alias("feed_date"))


def spread(rows: DataFrame, key: str) -> DataFrame:
    """Rows dealt out by a key with many values: writing and parsing JSON is heavy per row."""
    return rows.repartition(key)


def as_object(object_id: Column, magnitude: Column | None = None, with_approach: Column | None = None) -> Column:
    """An approach row as a feed object; another approach follows, whose every value differs and must not be taken.

    Distances are quoted numbers and velocities bare ones; the flatten reads both alike.
    """

    def diameter(unit: str) -> Column:
        return F.struct(
            *(F.col(f"estimated_diameter_{end}_{unit}").alias(f"estimated_diameter_{end}") for end in ("min", "max"))
        ).alias(unit)

    speeds = ("kilometers_per_second", "kilometers_per_hour", "miles_per_hour")
    distances = ("astronomical", "lunar", "kilometers", "miles")
    approach = F.struct(
        F.col("close_approach_date").cast("string").alias("close_approach_date"),
        "close_approach_date_full",
        "epoch_date_close_approach",
        F.struct(*(F.col(f"relative_velocity_{u}").alias(u) for u in speeds)).alias("relative_velocity"),
        F.struct(*(F.col(f"miss_distance_{u}").cast("string").alias(u) for u in distances)).alias("miss_distance"),
        "orbiting_body",
    )
    later = F.struct(
        F.lit("2999-12-31").alias("close_approach_date"),
        F.lit("2999-Dec-31 00:00").alias("close_approach_date_full"),
        (F.col("epoch_date_close_approach") + 1).alias("epoch_date_close_approach"),
        F.struct(*((F.col(f"relative_velocity_{u}") + 1).alias(u) for u in speeds)).alias("relative_velocity"),
        F.struct(*((F.col(f"miss_distance_{u}") + 1).cast("string").alias(u) for u in distances)).alias("miss_distance"),
        F.lit("Elsewhere").alias("orbiting_body"),
    )
    approaches_ = F.array(approach, later)
    if with_approach is not None:
        approaches_ = F.when(with_approach, approaches_)
    return F.struct(
        object_id.alias("id"),
        "name",
        "nasa_jpl_url",
        (F.col("absolute_magnitude_h") if magnitude is None else magnitude).alias("absolute_magnitude_h"),
        F.struct(*(diameter(unit) for unit in ("kilometers", "meters", "miles", "feet"))).alias("estimated_diameter"),
        "is_potentially_hazardous_asteroid",
        approaches_.alias("close_approach_data"),
        "is_sentry_object",
    )


def as_document(day: Column) -> Column:
    """An approach row as a day's document: two objects that count, and an empty third that does not."""
    objects = F.array(as_object(F.col("id")), as_object(F.concat("id", F.lit("b"))), F.lit(None))
    return encode_feed(F.lit(2), F.create_map(F.date_format(day, "yyyy-MM-dd"), objects))


def documents(rows: DataFrame, text: Column, *also: str) -> DataFrame:
    """Documents made from rows, as `value`.

    The explode sets the text apart: otherwise the optimizer would copy its long expression
    into everything that reads a part of it.
    """
    return rows.select(*also, F.explode(F.array(text)).alias("value"))


def document_rows_sql(rows: str) -> str:
    """What flattening the documents of `rows` gives."""
    columns = ", ".join(APPROACH_COLUMNS)
    second = columns.replace("id,", "id || 'b' AS id,", 1)
    return f"WITH a AS ({rows}) SELECT {columns} FROM a UNION ALL SELECT {second} FROM a"

