"""Counts and extremes taken from Parquet footers, without reading rows."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perigee.schema import APPROACH_SCHEMA, STORE_PARTITIONS
from perigee.sinks.files import current_path
from perigee.sources.stores import in_days

# Parquet by the data source API that takes aggregates; both settings are the session's, so it gets one of its own.
FOOTERS = {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}


def footer_session(spark: SparkSession) -> SparkSession:
    """A session beside `spark`, with its settings, in which scans of Parquet files can answer aggregates from footers."""
    beside = spark.newSession()
    for key in ("spark.sql.session.timeZone", "spark.sql.ansi.enabled"):
        beside.conf.set(key, spark.conf.get(key))
    for key, value in FOOTERS.items():
        beside.conf.set(key, value)
    return beside


def union_summary(
    spark: SparkSession,
    union_table: str,
    extremes: Sequence[str] = (),
    start: date | None = None,
    end: date | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """`row_count`, and `min_<c>` and `max_<c>` of columns, of the union table's rows, by some of its partition columns.

    Only footers are read, and of a range of days only those of its partitions. Bounds are exact for numbers and dates; a file in
    which a column has no bounds, being null throughout or holding NaN, makes the whole answer come from the rows.
    One row per group passes the driver, so `by` may hold the store and the calendar's columns only.
    """
    if unknown := {*by} - {*STORE_PARTITIONS}:
        raise ValueError(f"not partition columns: {sorted(unknown)}")
    root = current_path(spark, union_table)
    types = [T.StructField(name, T.StringType() if name == "store" else T.IntegerType()) for name in STORE_PARTITIONS]
    schema = T.StructType(APPROACH_SCHEMA.fields + types)

    def summary(session: SparkSession) -> DataFrame:
        rows = in_days(session.read.schema(schema).parquet(root), start, end)
        return rows.groupBy(*by).agg(*summaries(extremes)) if by else rows.agg(*summaries(extremes))

    asked = summary(footer_session(spark))
    try:
        found = asked.collect()
    except (PySparkException, Py4JJavaError) as refused:
        if "min/max" not in str(refused):
            raise
        found = summary(spark).collect()
    return spark.createDataFrame(found, asked.schema)


def summaries(extremes: Sequence[str]) -> list[Column]:
    bounds = (how(name).alias(f"{how.__name__}_{name}") for name in extremes for how in (F.min, F.max))
    return [F.count("*").alias("row_count"), *bounds]
