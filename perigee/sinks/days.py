"""Day stores and the union table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perigee.functions.dates import day_parts
from perigee.schema import APPROACH_COLUMNS, DAY_PARTITIONS
from perigee.sinks.files import COMPRESSION, remove

# Tasks that share a day. Small ones are packed together again by adaptive execution.
WAYS = 8


def write_days(df: DataFrame, root: str, day: str = "feed_date", clustered: bool = False) -> None:
    """Write approach rows as one partition per day; a day written again is replaced.

    Only the days present in `df` are touched. Rows are brought together by day through a
    rebalance, which packs small days and splits large ones: a day is dealt to several tasks from the start,
    so one with a third of all rows is not left to the size at which partitions are split. `clustered`
    says each day already sits in one task and is small, so the shuffle is left out.
    """
    rows = df.select(*APPROACH_COLUMNS, *(part.alias(name) for name, part in day_parts(F.col(day)).items()))
    if not clustered:
        rows = dealt(rows, DAY_PARTITIONS)
    write_partitions(rows, root, DAY_PARTITIONS)


def dealt(rows: DataFrame, partitions: tuple[str, ...]) -> DataFrame:
    """Rows brought together by partition, each partition in a bounded number of shares."""
    way = F.pmod(F.xxhash64("id", "close_approach_date_full"), F.lit(WAYS))
    return rows.withColumn("__way", way).hint("rebalance", *partitions, "__way").drop("__way")


def write_partitions(df: DataFrame, root: str, partitions: tuple[str, ...]) -> None:
    """Replace the partitions present in `df`; the others stay."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", COMPRESSION)
    writer.partitionBy(*partitions).parquet(root)


def partition_values(rows: DataFrame, partitions: tuple[str, ...]) -> list[dict]:
    """The partitions that `rows` are in. One row for each comes to the driver."""
    return [row.asDict() for row in rows.select(*partitions).distinct().collect()]


def drop_partitions(root: str, partitions: tuple[str, ...], stored: DataFrame, wanted: DataFrame) -> list[dict]:
    """Remove the partitions of `stored` that `wanted` does not have, and give them.

    Both are read for their partition values only. What comes to the driver is one row per day that goes.
    """
    gone = stored.select(*partitions).join(wanted.select(*partitions).distinct(), list(partitions), "left_anti")
    dropped = partition_values(gone, partitions)
    for values in dropped:
        place = "/".join(f"{name}={values[name]}" for name in partitions)
        remove(stored.sparkSession, f"{root.rstrip('/')}/{place}")
    return dropped
