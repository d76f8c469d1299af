"""What a store has taken in: a row for each time a day's list was written, with the digest of the list."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perigee.schema import DAY_PARTITIONS
from perigee.sinks.files import exists
from perigee.sources.stores import read_days

LEDGER = "feed_date DATE, digest STRING, written_at TIMESTAMP"


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger at `path`: feed_date, digest, written_at."""
    return spark.read.schema(LEDGER).parquet(path) if exists(spark, path) else spark.createDataFrame([], LEDGER)


def with_digest(lists: DataFrame) -> DataFrame:
    """Day lists with `digest`, equal for lists of equal objects in equal order, and whether they have objects."""
    text = F.to_json("objects", {"ignoreNullFields": "false"})
    return lists.withColumns({"digest": F.sha2(text, 256), "filled": F.size("objects") > 0})


def changed_days(lists: DataFrame, ledger: DataFrame, store: str) -> DataFrame:
    """feed_date and digest of the lists (feed_date, digest, filled) that are not what the store at `store` has.

    A day is unchanged if the ledger's last digest for it is the list's, and the store still has the day (a list
    without objects has none there). One row per day and task is shuffled.
    """
    spark = lists.sparkSession
    last = ledger.groupBy("feed_date").agg(F.max_by("digest", "written_at").alias("known"))
    found = lists.join(last, "feed_date", "left")
    if exists(spark, store):
        days = read_days(spark, store, partitions=True).select(*DAY_PARTITIONS).distinct()
        days = days.select(F.make_date(*DAY_PARTITIONS).alias("feed_date"), F.lit(True).alias("stored"))
        found = found.join(days, "feed_date", "left")
    else:
        found = found.withColumn("stored", F.lit(None).cast("boolean"))
    same = F.col("known").eqNullSafe(F.col("digest")) & (F.col("stored").isNotNull() | ~F.col("filled"))
    return found.filter(~same).select("feed_date", "digest")


def enter(days: DataFrame, path: str) -> None:
    """Add days (feed_date, digest) that were just written."""
    days.withColumn("written_at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(path)
