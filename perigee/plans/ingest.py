"""Feed documents to a day store, for batch and stream alike."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perigee.operators.days import day_range
from perigee.operators.flatten import day_lists, flatten_lists
from perigee.plans.ledger import changed_days, enter, read_ledger, with_digest
from perigee.session import work_table
from perigee.sinks.days import write_days
from perigee.sinks.files import COMPRESSION, exists, remove

NO_DOCUMENT = "no document for the day"


class FeedErrors(RuntimeError):
    """Some days or documents could not be stored; the error table says which and why."""

    def __init__(self, count: int, path: str):
        super().__init__(f"{count} day lists could not be used, see {path}")
        self.count = count
        self.path = path


def newest_lists(lists: DataFrame) -> DataFrame:
    """Of several lists of a day, the one with the greatest position.

    The position is found on the two narrow columns, one row per task and day; the lists themselves are
    neither sorted nor grouped. `lists` is stored, so the position is the same in both reads.
    """
    newest = lists.groupBy("feed_date").agg(F.max("position").alias("position"))
    return lists.join(work_table(newest, "newest"), ["feed_date", "position"])


def ingest(
    documents: DataFrame,
    out: str,
    errors: str,
    start: date | None = None,
    end: date | None = None,
    every_day: bool = False,
    ledger: str | None = None,
    tasks: int | None = None,
) -> int:
    """Write the newest usable list of each day to the day store at `out`; returns how many lists were unusable.

    The documents are parsed once, and what they hold is stored as a work table that the rest reads.
    Unusable lists go to `errors`, in place of what is there. With `every_day`, days from `start` to `end`
    that no document has count as unusable too. With `ledger`, days whose list is what the store has already are
    left alone, and the days written are entered there; a run that is lost in between writes them again. With `tasks`,
    documents are dealt to so many tasks before they are parsed, for a few files that a task each must read whole. A day is a single document and its list stays in one task, so the
    write needs no shuffle.
    """
    # Lines of one file block have the same origin; one task reads them in order, and the id follows.
    position = F.struct("origin", F.monotonically_increasing_id().alias("row"))
    landed = documents.select("value", position.alias("position"))
    if tasks:
        landed = landed.repartition(tasks, "position")
    lists = work_table(day_lists(landed, start, end), "lists", compression=COMPRESSION)
    usable = F.col("reason").isNull()
    newest = newest_lists(lists.filter(usable))
    if ledger is None:
        write_days(flatten_lists(newest), out, clustered=True)
    else:
        spark = documents.sparkSession
        digests = with_digest(newest).select("feed_date", "digest", "filled")
        changed = work_table(changed_days(digests, read_ledger(spark, ledger), out), "changed")
        write_days(flatten_lists(newest.join(changed.select("feed_date"), "feed_date", "left_semi")), out, clustered=True)
        enter(changed, ledger)
    bad = lists.filter(~usable).drop("objects")
    if every_day:
        days = day_range(documents.sparkSession, start, end).withColumnRenamed("day", "feed_date")
        absent = days.join(lists.select("feed_date").distinct(), "feed_date", "left_anti")
        bad = bad.unionByName(absent.withColumn("reason", F.lit(NO_DOCUMENT)), allowMissingColumns=True)
    bad = work_table(bad, "errors")
    unusable = bad.count()
    if unusable:
        bad.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(errors)
    elif exists(documents.sparkSession, errors):
        remove(documents.sparkSession, errors)
    return unusable
