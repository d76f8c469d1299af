"""The jobs. Each takes paths, and writes what it says."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perigee.operators.union import union_stores
from perigee.plans.ingest import FeedErrors, ingest
from perigee.plans.marts import (
    APPROACH_MARTS,
    CLUSTER_MARTS,
    KPI_MARTS,
    cluster_mart_from_parts,
    cluster_parts,
    day_counts,
)
from perigee.plans.rollup import approach_rollup, rollup_cluster_parts
from perigee.schema import APPROACH_COLUMNS, STORE_PARTITIONS
from perigee.session import work_table
from perigee.sinks.days import drop_partitions, partition_values, write_partitions
from perigee.sinks.files import current_path, replace_directory
from perigee.sinks.marts import Touched, read_mart, register_table, write_mart
from perigee.sources.feed import read_feed, stream_feed
from perigee.sources.footers import union_summary
from perigee.sources.stores import in_days, read_days, read_union
from perigee.streaming.live import run_live

MARTS_AT_ONCE = 4
# Fixed value: the union table's name. The rollup's is ours.
UNION_TABLE = "asteroid_union_data"
ROLLUP_TABLE = "asteroid_rollup"
TOTAL = KPI_MARTS["kpi/total_close_approaches"].keywords["n"]


def backfill(
    spark: SparkSession,
    landing: str,
    out: str,
    start: date,
    end: date,
    errors: str | None = None,
    whole_files: bool = False,
    ledger: str | None = None,
) -> None:
    """Store the days from `start` to `end` of all landed documents.

    Raises FeedErrors after the usable days are stored if some documents were not usable, or if
    some of the days have no document at all; the error table lists both. With `ledger`, a run that is started again
    writes only the days whose lists are not stored yet, or not in that form.
    """
    errors = errors or f"{out}_errors"
    unusable = ingest(read_feed(spark, landing, whole_files), out, errors, start, end, every_day=True, ledger=ledger)
    if unusable:
        raise FeedErrors(unusable, errors)


def relay(
    spark: SparkSession, landing: str, publish: Callable[[DataFrame], None], whole_files: bool = False
) -> None:
    """Publish landed documents as messages, by way of `publish_topic` or `publish_files` with its target bound."""
    documents = read_feed(spark, landing, whole_files)
    if whole_files:
        # A task of the scan takes some thirty files, however small; each task would publish a file of its own.
        documents = documents.coalesce(16 * spark.sparkContext.defaultParallelism)
    publish(documents)


def live(
    spark: SparkSession,
    source: str | DataFrame,
    out: str,
    checkpoint: str,
    errors: str | None = None,
    ledger: str | None = None,
    archive: str | None = None,
    keep_seen: str | None = None,
    tasks: int | None = None,
) -> None:
    """Store the days of messages that arrived since the last run.

    `source` is a landing folder, or a stream of documents such as `stream_topic` gives. Of a landing folder, files are
    moved below `archive` when they are stored, if it is given. `ledger` is as for `backfill`.
    With `tasks`, the documents of a batch are dealt to so many tasks, for batches of few compressed files.
    """
    landed = isinstance(source, str)
    documents = stream_feed(spark, source, archive=archive, keep_seen=keep_seen) if landed else source
    run_live(documents, out, checkpoint, errors or f"{out}_errors", ledger, archive if landed else None, tasks)


def union(
    spark: SparkSession, hist: str, live: str, out: str, start: date | None = None, end: date | None = None
) -> Touched | None:
    """Write both stores to the union table, duplicates kept.

    With `start` or `end`, only those days are read and replaced; days in that range that the stores no longer
    have go, and the partitions written and dropped are given. Else the table is replaced by a new version. The
    stores have brought each day together already, so nothing is shuffled: a task writes the days of the files it reads,
    a large day being several tasks', and a day gets no more files than its store has for it (or splits of them).
    """
    stores = {
        name: read_days(spark, root, start, end, partitions=True).withColumn("store", F.lit(name))
        for name, root in (("hist", hist), ("live", live))
    }
    rows = union_stores(stores["hist"], stores["live"]).select(*APPROACH_COLUMNS, *STORE_PARTITIONS)
    return _renew(spark, rows, rows, out, start, end)


def rollup(
    spark: SparkSession, union_table: str, out: str, start: date | None = None, end: date | None = None
) -> Touched | None:
    """Write the rollup of the union table, or renew it for some days only, as `union` does."""
    rows = read_union(spark, union_table, start, end, partitions=True)
    # The grouping scatters each day over all tasks; without the rebalance each would write every day.
    parts = approach_rollup(rows, by=STORE_PARTITIONS).hint("rebalance", *STORE_PARTITIONS)
    return _renew(spark, parts, rows, out, start, end)


def _renew(
    spark: SparkSession, rows: DataFrame, wanted: DataFrame, out: str, start: date | None, end: date | None
) -> Touched | None:
    """Replace a partitioned table, or in its current version the days from `start` to `end` by what `wanted` has."""
    if start is None and end is None:
        replace_directory(rows, out, STORE_PARTITIONS)
        return None
    place = current_path(spark, out)
    write_partitions(rows, place, STORE_PARTITIONS)
    stored = in_days(spark.read.parquet(place), start, end)
    return Touched(partition_values(wanted, STORE_PARTITIONS), drop_partitions(place, STORE_PARTITIONS, stored, wanted))


def today(spark: SparkSession) -> date:
    """The current date in the session's time zone."""
    return spark.range(1).select(F.current_date()).first()[0]


def _stored_days(counts: DataFrame) -> DataFrame:
    """Day counts as a stored table, read by one task: it has a row per day, so the calendar bounds it."""
    return work_table(counts, "days").coalesce(1)


def _period_marts(marts: Mapping[str, Callable[[DataFrame], DataFrame]], days: DataFrame) -> dict[str, DataFrame]:
    return {name: build(days) for name, build in marts.items()}


def _cluster_marts(parts: DataFrame) -> dict[str, DataFrame]:
    return {name: cluster_mart_from_parts(mart, parts) for name, mart in CLUSTER_MARTS.items()}


def _write_marts(marts: Mapping[str, DataFrame], out: str) -> None:
    """Write marts, a few at a time: each is a tiny job that mostly waits for planning and commits."""
    with ThreadPoolExecutor(MARTS_AT_ONCE) as pool:
        for written in [pool.submit(write_mart, mart, f"{out}/{name}") for name, mart in marts.items()]:
            written.result()


def approach_marts(spark: SparkSession, union_table: str, out: str) -> None:
    """The six marts on how often approaches happen, from one scan."""
    days = _stored_days(day_counts(read_union(spark, union_table)))
    _write_marts(_period_marts(APPROACH_MARTS, days), out)


def cluster_marts(spark: SparkSession, union_table: str, out: str, as_of: date | None = None) -> None:
    """The four profiles of the objects, from one scan."""
    parts = work_table(cluster_parts(read_union(spark, union_table), as_of or today(spark)), "parts")
    _write_marts(_cluster_marts(parts), out)


def kpi_marts(spark: SparkSession, union_table: str, out: str) -> None:
    """The seven KPIs, from one scan."""
    days = _stored_days(day_counts(read_union(spark, union_table)))
    _write_marts(_period_marts(KPI_MARTS, days), out)


def total_mart(spark: SparkSession, union_table: str) -> DataFrame:
    """The total of approaches, as the KPI mart has it, from the footers of the union table."""
    return union_summary(spark, union_table).select(F.col("row_count").alias(TOTAL))


def daily(
    spark: SparkSession,
    hist: str,
    live: str,
    out: str,
    as_of: date | None = None,
    start: date | None = None,
    end: date | None = None,
    database: str | None = None,
) -> None:
    """The daily run: union, rollup, then all 17 marts from the rollup.

    With `start` or `end`, the union table and the rollup are renewed for those days only, so
    a run reads the new days and the small rollup. The date that horizons count from is fixed when the run begins and kept
    beside the marts (`run`: as_of). With `database`, all become tables there, the union table and the rollup by
    partition: of a ranged run, only the days it touched are entered or taken out.
    """
    as_of = as_of or today(spark)
    changed = {
        UNION_TABLE: union(spark, hist, live, f"{out}/union", start, end),
        ROLLUP_TABLE: rollup(spark, f"{out}/union", f"{out}/rollup", start, end),
    }
    summary = read_mart(spark, f"{out}/rollup")
    days = _stored_days(day_counts(summary, weight="row_count"))
    parts = work_table(rollup_cluster_parts(summary, as_of), "parts")
    marts = {
        **_period_marts(APPROACH_MARTS, days),
        **_cluster_marts(parts),
        **_period_marts(KPI_MARTS, days),
        "run": spark.range(1).select(F.lit(as_of).alias("as_of")),
    }
    _write_marts(marts, out)
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
        for place, table in (("union", UNION_TABLE), ("rollup", ROLLUP_TABLE)):
            register_table(spark, f"{database}.{table}", f"{out}/{place}", changed[table])
        for name in marts:
            register_table(spark, f"{database}.{name.split('/')[-1]}", f"{out}/{name}")
