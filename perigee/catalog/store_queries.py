"""Stores, streams and jobs, run in a new folder below the shared one."""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Iterator
from datetime import date, timedelta
from functools import partial, reduce

import pyarrow as pa
from pyspark import TaskContext
from pyspark.errors import AnalysisException, SparkRuntimeException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perigee.catalog import cluster_queries, period_queries
from perigee.catalog.bindings import (
    EVENTS,
    LINEITEM,
    Query,
    approaches,
    approaches_sql,
    as_document,
    document_rows_sql,
    documents,
    events_approaches,
    spread,
    table,
)
from perigee.operators.days import newest_per_day
from perigee.operators.union import union_stores
from perigee.plans import jobs
from perigee.plans.ingest import NO_DOCUMENT, FeedErrors
from perigee.plans.ledger import read_ledger
from perigee.plans.marts import APPROACH_MARTS, CLUSTER_MARTS, KPI_MARTS, OBJECTS
from perigee.schema import APPROACH_COLUMNS
from perigee.session import work_dir, work_table
from perigee.sinks.days import write_days
from perigee.sinks.feed import publish_files
from perigee.sinks.files import COMPRESSION as ZSTD
from perigee.sinks.files import mounted_path, move_all, remove
from perigee.sinks.marts import read_mart, register_table, unregister_table, write_mart
from perigee.sources.feed import read_feed, stream_feed
from perigee.sources.footers import union_summary
from perigee.sources.stores import read_days, read_plain_days, read_union

COLUMNS = ", ".join(APPROACH_COLUMNS)
EVENTS_SQL = approaches_sql("events", EVENTS)

# The events lie in January 2024. The historical store ends after the live one begins.
HIST_END = date(2024, 1, 20)
LIVE_START = date(2024, 1, 18)
NEW_START = date(2024, 1, 26)
# Folders that landed files are dealt to.
FOLDERS = 16
# Of the landed documents. The text of a document is most of what the jobs on documents write.
COMPRESSION = "lz4"

# Line items are stored by the month they ship in, which keeps the partitions of seven years few.
OLD_END = date(1998, 9, 1)
RECENT_START = date(1998, 7, 1)
REMOVED = date(2000, 3, 1)
NEWEST_START = date(2001, 1, 1)
AS_OF = date(1998, 12, 15)
FEED_MONTH = "CAST(date_trunc('month', l_shipdate) AS DATE)"


# --- union ----------------------------------------------------------------------------------


def _union_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return union_stores(
        orders.filter(F.col("o_orderdate") < F.expr("TIMESTAMP_NTZ '1998-07-01'")),
        orders.filter(F.col("o_orderdate") >= F.expr("TIMESTAMP_NTZ '1998-06-01'")),
    )


_UNION_SQL = """
SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate < TIMESTAMP '1998-07-01'
UNION ALL
SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= TIMESTAMP '1998-06-01'
"""


# --- day store ------------------------------------------------------------------------------


def _day_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all days, write some of them again, read everything back."""
    rows = events_approaches(spark, sf_dir)
    root = work_dir(spark, "day_store")
    write_days(rows, root)
    write_days(rows.filter(F.col("feed_date") >= F.lit(NEW_START)), root)
    return read_days(spark, root)


def _day_store_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = work_dir(spark, "day_store_range")
    write_days(events_approaches(spark, sf_dir), root)
    return read_days(spark, root, LIVE_START, HIST_END, partitions=True)


_DAY_STORE_RANGE_SQL = f"""
WITH a AS ({EVENTS_SQL})
SELECT {COLUMNS}, CAST(year(close_approach_date) AS INTEGER) AS "year",
       CAST(month(close_approach_date) AS INTEGER) AS "month", CAST(day(close_approach_date) AS INTEGER) AS "day"
FROM a WHERE close_approach_date BETWEEN DATE '{LIVE_START}' AND DATE '{HIST_END}'
"""


# --- documents to day store -----------------------------------------------------------------


def land(spark: SparkSession, sf_dir: str, landing: str) -> None:
    """Publish a document per event, then the last one of each day once more.

    Of a day's documents the newest counts, so the day store ends up with the last event of
    each day, whatever order the files of the first round come in.
    """
    for published in _rounds(spark, sf_dir):
        publish_files(documents(published, as_document(F.col("feed_date"))), landing, COMPRESSION)


def _rounds(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """What is published first, dealt out since making documents is heavy, and then once more: the last event of each day."""
    rows = events_approaches(spark, sf_dir).withColumn("event", F.col("id").cast("bigint"))
    return spread(rows, "id"), newest_per_day(rows, "feed_date", "event", APPROACH_COLUMNS)


def _backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = work_dir(spark, "backfill")
    land(spark, sf_dir, f"{root}/landing")
    jobs.backfill(spark, f"{root}/landing", f"{root}/hist", date(2024, 1, 1), HIST_END)
    return read_days(spark, f"{root}/hist")


def _live(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stream takes all documents, and a second run finds nothing new."""
    root = work_dir(spark, "live")
    land(spark, sf_dir, f"{root}/landing")
    for _ in range(2):
        jobs.live(spark, f"{root}/landing", f"{root}/live", f"{root}/checkpoint")
    return read_days(spark, f"{root}/live")


def _last_of_day_sql(until: date | None = None) -> str:
    where = f" WHERE CAST(ts AS DATE) <= DATE '{until}'" if until else ""
    last = f"SELECT max(event_id) FROM events{where} GROUP BY CAST(ts AS DATE)"
    return document_rows_sql(f"{EVENTS_SQL} WHERE event_id IN ({last})")


def _backfill_again(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A backfill, then some days are published again and it runs again: what is stored, and how often each day was written."""
    root = work_dir(spark, "again")
    rows = spread(events_approaches(spark, sf_dir), "id").withColumn("event", F.col("id").cast("bigint"))
    last = newest_per_day(rows, "feed_date", "event", APPROACH_COLUMNS)
    first = newest_per_day(rows.withColumn("event", -F.col("event")), "feed_date", "event", APPROACH_COLUMNS)
    # Of what is published again, one half is changed and one is not.
    again = first.filter(F.day("feed_date") % 5 == 0).unionByName(last.filter(F.day("feed_date") % 5 == 1))
    for published in (last, again):
        publish_files(documents(published, as_document(F.col("feed_date"))), f"{root}/landing")
        jobs.backfill(spark, f"{root}/landing", f"{root}/hist", date(2024, 1, 1), HIST_END, ledger=f"{root}/ledger")
    written = read_ledger(spark, f"{root}/ledger").groupBy("feed_date").agg(F.count("*").alias("writes"))
    stored = read_days(spark, f"{root}/hist", partitions=True).select(F.make_date("year", "month", "day").alias("feed_date"), "id")
    return stored.join(written, "feed_date")


_BACKFILL_AGAIN_SQL = f"""
WITH d AS (
  SELECT CAST(ts AS DATE) AS feed_date, min(event_id) AS first, max(event_id) AS last FROM events
  WHERE CAST(ts AS DATE) <= DATE '{HIST_END}' GROUP BY 1),
w AS (
  SELECT feed_date, CASE WHEN day(feed_date) % 5 = 0 THEN first ELSE last END AS id,
         CASE WHEN day(feed_date) % 5 = 0 AND first <> last THEN 2 ELSE 1 END AS writes FROM d)
SELECT feed_date, CAST(id AS VARCHAR) AS id, CAST(writes AS BIGINT) AS writes FROM w
UNION ALL SELECT feed_date, CAST(id AS VARCHAR) || 'b', CAST(writes AS BIGINT) FROM w
"""


def _live_archived(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs of a stream that puts away what it has taken; the second finds the newer documents alone."""
    root = work_dir(spark, "archived")
    for published in _rounds(spark, sf_dir):
        publish_files(documents(published, as_document(F.col("feed_date"))), f"{root}/landing", COMPRESSION)
        jobs.live(
            spark, f"{root}/landing", f"{root}/live", f"{root}/checkpoint", ledger=f"{root}/ledger", archive=f"{root}/archive"
        )
        if spark.read.text(f"{root}/landing").count():
            raise RuntimeError("documents that were taken are still in the landing folder")
    return read_days(spark, f"{root}/live")


def _published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents through a landing folder; empty ones are not sent."""
    folder = f"{work_dir(spark, 'published')}/landing"
    rows = spread(events_approaches(spark, sf_dir), "id")
    empty = F.when(F.col("is_potentially_hazardous_asteroid"), F.lit("{}"))
    publish_files(rows.select(F.coalesce(empty, F.to_json(F.struct("id", "name"))).alias("value")), folder)
    return read_feed(spark, folder).select("value")


_PUBLISHED_SQL = """
SELECT '{"id":"' || event_id || '","name":"' || event_type || '"}' AS value FROM events WHERE event_type <> 'error'
"""


def _backfill_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every second day is landed: the others are reported, and the job fails when the landed ones are stored."""
    root = work_dir(spark, "missing")
    rows = spread(events_approaches(spark, sf_dir).filter(F.day("feed_date") % 2 == 0), "id")
    publish_files(documents(rows, as_document(F.col("feed_date"))), f"{root}/landing")
    try:
        jobs.backfill(spark, f"{root}/landing", f"{root}/hist", date(2024, 1, 1), HIST_END)
    except FeedErrors:
        pass
    stored = read_days(spark, f"{root}/hist", partitions=True).select(F.make_date("year", "month", "day").alias("feed_date"))
    return stored.distinct().withColumn("reason", F.lit(None).cast("string")).unionByName(
        spark.read.parquet(f"{root}/hist_errors").select("feed_date", "reason")
    )


_BACKFILL_MISSING_SQL = f"""
WITH d AS (SELECT CAST(unnest(range(DATE '2024-01-01', DATE '{HIST_END + timedelta(days=1)}', INTERVAL 1 DAY)) AS DATE) AS d),
landed AS (SELECT DISTINCT CAST(ts AS DATE) AS d FROM events WHERE day(ts) % 2 = 0)
SELECT d.d AS feed_date, CASE WHEN landed.d IS NULL THEN '{NO_DOCUMENT}' END AS reason FROM d LEFT JOIN landed ON d.d = landed.d
"""


def _live_limited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stream takes two files a batch; what is stored does not depend on it."""
    root = work_dir(spark, "limited")
    land(spark, sf_dir, f"{root}/landing")
    landed, tasks = stream_feed(spark, f"{root}/landing", max_files=2), 4 * spark.sparkContext.defaultParallelism
    jobs.live(spark, landed, f"{root}/live", f"{root}/checkpoint", tasks=tasks)
    return read_days(spark, f"{root}/live")


def land_whole(rows: DataFrame, path: str) -> None:
    """Land the `value` of each row as a file of its own, in a folder named by the row's `folder`.

    In a folder that is mounted, Spark's writer takes many times as long for a file as opening it does (by its code it
    starts a process to set the file's mode; not traced), so there the tasks write the files themselves.
    """
    spark = rows.sparkSession
    # Files take long for their size, so the number of tasks is given: otherwise rows this small would be packed into one.
    rows = rows.select("value", "folder").repartition(4 * spark.sparkContext.defaultParallelism)
    root = mounted_path(spark, path)
    if root is None:
        rows.write.option("maxRecordsPerFile", 1).partitionBy("folder").text(path)
        return
    run = uuid.uuid4().hex

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A task that is run again has the same rows and names.
        name, made, folders = f"part-{TaskContext.get().partitionId():05d}-{run}", 0, set()
        for batch in batches:
            for value, folder in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                place = f"{root}/folder={'__HIVE_DEFAULT_PARTITION__' if folder is None else folder}"
                if place not in folders:
                    os.makedirs(place, exist_ok=True)
                    folders.add(place)
                with open(f"{place}/{name}.c{made:06d}.txt", "wb") as file:
                    file.write(f"{value or ''}\n".encode())
                made += 1
        yield pa.RecordBatch.from_pydict({"made": pa.array([made], pa.int64())})

    rows.mapInArrow(write, "made long").agg(F.sum("made")).collect()


def _relayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of several lines, a file for each customer, relayed as messages of one line."""
    root = work_dir(spark, "relayed")
    text = F.expr("concat('{\\n\"id\": ', c_custkey, ',\\r\\n \"name\": \"', c_mktsegment, '\"\\n}')")
    rows = table(spark, sf_dir, "customer").select(text.alias("value"), (F.col("c_custkey") % FOLDERS).alias("folder"))
    land_whole(rows, f"{root}/landing")
    jobs.relay(spark, f"{root}/landing", partial(publish_files, path=f"{root}/messages"), whole_files=True)
    return read_feed(spark, f"{root}/messages").select("value")


_RELAYED_SQL = """
SELECT '{ "id": ' || c_custkey || ',  "name": "' || c_mktsegment || '" }' AS value FROM customer
"""


# --- marts and jobs -------------------------------------------------------------------------


def _lineitems(spark: SparkSession, sf_dir: str) -> DataFrame:
    return approaches(table(spark, sf_dir, "lineitem"), LINEITEM, F.expr(FEED_MONTH).alias("feed_date"))


def stores(spark: SparkSession, sf_dir: str, root: str, live_end: date | None = None) -> tuple[str, str]:
    rows = _lineitems(spark, sf_dir)
    newer = rows.filter(F.col("feed_date") >= F.lit(RECENT_START))
    if live_end:
        newer = newer.filter(F.col("feed_date") <= F.lit(live_end))
    write_days(rows.filter(F.col("feed_date") <= F.lit(OLD_END)), f"{root}/hist")
    write_days(newer, f"{root}/live")
    return f"{root}/hist", f"{root}/live"


_LINEITEM_DATED_SQL = approaches_sql("lineitem", LINEITEM, f"{FEED_MONTH} AS feed_date, ")
_STORES_SQL = f"""
WITH e AS ({_LINEITEM_DATED_SQL})
SELECT {COLUMNS} FROM e WHERE feed_date <= DATE '{OLD_END}'
UNION ALL
SELECT {COLUMNS} FROM e WHERE feed_date >= DATE '{RECENT_START}'
"""
_STORES_REMOVED_SQL = f"{_STORES_SQL} AND feed_date <> DATE '{REMOVED}'"


def _union_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = work_dir(spark, "union")
    jobs.union(spark, *stores(spark, sf_dir, root), f"{root}/union")
    return read_union(spark, f"{root}/union")


def _mart_columns(name: str) -> tuple[list[str], list[str]]:
    """Columns of a mart that are compared as text, and those compared as numbers: together, all it has."""
    if name in CLUSTER_MARTS:
        mart = CLUSTER_MARTS[name]
        extremes = [*mart.minima, *mart.maxima]
        dates = [c for c in extremes if {**mart.minima, **mart.maxima}[c] == "approach"]
        return [*mart.keys, *dates], [OBJECTS, *mart.averages, *(c for c in extremes if c not in dates)]
    given = {**APPROACH_MARTS, **KPI_MARTS}[name].keywords
    period = [g for g in ("Month", "Year") if g.lower() == given.get("grain") or f"_{g.lower()}ly_a" in f"_{name.split('/')[1]}"]
    return period[:1], [given[c] for c in ("n", "average", "previous", "change") if c in given]


_MARTS = (*APPROACH_MARTS, *KPI_MARTS, *CLUSTER_MARTS)
_NUMBERS = max(len(_mart_columns(name)[1]) for name in _MARTS)


def _mart_rows(spark: SparkSession, out: str) -> DataFrame:
    """All marts in one table, with every column: text columns put together, and the numbers."""

    def picked(name: str) -> DataFrame:
        mart = read_mart(spark, f"{out}/{name}")
        texts, numbers = _mart_columns(name)
        if {*texts, *numbers} != {*mart.columns}:
            raise ValueError(f"{name} has {mart.columns}")
        given = [F.col(c).cast("double") for c in numbers] + [F.lit(None).cast("double")] * _NUMBERS
        return mart.select(
            F.lit(name).alias("mart"),
            F.concat_ws("|", F.lit(""), *(F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in texts)).alias("label"),
            *(value.alias(f"number_{i}") for i, value in enumerate(given[:_NUMBERS])),
        )

    return reduce(DataFrame.unionByName, map(picked, _MARTS))


def _mart_rows_sql(stores: str = _STORES_SQL) -> str:
    sql = {**period_queries.mart_sql(stores), **cluster_queries.mart_sql(stores, AS_OF)}

    def picked(name: str) -> str:
        texts, numbers = _mart_columns(name)
        label = " || ".join(["''", *(f"'|' || coalesce(CAST({c} AS VARCHAR), '-')" for c in texts)])
        given = [f"CAST({c} AS DOUBLE)" for c in numbers] + ["CAST(NULL AS DOUBLE)"] * _NUMBERS
        values = ", ".join(f"{value} AS number_{i}" for i, value in enumerate(given[:_NUMBERS]))
        return f"SELECT '{name}' AS mart, {label} AS label, {values} FROM ({sql[name]}) AS s"

    return " UNION ALL ".join(map(picked, _MARTS))


def _daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = work_dir(spark, "daily")
    jobs.daily(spark, *stores(spark, sf_dir, root), f"{root}/out", AS_OF)
    return _mart_rows(spark, f"{root}/out")


def _daily_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A full run, then the newest days arrive and only they are taken in."""
    root = work_dir(spark, "refresh")
    hist, live = stores(spark, sf_dir, root, live_end=NEWEST_START - timedelta(days=1))
    jobs.daily(spark, hist, live, f"{root}/out", AS_OF)
    write_days(_lineitems(spark, sf_dir).filter(F.col("feed_date") >= F.lit(NEWEST_START)), live)
    jobs.daily(spark, hist, live, f"{root}/out", AS_OF, start=NEWEST_START)
    return _mart_rows(spark, f"{root}/out")


def _daily_removed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A full run, then a stored day goes, and the days around it are taken in again."""
    root = work_dir(spark, "removed")
    hist, live = stores(spark, sf_dir, root)
    jobs.daily(spark, hist, live, f"{root}/out", AS_OF)
    remove(spark, f"{live}/year={REMOVED.year}/month={REMOVED.month}/day={REMOVED.day}")
    around = timedelta(days=40)
    jobs.daily(spark, hist, live, f"{root}/out", AS_OF, start=REMOVED - around, end=REMOVED + around)
    return _mart_rows(spark, f"{root}/out")


def _mart_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three mart jobs, each on its own from the union table."""
    root = work_dir(spark, "marts")
    jobs.union(spark, *stores(spark, sf_dir, root), f"{root}/union")
    jobs.approach_marts(spark, f"{root}/union", f"{root}/out")
    jobs.cluster_marts(spark, f"{root}/union", f"{root}/out", AS_OF)
    jobs.kpi_marts(spark, f"{root}/union", f"{root}/out")
    return _mart_rows(spark, f"{root}/out")


def _plain_store(spark: SparkSession, sf_dir: str, root: str) -> None:
    """Line items as a plain store, a file for each day they ship on, in three kinds by the day of the month.

    Magnitudes are whole numbers on one kind of day; velocities are text and the body is not there on another.
    """
    # A day is one task's, so that it gets one file, and tasks are enough for each to sort its few days in memory. Line items
    # are dealt before they are widened to approach rows.
    shipped = F.expr("CAST(l_shipdate AS DATE)")
    items = table(spark, sf_dir, "lineitem").repartition(8 * spark.sparkContext.defaultParallelism, shipped)
    rows = approaches(items, LINEITEM, shipped.alias("shipped"))
    parts = {"y": "yyyy", "m": "MM", "d": "dd"}
    dated = rows.withColumns({name: F.date_format("shipped", form) for name, form in parts.items()})
    kind, speed = F.day("shipped") % 3, "relative_velocity_kilometers_per_second"
    whole = F.floor("absolute_magnitude_h").cast("bigint")
    kinds = (
        dated.filter(kind == 0).withColumn("absolute_magnitude_h", whole),
        dated.filter(kind == 1).withColumn(speed, F.col(speed).cast("string")).drop("orbiting_body"),
        dated.filter(kind == 2),
    )
    for number, own in enumerate(kinds):
        own.drop("shipped").write.partitionBy(*parts).parquet(f"{root}-{number}")
        made, day = f"{root}-{number}", r"/y=(\d+)/m=(\d+)/d=(\d+)/"
        found = {re.search(day, file).groups() for file in spark.read.schema("id string").parquet(made).inputFiles()}
        places = ((f"{made}/y={y}/m={m}/d={d}", f"{root}/{y}/{m}/{d}.parquet") for y, m, d in sorted(found))
        move_all(spark, places)


def _takeover(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = work_dir(spark, "plain")
    _plain_store(spark, sf_dir, root)
    return read_plain_days(spark, root)


def _takeover_sql() -> str:
    kind = "day(l_shipdate) % 3"
    changed = dict(LINEITEM)
    magnitude, body = changed["absolute_magnitude_h"], changed["orbiting_body"]
    changed["absolute_magnitude_h"] = f"CASE WHEN {kind} = 0 THEN floor({magnitude}) ELSE {magnitude} END"
    changed["orbiting_body"] = f"CASE WHEN {kind} <> 1 THEN {body} END"
    parts = "".join(f'CAST({part}(l_shipdate) AS INTEGER) AS "{part}", ' for part in ("year", "month", "day"))
    return approaches_sql("lineitem", changed, parts)


def _footers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the union table and the range of three measures, by store and year, from footers."""
    root = work_dir(spark, "footers")
    jobs.union(spark, *stores(spark, sf_dir, root), f"{root}/union")
    return union_summary(spark, f"{root}/union", FOOTER_COLUMNS, by=("store", "year"))


def _total_from_footers(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = work_dir(spark, "total")
    jobs.union(spark, *stores(spark, sf_dir, root), f"{root}/union")
    return jobs.total_mart(spark, f"{root}/union")


FOOTER_COLUMNS = ("estimated_diameter_min_kilometers", "miss_distance_astronomical", "epoch_date_close_approach")


def _footers_sql() -> str:
    parts = [f"min({name}) AS min_{name}, max({name}) AS max_{name}" for name in FOOTER_COLUMNS]
    stored = (("hist", f"feed_date <= DATE '{OLD_END}'"), ("live", f"feed_date >= DATE '{RECENT_START}'"))
    return f"WITH e AS ({_LINEITEM_DATED_SQL}) " + " UNION ALL ".join(
        f"""SELECT '{store}' AS store, CAST(year(feed_date) AS INTEGER) AS "year", count(*) AS row_count, {', '.join(parts)}
        FROM e WHERE {where} GROUP BY year(feed_date)"""
        for store, where in stored
    )


def _table_rows(spark: SparkSession, name: str) -> DataFrame:
    """Rows of a table whose entries go; its files stay and are read."""
    rows = spark.table(name)
    rows.schema  # resolved while the entry is there
    unregister_table(spark, name)
    return rows


def _registered_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The union table by its name in the catalog, after a stored day went, newer ones came, and a run took them in."""
    root = work_dir(spark, "catalog")
    database = f"perigee_{root.rsplit('-', 1)[1]}"
    hist, live = stores(spark, sf_dir, root, live_end=NEWEST_START - timedelta(days=1))
    jobs.daily(spark, hist, live, f"{root}/out", AS_OF, database=database)
    remove(spark, f"{live}/year={REMOVED.year}/month={REMOVED.month}/day={REMOVED.day}")
    write_days(_lineitems(spark, sf_dir).filter(F.col("feed_date") >= F.lit(NEWEST_START)), live)
    jobs.daily(spark, hist, live, f"{root}/out", AS_OF, start=REMOVED, database=database)
    rows = work_table(spark.table(f"{database}.{jobs.UNION_TABLE}").select(*APPROACH_COLUMNS), "catalog-rows", compression=ZSTD)
    spark.sql(f"DROP DATABASE `{database}` CASCADE")
    return rows


def _replaced_while_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mart read before, after a failed and after a finished replacement; readers keep the version they began with."""
    path = work_dir(spark, "replaced")
    counts = period_queries.period_counts(table(spark, sf_dir, "orders"), "o_orderdate", "month")
    write_mart(counts.filter("n <= 190"), path)
    began = read_mart(spark, path)
    try:
        fails = F.when(F.col("year") > 1996, F.raise_error(F.lit("on purpose")).cast("bigint")).otherwise(F.col("n"))
        write_mart(counts.withColumn("n", fails), path)
    except SparkRuntimeException:
        pass
    failed = read_mart(spark, path)
    write_mart(counts, path)
    seen = (("began", began), ("failed", failed), ("replaced", read_mart(spark, path)))
    return reduce(DataFrame.unionByName, (rows.withColumn("reader", F.lit(name)) for name, rows in seen))


def _registered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mart written, registered, replaced, and read by its table name."""
    path = work_dir(spark, "registered")
    name = f"perigee_orders_{path.rsplit('-', 1)[1]}"
    counts = period_queries.period_counts(table(spark, sf_dir, "orders"), "o_orderdate", "month")
    write_mart(counts.filter(F.col("n") > 100), path)
    register_table(spark, name, path)
    write_mart(counts, path)
    register_table(spark, name, path)
    return _table_rows(spark, name)


def _registered_moved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table registered for one path and set of columns, then for another."""
    path = work_dir(spark, "moved")
    name = f"perigee_moved_{path.rsplit('-', 1)[1]}"
    counts = period_queries.period_counts(table(spark, sf_dir, "orders"), "o_orderdate", "month")
    write_mart(counts.select("n").filter(F.col("n") > 100), f"{path}/old")
    register_table(spark, name, f"{path}/old")
    write_mart(counts, f"{path}/new")
    register_table(spark, name, f"{path}/new")
    return _table_rows(spark, name)


def _mart_refused(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mart written once; a second write that must not replace it is refused, and one that may empties it first."""
    path = work_dir(spark, "refused")
    counts = period_queries.period_counts(table(spark, sf_dir, "orders"), "o_orderdate", "month")
    write_mart(counts.limit(0), f"{path}/emptied")
    for name in ("kept", "emptied"):
        write_mart(counts, f"{path}/{name}", mode="error" if name == "kept" else "overwrite")
    try:
        write_mart(counts.limit(0), f"{path}/kept", mode="error")
    except AnalysisException:
        pass
    return read_mart(spark, f"{path}/kept").unionByName(read_mart(spark, f"{path}/emptied"))


_REGISTERED_SQL = period_queries.counts_sql("SELECT o_orderdate FROM orders", "o_orderdate", "month") + (
    'SELECT period, yr AS "year", n FROM c'
)
_REFUSED_SQL = period_queries.counts_sql("SELECT o_orderdate FROM orders", "o_orderdate", "month") + (
    'SELECT period, yr AS "year", n FROM c UNION ALL SELECT period, yr AS "year", n FROM c'
)

_REPLACED_SQL = period_queries.counts_sql("SELECT o_orderdate FROM orders", "o_orderdate", "month") + (
    """SELECT period, yr AS "year", n, reader FROM c, (VALUES ('began'), ('failed'), ('replaced')) AS r(reader)
    WHERE n <= 190 OR reader = 'replaced'"""
)

QUERIES: dict[str, Query] = {
    "union_overlap": Query(_union_overlap, _UNION_SQL),
    "day_store": Query(_day_store, EVENTS_SQL),
    "day_store_range": Query(_day_store_range, _DAY_STORE_RANGE_SQL),
    "publish_documents": Query(_published, _PUBLISHED_SQL),
    "backfill_job": Query(_backfill, _last_of_day_sql(HIST_END)),
    "live_job": Query(_live, _last_of_day_sql()),
    "backfill_again": Query(_backfill_again, _BACKFILL_AGAIN_SQL),
    "live_job_archive": Query(_live_archived, _last_of_day_sql()),
    "union_summary_from_footers": Query(_footers, _footers_sql()),
    "total_from_footers": Query(_total_from_footers, f"SELECT count(*) AS Total_Close_Approaches FROM ({_STORES_SQL}) AS s"),
    "backfill_missing_days": Query(_backfill_missing, _BACKFILL_MISSING_SQL),
    "live_job_file_limit": Query(_live_limited, _last_of_day_sql()),
    "relay_whole_files": Query(_relayed, _RELAYED_SQL),
    "plain_store_takeover": Query(_takeover, _takeover_sql()),
    "union_job": Query(_union_job, _STORES_SQL),
    "mart_jobs": Query(_mart_jobs, _mart_rows_sql()),
    "daily_job": Query(_daily, _mart_rows_sql()),
    "daily_job_refresh": Query(_daily_refresh, _mart_rows_sql()),
    "daily_job_refresh_removed_day": Query(_daily_removed, _mart_rows_sql(_STORES_REMOVED_SQL)),
    "registered_mart": Query(_registered, _REGISTERED_SQL),
    "registered_mart_moved": Query(_registered_moved, _REGISTERED_SQL),
    "registered_union_days": Query(_registered_days, _STORES_REMOVED_SQL),
    "mart_read_while_replaced": Query(_replaced_while_read, _REPLACED_SQL),
    "mart_refused": Query(_mart_refused, _REFUSED_SQL),
}
