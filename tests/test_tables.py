"""Tables in versions, their catalog entries, and stores taken over by the types of their files."""

from datetime import date, timedelta
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from conftest import TEN_ROWS, approach_frame, rows
from pyspark.sql import functions as F

from perigee.plans import jobs
from perigee.schema import APPROACH_SCHEMA
from perigee.session import work_scope, work_table
from perigee.sinks.days import write_days
from perigee.sinks.files import COMPLETE, current_path, remove, replace_directory, versions
from perigee.sinks.marts import Touched, read_mart, register_table, unregister_table, write_mart
from perigee.sources import stores
from perigee.sources.stores import file_types, read_plain_days, read_union


# --- versions ---------------------------------------------------------------------------------


def test_replacing_keeps_the_version_before(spark, tmp_path):
    path = str(tmp_path / "t")
    for number in range(1, 5):
        replace_directory(spark.range(number), path)
        assert read_mart(spark, path).count() == number
    assert [Path(place).name[:11] for place in versions(spark, path)] == ["v0000000003", "v0000000004"]


def test_readers_keep_the_version_they_began_with(spark, tmp_path):
    path = str(tmp_path / "t")
    replace_directory(spark.range(5), path)
    began = read_mart(spark, path)
    broken = spark.range(100).select(F.when(F.col("id") == 99, F.raise_error(F.lit("no"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="no"):
        replace_directory(broken, path)
    assert began.count() == 5 and read_mart(spark, path).count() == 5
    replace_directory(read_mart(spark, path).filter("id > 1"), path)
    assert began.count() == 5 and read_mart(spark, path).count() == 3
    assert len(list(Path(path).iterdir())) == 2


def test_a_version_without_its_mark_does_not_count(spark, tmp_path):
    """As a writer leaves it that was lost between its rows and the mark."""
    path = str(tmp_path / "t")
    replace_directory(spark.range(5), path)
    lost = replace_directory(spark.range(9), path)
    (Path(lost) / COMPLETE).unlink()
    assert read_mart(spark, path).count() == 5
    replace_directory(spark.range(7), path)
    assert read_mart(spark, path).count() == 7 and current_path(spark, path) != lost


def test_rows_without_a_version_are_read_until_they_are_replaced(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(4).write.parquet(path)
    assert read_mart(spark, path).count() == 4
    for number in (6, 8):
        replace_directory(spark.range(number), path)
        assert read_mart(spark, path).count() == number
    assert all(place.name.startswith("v") for place in Path(path).iterdir())


# --- catalog ----------------------------------------------------------------------------------


@pytest.fixture()
def name(spark, tmp_path):
    found = f"table_{abs(hash(str(tmp_path)))}"
    yield found
    unregister_table(spark, found)


def test_a_table_is_shown_throughout(spark, tmp_path, name):
    path = str(tmp_path / "t")
    for number in range(1, 5):
        write_mart(spark.range(number), path)
        register_table(spark, name, path)
        assert spark.table(name).count() == number
    entries = [table.name for table in spark.catalog.listTables() if table.name.startswith(f"{name}__")]
    assert len(entries) == 2
    unregister_table(spark, name)
    assert not spark.catalog.tableExists(name) and read_mart(spark, path).count() == 4


def test_other_columns_are_shown_at_once(spark, tmp_path, name):
    write_mart(spark.range(3), str(tmp_path / "a"))
    write_mart(spark.range(4).select(F.col("id").cast("string").alias("word")), str(tmp_path / "b"))
    for place, columns in (("a", ["id"]), ("b", ["word"]), ("a", ["id"])):
        register_table(spark, name, str(tmp_path / place))
        assert spark.table(name).columns == columns


def test_what_was_not_registered_here_is_refused(spark, tmp_path, name):
    path = str(tmp_path / "t")
    write_mart(spark.range(3), path)
    spark.range(9).write.saveAsTable(f"{name}_managed")
    spark.sql(f"CREATE VIEW {name}_view AS SELECT 1 AS one")
    spark.range(2).createOrReplaceTempView(f"{name}_temporary")
    for kind in ("managed", "view", "temporary"):
        with pytest.raises(ValueError, match="not registered here"):
            register_table(spark, f"{name}_{kind}", path)
    assert spark.table(f"{name}_managed").count() == 9 and spark.table(f"{name}_view").count() == 1
    spark.sql(f"DROP TABLE {name}_managed")
    spark.sql(f"DROP VIEW {name}_view")
    spark.catalog.dropTempView(f"{name}_temporary")


def test_an_external_table_makes_way_and_keeps_its_files(spark, tmp_path, name):
    spark.range(5).write.parquet(str(tmp_path / "old"))
    spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{tmp_path / 'old'}'")
    write_mart(spark.range(3), str(tmp_path / "t"))
    register_table(spark, name, str(tmp_path / "t"))
    assert spark.table(name).count() == 3 and spark.read.parquet(str(tmp_path / "old")).count() == 5


def test_only_touched_partitions_are_entered(spark, tmp_path, name):
    path = str(tmp_path / "t")
    frame = spark.range(12).select("id", F.concat(F.lit("it's "), F.col("id") % 3).alias("store"), (F.col("id") % 4).cast("int").alias("day"))
    place = replace_directory(frame.filter("day < 2"), path, ("store", "day"))
    register_table(spark, name, path)
    frame.filter("day >= 2").write.mode("append").partitionBy("store", "day").parquet(place)
    remove(spark, f"{place}/store=it%27s 0/day=0")
    register_table(spark, name, path, Touched([{"store": "it's 1", "day": 2}], [{"store": "it's 0", "day": 0}]))
    # What was not named, here all of day 3, stays unknown: nothing was listed.
    wanted = frame.filter("(day < 2 AND NOT (store = \"it's 0\" AND day = 0)) OR (store = \"it's 1\" AND day = 2)")
    assert rows(spark.table(name).select("id")) == rows(wanted.select("id"))
    register_table(spark, name, path)
    assert spark.table(name).filter("day = 3").count() == 3


def _stored(spark, root, picked):
    frame = approach_frame(spark, picked)
    write_days(frame.withColumn("feed_date", F.coalesce("close_approach_date", F.lit(date(2024, 6, 1)))), root)
    return root


def test_daily_job_keeps_the_catalog_by_day(spark, tmp_path):
    hist, live = _stored(spark, str(tmp_path / "hist"), TEN_ROWS[:4]), _stored(spark, str(tmp_path / "live"), TEN_ROWS[6:])
    out, base = str(tmp_path / "out"), f"base_{abs(hash(str(tmp_path)))}"
    jobs.daily(spark, hist, live, out, database=base)
    union, rollup = f"{base}.{jobs.UNION_TABLE}", f"{base}.{jobs.ROLLUP_TABLE}"
    assert spark.table(union).count() == 8
    remove(spark, f"{live}/year=2024/month=3/day=31")
    _stored(spark, hist, TEN_ROWS[4:6])
    jobs.daily(spark, hist, live, out, start=date(2024, 1, 1), end=date(2024, 4, 1), database=base)
    assert rows(spark.table(union), "id") == rows(read_union(spark, f"{out}/union"), "id")
    assert spark.table(union).count() == 9
    assert spark.table(rollup).count() == read_mart(spark, f"{out}/rollup").count()
    assert spark.table(f"{base}.total_close_approaches").first()[0] == 9
    jobs.daily(spark, hist, live, out, database=base)
    assert spark.table(union).count() == 9
    spark.sql(f"DROP DATABASE {base} CASCADE")


def test_one_date_for_a_run(spark, tmp_path, monkeypatch):
    """The date is fixed when the run begins, and kept; what the clock says later does not matter."""
    root = _stored(spark, str(tmp_path / "days"), TEN_ROWS)
    asked = []
    monkeypatch.setattr(jobs, "today", lambda spark: asked.append(1) or date(2024, 1, 1))
    jobs.daily(spark, root, root, str(tmp_path / "out"))
    assert len(asked) == 1
    assert rows(read_mart(spark, str(tmp_path / "out/run"))) == [(date(2024, 1, 1),)]
    jobs.daily(spark, root, root, str(tmp_path / "given"), date(2024, 1, 1))
    mart = "clustering-based-analysis/asteroid_hazardous_close_approach_clusters"
    assert rows(read_mart(spark, f"{tmp_path}/out/{mart}")) == rows(read_mart(spark, f"{tmp_path}/given/{mart}"))


def test_horizon_query_is_the_same_on_all_days(spark):
    from perigee.catalog.cluster_queries import horizon_today

    frame = spark.range(-60, 120).select(F.date_add(F.lit(date(1998, 6, 30)), F.col("id").cast("int")).alias("l_shipdate"))

    def seen(day):
        return rows(frame.select("l_shipdate", horizon_today(F.lit(day), day).alias("h")))

    first = seen(date(2024, 1, 30))
    for day in (date(2023, 1, 31), date(2024, 2, 29), date(2025, 2, 28), date(2026, 12, 4)):
        assert seen(day) == first
    assert {h for _, h in first} == {"near", "far"}


# --- taking over plain stores -----------------------------------------------------------------


def _file(root, day, **values):
    path = root / f"{day.year}/{day.month:02d}/{day.day:02d}.parquet"
    path.parent.mkdir(parents=True, exist_ok=True)
    columns = {"id": pa.array([str(day)] * 4), "close_approach_date": pa.array([str(day)] * 4)}
    columns |= {name: value if isinstance(value, pa.Array) else pa.array([value] * 4) for name, value in values.items()}
    pq.write_table(pa.table(columns | {"__index_level_0__": pa.array(range(4))}), path, row_group_size=1)


def test_files_are_read_in_one_scan_for_each_set_of_types(spark, tmp_path, monkeypatch):
    for number in range(12):
        value = (1, 1.5, "2.5")[number % 3]
        _file(tmp_path, date(2024, 1, 1) + timedelta(days=number), absolute_magnitude_h=value)
    _file(tmp_path, date(2024, 2, 1), absolute_magnitude_h=pa.nulls(4), orbiting_body=pa.nulls(4), epoch_date_close_approach=7.0)
    taken = read_plain_days(spark, str(tmp_path))
    assert taken._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") == 4
    assert "binaryFile" not in taken._jdf.queryExecution().toString()
    found = taken.groupBy("month", "absolute_magnitude_h", "epoch_date_close_approach", "orbiting_body").count()
    assert rows(found) == [(1, 1.0, None, None, 16), (1, 1.5, None, None, 16), (1, 2.5, None, None, 16), (2, None, 7, None, 4)]
    assert [f.dataType for f in taken.schema][:25] == [f.dataType for f in APPROACH_SCHEMA]
    # A store that tasks cannot open: Spark tells the types, and the rows are the same.
    monkeypatch.setattr(stores.re, "sub", lambda pattern, with_, path: f"only-spark:{path}")
    assert rows(read_plain_days(spark, str(tmp_path)).groupBy("month", "absolute_magnitude_h").count()) == [
        (1, 1.0, 16), (1, 1.5, 16), (1, 2.5, 16), (2, None, 4),
    ]


def test_a_large_file_is_read_by_several_tasks(spark, tmp_path):
    _file(tmp_path, date(2024, 1, 1), name="x" * 1000)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    try:
        taken = read_plain_days(spark, str(tmp_path))
        assert taken.rdd.getNumPartitions() > 1 and taken.count() == 4
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_fractions_are_no_whole_numbers(spark, tmp_path):
    _file(tmp_path, date(2024, 1, 1), epoch_date_close_approach=7.5)
    with pytest.raises(Exception, match="not a whole number"):
        read_plain_days(spark, str(tmp_path)).collect()


def test_other_files_are_refused(spark, tmp_path):
    _file(tmp_path, date(2024, 1, 1))
    spark.range(1).write.parquet(str(tmp_path / "other"))
    with pytest.raises(ValueError, match="not a day file"):
        read_plain_days(spark, str(tmp_path))


def test_an_empty_store(spark, tmp_path):
    (tmp_path / "2024/01").mkdir(parents=True)
    assert read_plain_days(spark, str(tmp_path)).count() == 0 and file_types(spark, []) == {}


def test_work_tables_go_with_their_scope(spark):
    def place(frame):
        return Path(frame.inputFiles()[0].removeprefix("file://")).parent

    with work_scope(spark):
        with work_scope(spark):
            step, kept = work_table(spark.range(3), "step"), work_table(spark.range(4), "kept", keep=True)
            inner, outer = place(step), place(kept)
        assert not inner.exists() and kept.count() == 4
    assert not outer.exists()
    with work_scope(spark):
        result = work_table(spark.range(5), "result", keep=True)
    assert result.count() == 5
