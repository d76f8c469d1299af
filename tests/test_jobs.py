from datetime import date
from functools import partial

import pytest
from conftest import TEN_ROWS, approach_frame, rows
from feeds import document, land, neo
from pyspark.sql import functions as F
from test_clusters import AS_OF
from test_clusters import MARTS as CLUSTERS
from test_clusters import PREFIX
from test_periods import MARTS as PERIODS

from perigee.operators.flatten import SHORT_LIST
from perigee.plans import jobs
from perigee.plans.ingest import NO_DOCUMENT, FeedErrors
from perigee.plans.marts import APPROACH_MARTS, CLUSTER_MARTS, KPI_MARTS
from perigee.sinks.days import write_days
from perigee.sinks.feed import publish_files
from perigee.sinks.marts import read_mart
from perigee.sources.stores import read_days, read_union

ALL = {**{name: spec for name, spec in PERIODS.items()}, **{PREFIX + name: spec for name, spec in CLUSTERS.items()}}


def stored(spark, root, picked):
    frame = approach_frame(spark, picked)
    write_days(frame.withColumn("feed_date", F.coalesce("close_approach_date", F.lit(date(2024, 6, 1)))), root)
    return root


@pytest.fixture()
def stores(spark, tmp_path):
    """Six of the ten rows as history, four as live."""
    return (
        stored(spark, str(tmp_path / "hist"), TEN_ROWS[:6]),
        stored(spark, str(tmp_path / "live"), TEN_ROWS[6:]),
    )


def assert_marts(spark, out, names):
    from conftest import expected

    for name in names:
        columns, values = ALL[name]
        assert rows(read_mart(spark, f"{out}/{name}"), *columns) == expected(values), name


def test_backfill_takes_the_days_asked_for(spark, tmp_path):
    days = [f"2024-01-{d:02d}" for d in range(1, 10)]
    land(tmp_path / "in", "a.json", *(document({day: [neo(int(day[-2:]), day)]}) for day in days))
    for _ in range(2):
        jobs.backfill(spark, str(tmp_path / "in"), str(tmp_path / "out"), date(2024, 1, 3), date(2024, 1, 5))
        assert rows(read_days(spark, str(tmp_path / "out")), "id") == [("3",), ("4",), ("5",)]


def test_backfill_of_whole_files(spark, tmp_path):
    text = document({"2024-01-01": [neo(1)]}).replace(", ", ",\n")
    land(tmp_path / "in", "a.json", text)
    jobs.backfill(
        spark, str(tmp_path / "in"), str(tmp_path / "out"), date(2024, 1, 1), date(2024, 1, 1), whole_files=True
    )
    assert rows(read_days(spark, str(tmp_path / "out")), "id") == [("1",)]


def test_backfill_stores_the_good_days_and_fails(spark, tmp_path):
    land(
        tmp_path / "in",
        "a.json",
        document({"2024-01-01": [neo(1)]}),
        document({"2024-01-02": [neo(2)]}, count=3),
        document({"2024-01-09": [neo(9)]}, count=3),
    )
    out = str(tmp_path / "out")
    with pytest.raises(FeedErrors) as raised:
        jobs.backfill(spark, str(tmp_path / "in"), out, date(2024, 1, 1), date(2024, 1, 3))
    assert (raised.value.count, raised.value.path) == (2, f"{out}_errors")
    assert rows(read_days(spark, out), "id") == [("1",)]
    assert rows(spark.read.parquet(f"{out}_errors"), "feed_date", "reason") == [
        (date(2024, 1, 2), SHORT_LIST),
        (date(2024, 1, 3), NO_DOCUMENT),
    ]


def test_empty_day_has_no_partition(spark, tmp_path):
    land(tmp_path / "in", "a.json", document({"2024-01-01": []}), document({"2024-01-02": [neo(1)]}))
    jobs.backfill(spark, str(tmp_path / "in"), str(tmp_path / "out"), date(2024, 1, 1), date(2024, 1, 2))
    assert [p.name for p in (tmp_path / "out/year=2024/month=1").iterdir()] == ["day=2"]


def test_relay_and_live_job(spark, tmp_path):
    land(tmp_path / "in", "a.json", document({"2024-01-01": [neo(1)]}), "{}")
    jobs.relay(spark, str(tmp_path / "in"), partial(publish_files, path=str(tmp_path / "sent")))
    for _ in range(2):
        jobs.live(spark, str(tmp_path / "sent"), str(tmp_path / "out"), str(tmp_path / "checkpoint"))
        assert rows(read_days(spark, str(tmp_path / "out")), "id") == [("1",)]


def test_union_job_keeps_both_stores(spark, tmp_path, stores):
    out = str(tmp_path / "union")
    for _ in range(2):
        jobs.union(spark, *stores, out)
        assert rows(read_union(spark, out)) == rows(approach_frame(spark, TEN_ROWS))
    jobs.union(spark, stores[0], stores[0], out)
    assert read_union(spark, out).count() == 12


def test_union_job_for_some_days(spark, tmp_path, stores):
    out = str(tmp_path / "union")
    jobs.union(spark, *stores, out)
    stored(spark, stores[1], [("new", date(2024, 5, 1), *[None] * 6), ("late", date(2024, 5, 2), *[None] * 6)])
    stored(spark, stores[0], [("unseen", date(2023, 11, 5), *[None] * 6)])
    jobs.union(spark, *stores, out, start=date(2024, 5, 1))
    ids = [i for (i,) in rows(read_union(spark, out), "id")]
    assert "new" in ids and "late" in ids and "9" not in ids and "unseen" not in ids
    assert len(ids) == 11


def test_mart_jobs(spark, tmp_path, stores):
    union, out = str(tmp_path / "union"), str(tmp_path / "out")
    jobs.union(spark, *stores, union)
    for _ in range(2):
        jobs.approach_marts(spark, union, out)
        jobs.cluster_marts(spark, union, out, AS_OF)
        jobs.kpi_marts(spark, union, out)
        assert_marts(spark, out, ALL)


def test_daily_job(spark, tmp_path, stores):
    out = str(tmp_path / "out")
    jobs.daily(spark, *stores, out, AS_OF, database="marts")
    assert_marts(spark, out, ALL)
    assert len(ALL) == len(APPROACH_MARTS) + len(CLUSTER_MARTS) + len(KPI_MARTS) == 17
    assert spark.sql("SELECT * FROM marts.total_close_approaches").collect()[0][0] == 10
    # The marts, the union table, the rollup and the date of the run.
    assert spark.sql("SHOW VIEWS IN marts").count() == 20


def test_daily_job_with_new_days_only(spark, tmp_path):
    """Taking in the last days on their own gives what a full run gives."""
    hist = stored(spark, str(tmp_path / "hist"), TEN_ROWS[:6])
    live = stored(spark, str(tmp_path / "live"), [TEN_ROWS[6], ("gone", date(2024, 5, 1), *[None] * 6)])
    out = str(tmp_path / "out")
    jobs.daily(spark, hist, live, out, AS_OF)
    stored(spark, live, TEN_ROWS[7:])
    jobs.daily(spark, hist, live, out, AS_OF, start=date(2024, 4, 1))
    assert_marts(spark, out, ALL)
    # The horizon moves with the date of the run, without any new rows.
    jobs.daily(spark, hist, live, out, date(2024, 4, 1), start=date(2025, 1, 1))
    moved = read_mart(spark, f"{out}/{PREFIX}asteroid_hazardous_close_approach_clusters")
    assert rows(moved.filter("hazard_cluster = 'Hazardous'"), "approach_cluster", "num_asteroids") == [
        ("Near Future", 4)
    ]
