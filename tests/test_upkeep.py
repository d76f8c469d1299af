"""Sums that do not hang on the order of rows, resumed backfills, landing folders that empty, answers from footers."""

import math
import random
from datetime import date
from fractions import Fraction

import pytest
from conftest import TEN_ROWS, approach_frame, rows
from feeds import document, land, neo
from pyspark.sql import functions as F

from perigee.operators.profiles import exact_mean
from perigee.plans import jobs
from perigee.plans.ingest import FeedErrors
from perigee.plans.ledger import read_ledger
from perigee.plans.marts import CLUSTER_MARTS, cluster_mart, cluster_mart_from_parts, cluster_parts
from perigee.plans.rollup import approach_rollup, rollup_cluster_parts
from perigee.sinks.days import write_days
from perigee.sinks.files import current_path
from perigee.sources.feed import stream_feed
from perigee.sources.footers import footer_session, summaries, union_summary
from perigee.sources.stores import read_days

# --- sums -------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def uneven(spark):
    """Approach rows with measures of very different sizes."""
    r = random.Random(2)
    picked = []
    for i in range(3000):
        size = r.choice((1e-7, 0.3, 7.0, 1e6, 1e9)) * r.random() * r.choice((1, 1, -1))
        picked.append((str(i), date(2024, 1, 1 + i % 28), i % 3 == 0, size, r.random() * 9, r.random() * 40, size / 7, "ab"[i % 2]))
    return approach_frame(spark, picked).cache()


@pytest.mark.parametrize("name", [name for name, mart in CLUSTER_MARTS.items() if mart.averages])
def test_means_are_the_same_to_the_last_bit(uneven, name):
    mart, found = CLUSTER_MARTS[name], []
    for partitions in (1, 8, 64):
        dealt = uneven.repartition(partitions, F.rand(partitions))
        paths = (
            cluster_mart(mart, dealt, date(2024, 1, 1)),
            cluster_mart_from_parts(mart, cluster_parts(dealt, date(2024, 1, 1))),
            cluster_mart_from_parts(mart, rollup_cluster_parts(approach_rollup(dealt), date(2024, 1, 1))),
        )
        found += [sorted((tuple(row) for row in path.collect()), key=repr) for path in paths]
    assert all(x == found[0] for x in found)


def test_means_are_right(spark):
    r = random.Random(7)
    values = [r.choice((1e-9, 1.0, 1e5, 1e12, 1e15)) * r.uniform(-1, 1) for _ in range(2000)]
    got = spark.createDataFrame([(v,) for v in values], "v double").agg(exact_mean("v")).first()[0]
    assert got == pytest.approx(float(sum(map(Fraction, values)) / len(values)), rel=1e-12)
    assert spark.createDataFrame([(0.1,)] * 10, "v double").agg(exact_mean("v")).first()[0] == 0.1


@pytest.mark.parametrize(
    ("values", "mean"),
    [([], None), ([None], None), ([None, 2.0], 2.0), ([float("nan"), 1.0], float("nan")), ([float("inf"), 1.0], float("inf")),
     ([float("inf"), float("-inf")], float("nan")), ([1e300, 1e300], 1e300), ([-0.25, -0.25], -0.25)],
)
def test_means_of_odd_values(spark, values, mean):
    got = spark.createDataFrame([(v,) for v in values], "v double").agg(exact_mean("v")).first()[0]
    assert got == mean or (math.isnan(got) and math.isnan(mean))


# --- resuming ---------------------------------------------------------------------------------


def _writes(spark, path):
    return rows(read_ledger(spark, path).groupBy(F.dayofmonth("feed_date")).count())


def test_only_changed_days_are_written_again(spark, tmp_path):
    places = [str(tmp_path / name) for name in ("in", "out")]
    start, end, ledger = date(2024, 1, 1), date(2024, 1, 4), str(tmp_path / "ledger")
    days = {f"2024-01-0{d}": [neo(d)] for d in (1, 2, 3)}
    land(tmp_path / "in", "a.json", *(document({day: found}) for day, found in days.items()), document({"2024-01-04": []}))
    jobs.backfill(spark, *places, start, end, ledger=ledger)
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "out").rglob("*.parquet")}
    land(tmp_path / "in", "b.json", document({"2024-01-02": [neo(9)]}), document({"2024-01-03": [neo(3)]}))
    jobs.backfill(spark, *places, start, end, ledger=ledger)
    assert rows(read_days(spark, places[1]), "id") == [("1",), ("3",), ("9",)]
    assert _writes(spark, ledger) == [(1, 1), (2, 2), (3, 1), (4, 1)]
    after = {p: p.stat().st_mtime_ns for p in (tmp_path / "out").rglob("*.parquet")}
    assert {p.parent.name for p in before if p in after} == {"day=1", "day=3"}
    assert all(after[p] == before[p] for p in before if p in after)


def test_a_day_that_left_the_store_is_written_again(spark, tmp_path):
    places = [str(tmp_path / name) for name in ("in", "out")]
    land(tmp_path / "in", "a.json", document({"2024-01-01": [neo(1)]}), document({"2024-01-02": [neo(2)]}))
    for _ in range(2):
        jobs.backfill(spark, *places, date(2024, 1, 1), date(2024, 1, 2), ledger=str(tmp_path / "ledger"))
        for path in (tmp_path / "out/year=2024/month=1/day=2").glob("*"):
            path.unlink()
        (tmp_path / "out/year=2024/month=1/day=2").rmdir()
    jobs.backfill(spark, *places, date(2024, 1, 1), date(2024, 1, 2), ledger=str(tmp_path / "ledger"))
    assert read_days(spark, places[1]).count() == 2
    assert _writes(spark, str(tmp_path / "ledger")) == [(1, 1), (2, 3)]


def test_unusable_days_are_not_entered(spark, tmp_path):
    land(tmp_path / "in", "a.json", document({"2024-01-01": [neo(1)]}), document({"2024-01-02": [neo(2)]}, count=5))
    with pytest.raises(FeedErrors):
        jobs.backfill(
            spark, str(tmp_path / "in"), str(tmp_path / "out"), date(2024, 1, 1), date(2024, 1, 2), ledger=str(tmp_path / "ledger")
        )
    assert _writes(spark, str(tmp_path / "ledger")) == [(1, 1)]


# --- landing folders --------------------------------------------------------------------------


def test_second_run_lists_only_what_is_new(spark, tmp_path):
    root = {name: str(tmp_path / name) for name in ("in", "out", "cp", "archive")}

    def run():
        jobs.live(spark, root["in"], root["out"], root["cp"], archive=root["archive"], keep_seen="30d")

    def landed():
        return sorted(p.name for p in (tmp_path / "in").iterdir() if not p.name.startswith("."))

    land(tmp_path / "in", "a b.json", document({"2024-01-01": [neo(1)]}))
    land(tmp_path / "in", "c.json", document({"2024-01-02": [neo(2)]}))
    run()
    assert landed() == []
    land(tmp_path / "in", "d.json", document({"2024-01-02": [neo(3)]}))
    assert landed() == ["d.json"]
    run()
    run()
    assert landed() == [] and rows(read_days(spark, root["out"]), "id") == [("1",), ("3",)]
    assert sorted(p.name for p in (tmp_path / "archive").rglob("*.json") if not p.name.startswith(".")) == ["a b.json", "c.json", "d.json"]


def test_files_a_lost_run_left_are_put_away_by_the_next(spark, tmp_path):
    """A run that stored its days and got no further; Spark itself moves its files when a later batch begins."""
    root = {name: str(tmp_path / name) for name in ("in", "out", "cp", "archive")}
    land(tmp_path / "in", "a.json", document({"2024-01-01": [neo(1)]}))
    jobs.live(spark, stream_feed(spark, root["in"], archive=root["archive"]), root["out"], root["cp"])
    assert (tmp_path / "in/a.json").exists()
    land(tmp_path / "in", "b.json", document({"2024-01-02": [neo(2)]}))
    jobs.live(spark, root["in"], root["out"], root["cp"], archive=root["archive"])
    assert not list((tmp_path / "in").glob("*.json")) and read_days(spark, root["out"]).count() == 2


# --- footers ----------------------------------------------------------------------------------


@pytest.fixture()
def union_table(spark, tmp_path):
    for name, picked in (("hist", TEN_ROWS[:6]), ("live", TEN_ROWS[6:])):
        frame = approach_frame(spark, picked)
        write_days(frame.withColumn("feed_date", F.coalesce("close_approach_date", F.lit(date(2024, 6, 1)))), str(tmp_path / name))
    jobs.union(spark, str(tmp_path / "hist"), str(tmp_path / "live"), str(tmp_path / "union"))
    return str(tmp_path / "union")


def test_footers_answer_the_total(spark, union_table):
    asked = footer_session(spark).read.parquet(current_path(spark, union_table)).agg(*summaries(["close_approach_date"]))
    plan = spark._jvm.PythonSQLUtils.explainString(asked._jdf.queryExecution(), "formatted")
    assert "PushedAggregation: [COUNT(*), MIN(close_approach_date), MAX(close_approach_date)]" in plan
    assert rows(jobs.total_mart(spark, union_table)) == [(10,)]
    assert rows(union_summary(spark, union_table, by=["store"])) == [("hist", 6), ("live", 4)]
    assert rows(union_summary(spark, union_table, start=date(2024, 1, 1), end=date(2024, 3, 31))) == [(4,)]
    assert spark.conf.get("spark.sql.sources.useV1SourceList") != ""


def test_columns_without_bounds_are_read(spark, union_table):
    """A day whose only row has no date has no bounds in its footer."""
    found = union_summary(spark, union_table, ["close_approach_date", "absolute_magnitude_h"])
    assert rows(found) == [(10, date(2023, 11, 5), date(2024, 5, 1), 14.9, 22.0)]


def test_groups_of_other_columns_are_refused(spark, union_table):
    with pytest.raises(ValueError, match="orbiting_body"):
        union_summary(spark, union_table, by=["orbiting_body"])
