"""What the plans look like, since that decides how they scale."""

import io
import re
from contextlib import redirect_stdout
from datetime import date

import pytest
from conftest import TEN_ROWS, approach_frame
from feeds import document, neo
from pyspark.sql import functions as F

from perigee.operators.days import newest_per_day
from perigee.operators.flatten import feed_errors, flatten_feed
from perigee.operators.periods import peak_periods, period_counts, top_period
from perigee.plans.marts import (
    APPROACH_MARTS,
    CLUSTER_MARTS,
    KPI_MARTS,
    cluster_mart,
    cluster_mart_from_parts,
    cluster_parts,
    day_counts,
)
from perigee.plans.rollup import approach_rollup
from perigee.session import work_table
from perigee.sinks.days import write_days
from perigee.sources.stores import read_days


def plan(df):
    text = io.StringIO()
    with redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


def read_columns(text):
    return [re.findall(r"(\w+):", schema) for schema in re.findall(r"ReadSchema: struct<(.*?)>\n", text)]


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("plans") / "days")
    frame = approach_frame(spark, TEN_ROWS[:9]).withColumn("feed_date", F.col("close_approach_date"))
    write_days(frame, root)
    return root


@pytest.mark.parametrize("name", [*APPROACH_MARTS, *KPI_MARTS])
def test_period_marts_read_one_column(spark, store, name):
    text = plan({**APPROACH_MARTS, **KPI_MARTS}[name](day_counts(read_days(spark, store))))
    assert read_columns(text) == [["close_approach_date"]]
    # Rows are counted before the first shuffle; after the second, all is in one partition.
    assert text.count("partial_count") == 1
    assert len(re.findall(r"^\(\d+\) Exchange", text, re.M)) == 2


def test_cluster_marts_read_what_they_summarize(spark, store):
    for spec in CLUSTER_MARTS.values():
        text = plan(cluster_mart(spec, read_days(spark, store), date(2024, 1, 1)))
        (columns,) = read_columns(text)
        assert "id" in columns and len(columns) <= 3
        assert "partial_count" in text


def test_rollup_and_parts_read_once(spark, store):
    for summary in (approach_rollup, cluster_parts):
        (columns,) = read_columns(plan(summary(read_days(spark, store))))
        assert len(columns) == 8


def test_marts_from_stored_summaries_shuffle_nothing(spark, store):
    days = work_table(day_counts(read_days(spark, store)), "days").coalesce(1)
    parts = work_table(cluster_parts(read_days(spark, store)), "parts").coalesce(1)
    marts = [build(days) for build in {**APPROACH_MARTS, **KPI_MARTS}.values()]
    marts += [cluster_mart_from_parts(mart, parts) for mart in CLUSTER_MARTS.values()]
    assert not any("Exchange" in plan(mart) for mart in marts)


def test_day_range_prunes_partitions(spark, store):
    text = plan(read_days(spark, store, date(2024, 1, 1), date(2024, 2, 1)).select("id"))
    assert re.search(r"PartitionFilters: \[.*make_date", text)
    assert read_columns(text) == [["id"]]


def test_documents_are_parsed_once_without_a_shuffle(spark, tmp_path):
    (tmp_path / "a.json").write_text(document({"2024-01-01": [neo(1)]}))
    text = plan(flatten_feed(spark.read.text(str(tmp_path))))
    assert text.count("from_json(StructField(element_count") == 1
    assert "Exchange" not in text


@pytest.mark.parametrize("step", [flatten_feed, feed_errors])
def test_objects_are_converted_once(spark, tmp_path, step):
    (tmp_path / "a.json").write_text(document({"2024-01-01": [neo(1)]}))
    optimized = step(spark.read.text(str(tmp_path)))._jdf.queryExecution().optimizedPlan().toString()
    assert optimized.count("transform(") == 1


@pytest.mark.parametrize("step", [flatten_feed, feed_errors])
def test_values_are_looked_up_once(spark, tmp_path, step):
    (tmp_path / "a.json").write_text(document({"2024-01-01": [neo(1)]}))
    optimized = step(spark.read.text(str(tmp_path)))._jdf.queryExecution().optimizedPlan().toString()
    assert optimized.count(".miss_distance.lunar") == 1


def test_newest_per_day_keeps_one_row_per_task(spark):
    rows = spark.range(9).selectExpr("id % 2 AS day", "id AS place", "id")
    text = plan(newest_per_day(rows, "day", "place", ["id"]))
    assert "partial_max_by" in text and "Window" not in text


def test_candidates_of_a_day_meet_in_several_tasks(spark):
    rows = spark.range(0, 4000, 1, 8).selectExpr("id % 2 AS day", "id", "id * 7 % 4001 AS place")
    spread = newest_per_day(rows, "day", "place", ["id"], ways=3)
    text = plan(spread)
    assert re.search(r"hashpartitioning\(day#\w+, way#", text)
    assert text.count("partial_max_by") == 2
    assert sorted(map(tuple, spread.collect())) == sorted(
        map(tuple, newest_per_day(rows, "day", "place", ["id"]).collect())
    )


def test_ranks_are_limited_before_the_shuffle(spark, ten):
    months = period_counts(ten, "close_approach_date", "month")
    assert "WindowGroupLimit" in plan(peak_periods(months))
    assert "TakeOrderedAndProject" in plan(top_period(months))


def test_no_python_and_no_cross_joins(spark, store):
    approaches = read_days(spark, store)
    frames = [build(day_counts(approaches)) for build in {**APPROACH_MARTS, **KPI_MARTS}.values()]
    frames += [cluster_mart(spec, approaches) for spec in CLUSTER_MARTS.values()]
    frames.append(approach_rollup(approaches))
    for frame in frames:
        text = plan(frame)
        assert not re.search(r"Python|Pandas|Cartesian|NestedLoop", text)
