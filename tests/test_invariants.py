"""Relations between the marts that hold for any rows."""

import random
from datetime import date, timedelta

import pytest
from conftest import approach_frame, rows
from pyspark.sql import functions as F

from perigee.operators.flatten import flatten_feed
from perigee.plans.marts import (
    APPROACH_MARTS,
    CLUSTER_MARTS,
    KPI_MARTS,
    cluster_mart,
    cluster_mart_from_parts,
    day_counts,
)
from perigee.plans.rollup import approach_rollup, rollup_cluster_parts


def maybe(rng, value):
    return None if rng.random() < 0.1 else value


def random_rows(seed, n):
    rng = random.Random(seed)
    edges = [0.1, 1, 5, 10, 15, 20, 25]
    number = lambda: maybe(rng, float(rng.choice(edges)) if rng.random() < 0.3 else rng.uniform(0, 30))
    return [
        (
            maybe(rng, str(i)),
            maybe(rng, date(2022, 11, 1) + timedelta(days=int(rng.triangular(0, 800, 60)))),
            maybe(rng, rng.random() < 0.5),
            number(),
            number(),
            number(),
            number(),
            maybe(rng, rng.choice(["Earth", "Mars", "Venus"])),
        )
        for i in range(n)
    ]


@pytest.mark.parametrize("seed, n", [(1, 3), (2, 60), (3, 700)])
def test_marts_agree(spark, seed, n):
    picked = random_rows(seed, n)
    frame = approach_frame(spark, picked)
    days = day_counts(frame)
    mart = {name: rows(build(days)) for name, build in {**APPROACH_MARTS, **KPI_MARTS}.items()}
    months = mart["kpi/monthly_avg_close_approaches"]
    years = mart["kpi/yearly_avg_close_approaches"]
    assert mart["kpi/total_close_approaches"] == [(n,)]
    assert sum(m[1] for m in months) == sum(y[1] for y in years) == n

    best = max(m[1] for m in months)
    peaks = mart["close-approach-analysis/asteroid_monthly_no_close_approaches"]
    assert {m[0] for m in months if m[1] == best} == {m for m, _ in peaks}
    assert mart["kpi/peak_month"][0] in peaks
    assert mart["kpi/peak_year"][0] in mart["close-approach-analysis/asteroid_yearly_no_close_approach"]

    first = min((m[0] or "", m[1]) for m in months)[1]
    changes = [row[3] for row in mart["kpi/monthly_change"] if row[3] is not None]
    last = max((m[0] or "", m[1]) for m in months)[1]
    assert sum(changes) == last - first

    ids = sum(row[0] is not None for row in picked)
    as_of = date(2023, 6, 1)
    parts = rollup_cluster_parts(approach_rollup(frame), as_of)
    for spec in CLUSTER_MARTS.values():
        direct = cluster_mart(spec, frame, as_of)
        assert direct.agg(F.sum("num_asteroids")).collect()[0][0] == ids
        assert rows(cluster_mart_from_parts(spec, parts)) == rows(direct)


def test_rollup_counts_days_like_the_rows(spark):
    frame = approach_frame(spark, random_rows(5, 400))
    assert rows(day_counts(approach_rollup(frame), weight="row_count")) == rows(day_counts(frame))


def test_flatten_gives_as_many_rows_as_are_counted(spark):
    from feeds import document, neo

    rng = random.Random(8)
    counts, documents = 0, []
    for i in range(60):
        objects = [neo(f"{i}-{j}", approaches=rng.randint(1, 3)) for j in range(rng.randint(0, 4))]
        count = rng.randint(0, len(objects))
        counts += count
        documents.append((document({f"20{i % 30:02d}-01-01": objects}, count=count),))
    frame = spark.createDataFrame(documents, "value string").repartition(5)
    assert flatten_feed(frame).count() == counts
