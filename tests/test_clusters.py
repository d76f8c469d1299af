from datetime import date

import pytest
from pyspark.sql import functions as F
from conftest import approach_frame, expected, rows

from perigee.plans.marts import CLUSTER_MARTS, cluster_mart, cluster_mart_from_parts, cluster_parts, summary_name
from perigee.plans.rollup import approach_rollup, rollup_cluster_parts

AS_OF = date(2024, 3, 31)
D = date
PREFIX = "clustering-based-analysis/"

MARTS = {
    "asteroid_hazardous_close_approach_clusters": (
        ["hazard_cluster", "approach_cluster", "num_asteroids", "first_approach", "last_approach"],
        [
            ("Hazardous", "Far Future", 1, D(2024, 5, 1), D(2024, 5, 1)),
            ("Hazardous", "Near Future", 3, D(2023, 11, 5), D(2024, 3, 31)),
            ("Non-Hazardous", "Far Future", 1, None, None),
            ("Non-Hazardous", "Near Future", 4, D(2023, 11, 20), D(2024, 4, 30)),
        ],
    ),
    "asteroid_size_velocity_cluster": (
        [
            "size_cluster",
            "velocity_cluster",
            "num_asteroids",
            "avg_diameter",
            "avg_velocity",
            "min_diameter",
            "max_diameter",
            "min_velocity",
            "max_velocity",
        ],
        [
            ("Large", "Fast", 2, 5.1, 25.1, 5.1, 5.1, 25.1, 25.1),
            ("Medium", "Fast", 2, 2.25, 65.0, 1.5, 3.0, 30.0, 100.0),
            ("Medium", "Moderate", 1, 3.5, 18.5, 2.0, 5.0, 12.0, 25.0),
            ("Small", "Moderate", 1, 0.2, 10.7, 0.2, 0.2, 10.7, 10.7),
            ("Small", "Slow", 3, 0.533333, 8.166667, 0.1, 1.0, 5.0, 10.0),
        ],
    ),
    "asteroid_distance_orbit_body_clusters": (
        [
            "orbiting_body",
            "distance_cluster",
            "num_asteroids",
            "avg_miss_distance",
            "min_miss_distance",
            "max_miss_distance",
        ],
        [
            (None, "Moderate", 1, 0.5, 0.5, 0.5),
            ("Earth", "Far", 1, None, None, None),
            ("Earth", "Moderate", 2, 0.95, 0.9, 1.0),
            ("Earth", "Very Close", 4, 0.0675, 0.02, 0.1),
            ("Mars", "Far", 1, 1.1, 1.1, 1.1),
            ("Venus", "Moderate", 0, 0.3, 0.3, 0.3),
        ],
    ),
    "clustered_asteroids_by_magnitude_and_diameter": (
        [
            "magnitude_cluster",
            "diameter_cluster",
            "num_asteroids",
            "avg_absolute_magnitude",
            "avg_diameter",
            "min_absolute_magnitude",
            "max_absolute_magnitude",
        ],
        [
            ("Bright", "Small", 2, 14.95, 0.6, 14.9, 15.0),
            ("Dim", "Large", 2, 20.1, 5.1, 20.1, 20.1),
            ("Dim", "Small", 2, 21.5, 0.3, 21.0, 22.0),
            ("Moderately Bright", "Medium", 3, 17.75, 2.875, 16.0, 20.0),
        ],
    ),
}


@pytest.mark.parametrize("name", list(MARTS))
def test_cluster_mart(ten, name):
    columns, values = MARTS[name]
    mart = cluster_mart(CLUSTER_MARTS[PREFIX + name], ten, AS_OF)
    assert set(mart.columns) == set(columns)
    assert rows(mart, *columns) == expected(values)
    keys = [tuple(row)[:2] for row in mart.collect()]
    assert keys == sorted(keys, key=lambda k: (k[0] is not None, k[0] or "", k[1]))


@pytest.mark.parametrize("name", list(MARTS))
def test_cluster_mart_from_parts(ten, name):
    columns, values = MARTS[name]
    for parts in (cluster_parts(ten, AS_OF), rollup_cluster_parts(approach_rollup(ten), AS_OF)):
        mart = cluster_mart_from_parts(CLUSTER_MARTS[PREFIX + name], parts)
        assert rows(mart, *columns) == expected(values)


def test_rollups_of_parts_add_up(ten):
    """Rollups taken separately and put together give the same marts."""
    both = approach_rollup(ten.filter("id < 5")).unionByName(approach_rollup(ten.filter("NOT id < 5 OR id IS NULL")))
    parts = rollup_cluster_parts(both, AS_OF)
    for name, (columns, values) in MARTS.items():
        assert rows(cluster_mart_from_parts(CLUSTER_MARTS[PREFIX + name], parts), *columns) == expected(values)


def test_rollup_has_a_grouping_for_each_mart(ten):
    """Every row is counted once in each, and none is finer than its mart needs."""
    rollup = approach_rollup(ten)
    counts = rollup.groupBy("summary").agg(F.sum("row_count").alias("n"), F.count("*").alias("groups")).collect()
    assert {row.summary: row.n for row in counts} == {summary_name(mart): 10 for mart in CLUSTER_MARTS.values()}
    assert {row.summary: row.groups for row in counts}["size_cluster velocity_cluster"] == 5


def test_horizon_moves_with_the_date(spark):
    """The end of a short month is the horizon of the last days of the month before."""
    frame = approach_frame(
        spark,
        [("a", D(2024, 2, 29), True, *[None] * 5), ("b", D(2024, 3, 1), True, *[None] * 5)],
    )
    mart = cluster_mart(CLUSTER_MARTS[PREFIX + "asteroid_hazardous_close_approach_clusters"], frame, D(2024, 1, 31))
    assert rows(mart, "approach_cluster", "last_approach") == [
        ("Far Future", D(2024, 3, 1)),
        ("Near Future", D(2024, 2, 29)),
    ]


def test_horizon_defaults_to_today(spark):
    frame = approach_frame(
        spark, [("a", D(2000, 1, 1), True, *[None] * 5), ("b", D(9000, 1, 1), True, *[None] * 5)]
    )
    mart = cluster_mart(CLUSTER_MARTS[PREFIX + "asteroid_hazardous_close_approach_clusters"], frame)
    assert rows(mart, "approach_cluster", "num_asteroids") == [("Far Future", 1), ("Near Future", 1)]
