from __future__ import annotations

import sys
from datetime import date
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from perigee.schema import APPROACH_SCHEMA  # noqa: E402
from perigee.session import build_session  # noqa: E402

# id, date, hazardous, magnitude, diameter, velocity, miss distance, body
TEN_ROWS = [
    ("1", date(2023, 11, 5), True, 15.0, 1.0, 10.0, 0.1, "Earth"),
    ("2", date(2023, 11, 20), False, 20.0, 5.0, 25.0, 1.0, "Earth"),
    ("3", date(2023, 12, 1), False, 20.1, 5.1, 25.1, 1.1, "Mars"),
    ("4", date(2024, 1, 10), None, None, None, None, None, "Earth"),
    ("5", date(2024, 1, 11), True, 14.9, 0.2, 10.7, 0.05, "Earth"),
    ("6", date(2024, 3, 1), False, 18.0, 3.0, 100.0, 0.5, None),
    ("7", date(2024, 3, 31), True, 22.0, 0.5, 9.5, 0.02, "Earth"),
    (None, date(2024, 4, 30), False, 17.0, 2.0, 12.0, 0.3, "Venus"),
    ("9", date(2024, 5, 1), True, 16.0, 1.5, 30.0, 0.1, "Earth"),
    ("10", None, False, 21.0, 0.1, 5.0, 0.9, "Earth"),
]
TEN_COLUMNS = (
    "id",
    "close_approach_date",
    "is_potentially_hazardous_asteroid",
    "absolute_magnitude_h",
    "estimated_diameter_min_kilometers",
    "relative_velocity_kilometers_per_second",
    "miss_distance_astronomical",
    "orbiting_body",
)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def approach_frame(spark, rows):
    """Approach rows from tuples of the ten-row columns; all other columns are null."""
    full = [tuple(dict(zip(TEN_COLUMNS, row)).get(name) for name in APPROACH_SCHEMA.names) for row in rows]
    return spark.createDataFrame(full, APPROACH_SCHEMA)


@pytest.fixture(scope="session")
def ten(spark):
    return approach_frame(spark, TEN_ROWS)


def rows(df, *columns):
    """Rows as a sorted list of tuples, floats rounded."""

    def plain(value):
        return round(value, 6) if isinstance(value, float) else value

    picked = df.select(*columns) if columns else df
    return sorted((tuple(plain(v) for v in row) for row in picked.collect()), key=repr)


def expected(values):
    return sorted((tuple(v) for v in values), key=repr)
