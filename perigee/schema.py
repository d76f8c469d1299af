"""Column contracts of the feed documents and of the flat approach table."""

from __future__ import annotations

from pyspark.sql import types as T

# The 25 columns of the flat table, in order, with the place each one is read
# from inside a feed object and its type. "approach." stands for the first entry of the
# object's approach list. Names and places are the feed's; the types are ours.
APPROACH_FIELDS = (
    ("id", "id", "string"),
    ("name", "name", "string"),
    ("nasa_jpl_url", "nasa_jpl_url", "string"),
    ("absolute_magnitude_h", "absolute_magnitude_h", "double"),
    ("estimated_diameter_min_kilometers", "estimated_diameter.kilometers.estimated_diameter_min", "double"),
    ("estimated_diameter_max_kilometers", "estimated_diameter.kilometers.estimated_diameter_max", "double"),
    ("estimated_diameter_min_meters", "estimated_diameter.meters.estimated_diameter_min", "double"),
    ("estimated_diameter_max_meters", "estimated_diameter.meters.estimated_diameter_max", "double"),
    ("estimated_diameter_min_miles", "estimated_diameter.miles.estimated_diameter_min", "double"),
    ("estimated_diameter_max_miles", "estimated_diameter.miles.estimated_diameter_max", "double"),
    ("estimated_diameter_min_feet", "estimated_diameter.feet.estimated_diameter_min", "double"),
    ("estimated_diameter_max_feet", "estimated_diameter.feet.estimated_diameter_max", "double"),
    ("is_potentially_hazardous_asteroid", "is_potentially_hazardous_asteroid", "boolean"),
    ("close_approach_date", "approach.close_approach_date", "date"),
    ("close_approach_date_full", "approach.close_approach_date_full", "string"),
    ("epoch_date_close_approach", "approach.epoch_date_close_approach", "bigint"),
    ("relative_velocity_kilometers_per_second", "approach.relative_velocity.kilometers_per_second", "double"),
    ("relative_velocity_kilometers_per_hour", "approach.relative_velocity.kilometers_per_hour", "double"),
    ("relative_velocity_miles_per_hour", "approach.relative_velocity.miles_per_hour", "double"),
    ("miss_distance_astronomical", "approach.miss_distance.astronomical", "double"),
    ("miss_distance_lunar", "approach.miss_distance.lunar", "double"),
    ("miss_distance_kilometers", "approach.miss_distance.kilometers", "double"),
    ("miss_distance_miles", "approach.miss_distance.miles", "double"),
    ("orbiting_body", "approach.orbiting_body", "string"),
    ("is_sentry_object", "is_sentry_object", "boolean"),
)

APPROACH_COLUMNS = tuple(name for name, _, _ in APPROACH_FIELDS)

_TYPES = {
    "string": T.StringType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "bigint": T.LongType(),
}

APPROACH_SCHEMA = T.StructType([T.StructField(name, _TYPES[kind]) for name, _, kind in APPROACH_FIELDS])

# Day stores are laid out as year=/month=/day= so that a day range prunes directories.
DAY_PARTITIONS = ("year", "month", "day")
STORE_PARTITIONS = ("store", *DAY_PARTITIONS)

# Where from_json puts the text of a document it could not read in full.
CORRUPT = "_corrupt_record"

# Every scalar is read as text: from_json would turn a value of another type into a silent
# null, while text keeps quoted and bare numbers alike and lets the flatten report bad ones.
_DIAMETER = "STRUCT<estimated_diameter_min: STRING, estimated_diameter_max: STRING>"

OBJECT_TYPE = f"""STRUCT<
  id: STRING, name: STRING, nasa_jpl_url: STRING, absolute_magnitude_h: STRING,
  estimated_diameter: STRUCT<kilometers: {_DIAMETER}, meters: {_DIAMETER}, miles: {_DIAMETER}, feet: {_DIAMETER}>,
  is_potentially_hazardous_asteroid: STRING,
  close_approach_data: ARRAY<STRUCT<
    close_approach_date: STRING, close_approach_date_full: STRING, epoch_date_close_approach: STRING,
    relative_velocity: STRUCT<kilometers_per_second: STRING, kilometers_per_hour: STRING, miles_per_hour: STRING>,
    miss_distance: STRUCT<astronomical: STRING, lunar: STRING, kilometers: STRING, miles: STRING>,
    orbiting_body: STRING>>,
  is_sentry_object: STRING>"""

FEED_SCHEMA = f"""
  element_count STRING,
  near_earth_objects MAP<STRING, ARRAY<{OBJECT_TYPE}>>,
  {CORRUPT} STRING"""
