"""JSON text of feed documents."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from perigee.schema import CORRUPT, FEED_SCHEMA


def decode_feed(text: Column) -> Column:
    """Document as a struct; text that does not fit is kept in its corrupt-record field."""
    return F.from_json(text, FEED_SCHEMA, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})


def encode_feed(element_count: Column, days: Column) -> Column:
    """Document text from a count and a map of day to object list."""
    return F.to_json(F.struct(element_count.alias("element_count"), days.alias("near_earth_objects")))
