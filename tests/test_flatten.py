from datetime import date

import pytest
from conftest import rows
from feeds import document, neo
from pyspark.sql import functions as F

from perigee.functions.documents import encode_feed
from perigee.operators import flatten
from perigee.operators.flatten import (
    BAD_DAY,
    BAD_VALUE,
    MALFORMED,
    NO_APPROACH,
    NO_COUNT,
    NO_DAYS,
    SHORT_LIST,
    feed_errors,
    flatten_feed,
)
from perigee.schema import APPROACH_COLUMNS, APPROACH_SCHEMA

DAY = "2024-01-01"


def frame(spark, *documents):
    return spark.createDataFrame([(d, i) for i, d in enumerate(documents)], "value string, number int")


def flat(spark, *documents, **range_):
    return flatten_feed(frame(spark, *documents), **range_)


def test_all_columns_and_types(spark):
    found = flat(spark, document({DAY: [neo(7)]}))
    assert found.columns == ["feed_date", *APPROACH_COLUMNS]
    assert [(f.name, f.dataType) for f in found.schema][1:] == [(f.name, f.dataType) for f in APPROACH_SCHEMA]
    assert tuple(found.collect()[0]) == (
        date(2024, 1, 1),
        "7",
        "(7)",
        "https://example.org/7",
        20.5,
        0.5,
        1.0,
        500.0,
        1000.0,
        0.3,
        0.6,
        1640.4,
        3280.8,
        True,
        date(2024, 1, 1),
        "2024-01-01 01:02",
        1704067200000,
        10.7,
        38520.0,
        23935.1,
        0.1,
        38.9,
        14959787.07,
        9295581.0,
        "Earth",
        False,
    )


def test_first_approach_only(spark):
    found = flat(spark, document({DAY: [neo(1, approaches=3)]}))
    assert rows(found, "orbiting_body") == [("Earth",)]


def test_objects_beyond_the_count_are_left_out(spark):
    found = flat(spark, document({DAY: [neo(1), neo(2), neo(3)]}, count=2))
    assert rows(found, "id") == [("1",), ("2",)]


def test_objects_beyond_the_count_are_not_judged(spark):
    documents = frame(spark, document({DAY: [neo(1), neo(2, close_approach_data=[])]}, count=1))
    assert feed_errors(documents).count() == 0
    assert rows(flatten_feed(documents), "id") == [("1",)]


@pytest.mark.parametrize("count", [0, -1])
def test_no_objects_no_rows(spark, count):
    documents = frame(spark, document({DAY: [neo(1)] if count else []}, count=count))
    assert flatten_feed(documents).count() == 0
    assert feed_errors(documents).count() == 0


def test_blank_lines_are_no_documents(spark):
    documents = frame(spark, "", "   ")
    assert flatten_feed(documents).count() == feed_errors(documents).count() == 0


def test_count_as_text(spark):
    assert flat(spark, document({DAY: [neo(1)]}, count="1")).count() == 1


def test_days_of_a_document(spark):
    two = document({"2024-01-01": [neo(1)], "2024-01-02": [neo(2)]}, count=1)
    assert rows(flat(spark, two), "feed_date", "id") == [(date(2024, 1, 1), "1"), (date(2024, 1, 2), "2")]
    assert rows(flat(spark, two, start=date(2024, 1, 2), end=date(2024, 1, 2)), "id") == [("2",)]
    assert rows(flat(spark, two, start=date(2024, 1, 3)), "id") == []


def test_days_out_of_range_are_not_judged(spark):
    documents = frame(spark, document({DAY: [neo(1)]}, count=5))
    assert feed_errors(documents).count() == 1
    assert feed_errors(documents, start=date(2024, 1, 2)).count() == 0
    assert feed_errors(documents, end=date(2023, 12, 31)).count() == 0


ERRORS = {
    "not json": ("not json", None, MALFORMED),
    "cut off": (document({DAY: [neo(1)]})[:-40], None, MALFORMED),
    "a list": ("[1, 2]", None, MALFORMED),
    "nested value of another kind": (document({DAY: [neo(1, estimated_diameter="big")]}), date(2024, 1, 1), MALFORMED),
    "no count": ('{"near_earth_objects": {"2024-01-01": []}}', date(2024, 1, 1), NO_COUNT),
    "count that is no number": (document({DAY: []}, count="many"), date(2024, 1, 1), NO_COUNT),
    "no days": ('{"element_count": 1}', None, NO_DAYS),
    "empty map of days": (document({}, count=0), None, NO_DAYS),
    "bad day": (document({"2024-1-1": [neo(1)]}), None, BAD_DAY),
    "impossible day": (document({"2024-02-30": [neo(1)]}), None, BAD_DAY),
    "short list": (document({DAY: [neo(1)]}, count=5), date(2024, 1, 1), SHORT_LIST),
    "null list": (document({DAY: None}, count=1), date(2024, 1, 1), SHORT_LIST),
    "no approach": (document({DAY: [neo(1), neo(2, close_approach_data=[])]}), date(2024, 1, 1), NO_APPROACH),
    "null approaches": (document({DAY: [neo(1, close_approach_data=None)]}), date(2024, 1, 1), NO_APPROACH),
    "bad number": (document({DAY: [neo(1, absolute_magnitude_h="bright")]}), date(2024, 1, 1), BAD_VALUE),
    "bad flag": (document({DAY: [neo(1, is_sentry_object="maybe")]}), date(2024, 1, 1), BAD_VALUE),
    "bad date": (document({"2024-01-01": [neo(1, day="soon")]}), date(2024, 1, 1), BAD_VALUE),
}


@pytest.mark.parametrize("case", list(ERRORS))
def test_errors(spark, case):
    text, day, reason = ERRORS[case]
    documents = frame(spark, text, document({"2024-01-09": [neo(9)]}))
    assert rows(feed_errors(documents), "number", "feed_date", "reason", "value") == [(0, day, reason, text)]
    assert rows(flatten_feed(documents), "id") == [("9",)]


def test_missing_values_are_null(spark):
    found = flat(spark, document({DAY: [neo(1, name=None, absolute_magnitude_h=None)]}))
    assert rows(found, "name", "absolute_magnitude_h") == [(None, None)]


def test_encode_then_flatten(spark):
    """A document read and written again flattens to the same rows."""
    from pyspark.sql import functions as F

    from perigee.functions.documents import decode_feed

    first = frame(spark, document({DAY: [neo(1, approaches=2), neo(2)]}))
    again = first.withColumn("feed", decode_feed(F.col("value"))).select(
        encode_feed(F.col("feed.element_count"), F.col("feed.near_earth_objects")).alias("value")
    )
    assert rows(flatten_feed(again)) == rows(flatten_feed(first))


def test_whole_numbers_are_not_rounded(spark):
    texts = ["2", "2.0", "-7.000", "2.0000004", "2.5", "1.5e3", "1e-1", " 4 ", "", "x", "9223372036854775807", "9223372036854775808", None]
    frame = spark.createDataFrame([(t,) for t in texts], "t string").select("t", flatten._whole(F.col("t"), "bigint").alias("n"))
    assert [row.n for row in frame.collect()] == [2, 2, -7, None, None, 1500, None, 4, None, None, 2**63 - 1, None, None]
