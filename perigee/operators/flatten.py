"""Feed documents to flat approach rows."""

from __future__ import annotations

from datetime import date
from functools import reduce
from itertools import count
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perigee.functions.dates import feed_day
from perigee.functions.documents import decode_feed
from perigee.schema import APPROACH_FIELDS, CORRUPT

MALFORMED = "malformed document"
NO_COUNT = "no element count"
NO_DAYS = "no day lists"
BAD_DAY = "day key is not a date"
SHORT_LIST = "fewer objects than the element count"
NO_APPROACH = "object without an approach"
BAD_VALUE = "value does not fit its column type"


def _text(obj: Column, place: str) -> Column:
    parts = place.split(".")
    if parts[0] == "approach":
        obj, parts = F.get(obj["close_approach_data"], F.lit(0)), parts[1:]
    return reduce(lambda column, part: column[part], parts, obj)


def _whole(text: Column, kind: str) -> Column:
    """Whole number of a text; one written with a fraction of nought, as 2.0, is whole. No digit is rounded away."""
    plain = F.btrim(text)
    digits = F.when(plain.rlike(r"^[+-]?[0-9]+(\.0*)?$"), F.regexp_replace(plain, r"\.0*$", ""))
    return F.coalesce(digits.try_cast(kind), _whole_power(plain).try_cast(kind))


def _whole_power(text: Column) -> Column:
    """Whole number of a text with an exponent, as 1.5e3."""
    number = F.when(text.rlike("^[+-]?[0-9.]+[eE]"), text).try_cast("double")
    return F.when((number == F.floor(number)) & (F.abs(number) < F.lit(float(1 << 53))), F.floor(number))


def _value(text: Column, kind: str) -> Column:
    return _whole(text, kind) if kind == "bigint" else text.try_cast(kind)


def _texts(obj: Column) -> Column:
    """An object's values as they were given, each looked up once: those that need a type and those that are text."""
    typed, plain = ([_text(obj, place) for _, place, kind in APPROACH_FIELDS if (kind == "string") == text] for text in (False, True))
    return F.struct(F.array(*typed).alias("typed"), F.array(*plain).alias("plain"), _no_approach(obj).alias("no_approach"))


def _typed(texts: Column) -> Column:
    """An object's values in the types of their columns, and how many of those that need one were given."""
    places = {text: (texts["plain" if text else "typed"], count()) for text in (False, True)}

    def value(kind: str) -> Column:
        held, place = places[kind == "string"]
        return _value(F.get(held, F.lit(next(place))), kind)

    return F.struct(
        *(value(kind).alias(name) for name, _, kind in APPROACH_FIELDS),
        F.size(F.array_compact(texts["typed"])).alias("given"),
        texts["no_approach"].alias("no_approach"),
    )


def _bad_value(typed: Column) -> Column:
    """Whether a value was given that did not fit."""
    doubles = F.array(*(typed[name] for name, _, kind in APPROACH_FIELDS if kind == "double"))
    others = (
        F.when(typed[name].isNotNull(), 1).otherwise(0) for name, _, kind in APPROACH_FIELDS if kind not in ("string", "double")
    )
    return typed["given"] > reduce(add, others, F.size(F.array_compact(doubles)))


def _no_approach(obj: Column) -> Column:
    return F.coalesce(F.size(obj["close_approach_data"]), F.lit(0)) < 1


def day_lists(documents: DataFrame, start: date | None = None, end: date | None = None) -> DataFrame:
    """One row per document and day: `feed_date`, the `objects` that count, typed, and what is wrong, if anything.

    `documents` has a text column `value`; its other columns are carried along. Blank lines are
    no documents. The first `element_count` objects of a day count. `reason` is null for a list that can be used. A
    list is judged whole, so a day is written complete or not at all. With `start` or `end`,
    only days in that inclusive range remain, plus documents whose day cannot be told.
    """
    carried = documents.columns
    value = F.col("value")
    lists = (
        documents.filter(value.isNull() | (F.trim(value) != ""))
        .withColumn("feed", decode_feed(value))
        .select(
            *carried,
            F.col(f"feed.{CORRUPT}").isNotNull().alias("malformed"),
            _whole(F.col("feed.element_count"), "int").alias("element_count"),
            F.explode_outer("feed.near_earth_objects").alias("day_key", "listed"),
        )
        .withColumn("feed_date", feed_day(F.col("day_key")))
    )
    if start is not None:
        lists = lists.filter(F.col("feed_date").isNull() | (F.col("feed_date") >= F.lit(start)))
    if end is not None:
        lists = lists.filter(F.col("feed_date").isNull() | (F.col("feed_date") <= F.lit(end)))

    wanted = F.greatest("element_count", F.lit(0))
    objects = F.slice(F.coalesce("listed", F.array().cast(lists.schema["listed"].dataType)), F.lit(1), wanted)
    # An object's texts are looked up before they are cast, since looking up costs as much; there is nothing to zip with.
    texts = F.transform(objects, _texts)
    converted = F.zip_with(texts, F.array().cast("array<int>"), lambda given, _: _typed(given))
    # The explode sets the typed objects apart: a filter on `reason` would otherwise be pushed below them with a copy of
    # the whole conversion for each place where it looks at them.
    typed = lists.select(
        *carried, "malformed", "element_count", "day_key", "feed_date", F.explode(F.array(converted)).alias("objects")
    )
    reason = (
        F.when(F.col("malformed"), MALFORMED)
        .when(F.col("element_count").isNull(), NO_COUNT)
        .when(F.col("day_key").isNull(), NO_DAYS)
        .when(F.col("feed_date").isNull(), BAD_DAY)
        .when(F.size("objects") < wanted, SHORT_LIST)
        .when(F.exists("objects", lambda o: o["no_approach"]), NO_APPROACH)
        .when(F.exists("objects", _bad_value), BAD_VALUE)
    )
    return typed.select(*carried, "feed_date", "objects", reason.alias("reason"))


def flatten_lists(lists: DataFrame) -> DataFrame:
    """One row per object of usable day lists: `feed_date` and the 25 approach columns."""
    return lists.select("feed_date", F.explode("objects").alias("object")).select(
        "feed_date",
        *(f"object.{name}" for name, _, _ in APPROACH_FIELDS),
    )


def flatten_feed(documents: DataFrame, start: date | None = None, end: date | None = None) -> DataFrame:
    """Flat rows of every usable day list of every document."""
    return flatten_lists(day_lists(documents, start, end).filter(F.col("reason").isNull()))


def feed_errors(documents: DataFrame, start: date | None = None, end: date | None = None) -> DataFrame:
    """The day lists `flatten_feed` leaves out, with the reason and the document."""
    return day_lists(documents, start, end).filter(F.col("reason").isNotNull()).drop("objects")

