"""Grouped profiles: how many objects, and the mean and range of their measures.

A profile can be taken from rows, or from parts: counts, sums and extremes per finer group,
which add up to any coarser grouping. Parts let several profiles share one scan.

Sums of doubles do not hang on the order of rows: a value is cut, without rounding, into a whole number of 1/2**20 and one
of 1/2**72, and whole numbers are added as decimals. So a mean is the same to the last bit from rows and from parts, however they
are dealt to tasks.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNIT, REST = float(1 << 20), float(1 << 52)
#: Above this, a double has no fraction of a unit.
NO_FRACTION = float(1 << 42)
#: Values beyond, infinite ones and NaN are added as doubles.
FINITE = 1e31
WHOLE = "decimal(38,0)"


def sum_parts(column: str) -> dict[str, Column]:
    """Aggregates that make up the sum of a column, by the ending of their names; each adds up by `sum`."""
    value = F.col(column).cast("double")
    scaled = value * F.lit(UNIT)
    finite, small = F.abs(value) < F.lit(FINITE), F.abs(value) < F.lit(NO_FRACTION)
    whole = F.when(small, F.floor(scaled).cast(WHOLE)).when(finite, scaled.cast(WHOLE))
    rest = F.when(small, F.floor((scaled - F.floor(scaled)) * F.lit(REST)).cast(WHOLE))
    return {"whole": F.sum(whole), "rest": F.sum(rest), "odd": F.sum(F.when(~finite, value))}


def mean_of(parts: Mapping[str, Column], count: Column) -> Column:
    """The mean from the parts of a sum; null without values."""
    whole, rest = (F.coalesce(parts[name].cast("double"), F.lit(0.0)) for name in ("whole", "rest"))
    total = whole / F.lit(UNIT) + rest / F.lit(UNIT * REST) + F.coalesce(parts["odd"], F.lit(0.0))
    return F.try_divide(total, count)


def exact_mean(column: str) -> Column:
    return mean_of(sum_parts(column), F.count(column))


def profile(
    df: DataFrame,
    keys: Mapping[str, Column],
    id_col: str,
    count_name: str,
    averages: Mapping[str, str] | None = None,
    minima: Mapping[str, str] | None = None,
    maxima: Mapping[str, str] | None = None,
) -> DataFrame:
    """Groups rows by `keys`; counts non-null ids and summarizes columns (output name to column)."""
    return df.groupBy(*(key.alias(name) for name, key in keys.items())).agg(
        F.count(id_col).alias(count_name),
        *(exact_mean(column).alias(name) for name, column in (averages or {}).items()),
        *(F.min(column).alias(name) for name, column in (minima or {}).items()),
        *(F.max(column).alias(name) for name, column in (maxima or {}).items()),
    )


def profile_parts(
    df: DataFrame,
    keys: Mapping[str, Column],
    id_col: str,
    measures: Mapping[str, str],
    extremes: Mapping[str, str] | None = None,
) -> DataFrame:
    """Per group: `row_count`, `id_count`, `<measure>_whole`, `_rest`, `_odd` (its sum), `_count`, `_min`, `_max`; of
    `extremes` the last two.
    """
    return df.groupBy(*(key.alias(name) for name, key in keys.items())).agg(*part_columns(id_col, measures, extremes))


def part_columns(
    id_col: str, measures: Mapping[str, str], extremes: Mapping[str, str] | None = None
) -> list[Column]:
    """The aggregates that parts consist of."""
    parts = [F.count(F.lit(1)).alias("row_count"), F.count(id_col).alias("id_count")]
    for measure, column in measures.items():
        parts += [part.alias(f"{measure}_{name}") for name, part in sum_parts(column).items()]
        parts.append(F.count(column).alias(f"{measure}_count"))
    for measure, column in {**measures, **(extremes or {})}.items():
        parts += [F.min(column).alias(f"{measure}_min"), F.max(column).alias(f"{measure}_max")]
    return parts


def merge_parts(parts: DataFrame, keys: Mapping[str, Column]) -> DataFrame:
    """Parts of coarser groups. Columns that are neither keys nor parts are left out."""
    how = {"_whole": F.sum, "_rest": F.sum, "_odd": F.sum, "_count": F.sum, "_min": F.min, "_max": F.max}
    merged = [
        how[ending](name).alias(name)
        for name in parts.columns
        for ending in how
        if name.endswith(ending) and name not in keys
    ]
    return parts.groupBy(*(key.alias(name) for name, key in keys.items())).agg(*merged)


def merge_profile(
    parts: DataFrame,
    keys: Mapping[str, Column],
    count_name: str,
    averages: Mapping[str, str] | None = None,
    minima: Mapping[str, str] | None = None,
    maxima: Mapping[str, str] | None = None,
) -> DataFrame:
    """`profile` from parts; the mappings give output name to measure."""

    def average(measure: str) -> Column:
        parts = {name: F.sum(f"{measure}_{name}") for name in ("whole", "rest", "odd")}
        return mean_of(parts, F.sum(f"{measure}_count"))

    return parts.groupBy(*(key.alias(name) for name, key in keys.items())).agg(
        F.sum("id_count").alias(count_name),
        *(average(measure).alias(name) for name, measure in (averages or {}).items()),
        *(F.min(f"{measure}_min").alias(name) for name, measure in (minima or {}).items()),
        *(F.max(f"{measure}_max").alias(name) for name, measure in (maxima or {}).items()),
    )
