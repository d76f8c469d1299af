"""Labels that sort rows into a few named groups."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


def flag_label(flag: Column, yes: str, no: str) -> Column:
    """`yes` where the flag holds, `no` where it does not or is null."""
    return F.when(flag, F.lit(yes)).otherwise(F.lit(no))


def horizon_label(day: Column, as_of: date | None, months: int, near: str, far: str) -> Column:
    """`near` up to `months` after `as_of` (today if None), past days included; null days are `far`."""
    start = F.current_date() if as_of is None else F.lit(as_of).cast("date")
    return F.when(day <= F.add_months(start, months), F.lit(near)).otherwise(F.lit(far))


def band(value: Column, low: float, high: float, names: tuple[str, str, str]) -> Column:
    """Three bands; `low` is in the first, `high` in the second, nulls in the third."""
    first, second, third = names
    return (
        F.when(value <= F.lit(low), F.lit(first))
        .when(value.between(F.lit(low), F.lit(high)), F.lit(second))
        .otherwise(F.lit(third))
    )
