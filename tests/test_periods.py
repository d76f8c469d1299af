from datetime import date

import pytest
from conftest import expected, rows

from perigee.operators.days import day_range, missing_days
from perigee.operators.periods import (
    peak_periods,
    period_average,
    period_change,
    period_counts,
    top_period,
    total_count,
)
from perigee.plans.marts import APPROACH_MARTS, KPI_MARTS, day_counts

MONTHS = [
    (None, None, 1),
    ("2023-11", 2023, 2),
    ("2023-12", 2023, 1),
    ("2024-01", 2024, 2),
    ("2024-03", 2024, 2),
    ("2024-04", 2024, 1),
    ("2024-05", 2024, 1),
]
MONTH_MEANS = [(m, n, 1.0 if m is None else 1.5) for m, _, n in MONTHS]
YEARS = [(None, 1), (2023, 3), (2024, 6)]
MEAN_YEAR = 3.333333
RESET = [
    (None, 1, None, None),
    ("2023-11", 2, None, None),
    ("2023-12", 1, 2, -1),
    ("2024-01", 2, None, None),
    ("2024-03", 2, 2, 0),
    ("2024-04", 1, 2, -1),
    ("2024-05", 1, 1, 0),
]
CONTINUOUS = [
    (None, 1, None, None),
    ("2023-11", 2, 1, 1),
    ("2023-12", 1, 2, -1),
    ("2024-01", 2, 1, 1),
    ("2024-03", 2, 2, 0),
    ("2024-04", 1, 2, -1),
    ("2024-05", 1, 1, 0),
]
YEAR_CHANGE = [(None, 1, None, None), (2023, 3, 1, 2), (2024, 6, 3, 3)]

MARTS = {
    "close-approach-analysis/asteroid_monthly_average_close_approaches": (
        ["Month", "Close_Approaches_Count", "Avg_Monthly_Approaches"],
        MONTH_MEANS,
    ),
    "close-approach-analysis/asteroid_yearly_average_close_approaches": (
        ["Year", "Total_Approaches", "Avg_Yearly_Approaches"],
        [(*y, MEAN_YEAR) for y in YEARS],
    ),
    "close-approach-analysis/asteroid_monthly_no_close_approaches": (
        ["Month", "Total_Approaches"],
        [("2023-11", 2), ("2024-01", 2), ("2024-03", 2)],
    ),
    "close-approach-analysis/asteroid_yearly_no_close_approach": (["Year", "Total_Approaches"], [(2024, 6)]),
    "close-approach-analysis/asteroid_monthly_trend_analysis": (
        ["Month", "Total_Approaches", "Prev_Month_Approaches", "MoM_Change"],
        RESET,
    ),
    "close-approach-analysis/asteroid_yearly_trend": (
        ["Year", "Total_Approaches", "Prev_Year_Approaches", "YoY_Change"],
        YEAR_CHANGE,
    ),
    "kpi/total_close_approaches": (["Total_Close_Approaches"], [(10,)]),
    "kpi/monthly_avg_close_approaches": (
        ["Month", "Close_Approaches_Count", "Avg_Monthly_Close_Approaches"],
        MONTH_MEANS,
    ),
    "kpi/yearly_avg_close_approaches": (
        ["Year", "Close_Approaches_Count", "Avg_Yearly_Close_Approaches"],
        [(*y, MEAN_YEAR) for y in YEARS],
    ),
    "kpi/peak_month": (["Month", "Close_Approaches_Count"], [("2023-11", 2)]),
    "kpi/peak_year": (["Year", "Close_Approaches_Count"], [(2024, 6)]),
    "kpi/monthly_change": (
        ["Month", "Close_Approaches_Count", "Prev_Close_Approaches_Count", "Month_Change"],
        CONTINUOUS,
    ),
    "kpi/yearly_change": (
        ["Year", "Close_Approaches_Count", "Prev_Close_Approaches_Count", "Year_Change"],
        YEAR_CHANGE,
    ),
}


@pytest.mark.parametrize("name", list(MARTS))
def test_period_mart(ten, name):
    columns, values = MARTS[name]
    mart = {**APPROACH_MARTS, **KPI_MARTS}[name](day_counts(ten))
    assert mart.columns == columns
    assert rows(mart) == expected(values)


def test_all_period_marts_are_listed():
    assert list(MARTS) == [*APPROACH_MARTS, *KPI_MARTS]


@pytest.mark.parametrize("mart", [m for m in MARTS if "yearly_av" in m])
def test_yearly_average_is_in_order(ten, mart):
    years = [row.Year for row in {**APPROACH_MARTS, **KPI_MARTS}[mart](day_counts(ten)).collect()]
    assert years == [None, 2023, 2024]


def test_counts_from_rows_and_from_days_agree(ten):
    days = period_counts(ten, "close_approach_date", "day")
    for grain in ("month", "year"):
        direct = period_counts(ten, "close_approach_date", grain)
        assert rows(direct) == rows(period_counts(days, "period", grain, weight="n"))
    assert rows(period_counts(ten, "close_approach_date", "month")) == expected(MONTHS)
    assert rows(total_count(days, weight="n")) == rows(total_count(ten)) == [(10,)]


def test_column_types(ten):
    kinds = {
        grain: dict(period_counts(ten, "close_approach_date", grain).dtypes) for grain in ("day", "month", "year")
    }
    assert [kinds[g]["period"] for g in kinds] == ["date", "string", "int"]
    assert {kinds[g]["n"] for g in kinds} == {"bigint"}


def test_unknown_grain(ten):
    with pytest.raises(ValueError, match="grain"):
        period_counts(ten, "close_approach_date", "week")


def test_empty_input(ten):
    none = ten.filter("false")
    months = period_counts(none, "close_approach_date", "month")
    assert rows(total_count(none)) == [(0,)]
    assert rows(total_count(period_counts(none, "close_approach_date", "day"), weight="n")) == [(0,)]
    for result in (period_average(months), period_change(months), peak_periods(months), top_period(months)):
        assert rows(result) == []


def test_top_period_prefers_the_earliest_tie(ten):
    months = period_counts(ten, "close_approach_date", "month").filter("year = 2024")
    assert rows(top_period(months), "period", "n") == [("2024-01", 2)]


def test_day_range_and_missing_days(spark, ten):
    days = day_range(spark, date(2010, 1, 1), date(2015, 1, 14))
    assert days.count() == 1840
    week = day_range(spark, date(2023, 11, 3), date(2023, 11, 7))
    found = rows(missing_days(week, period_counts(ten, "close_approach_date", "day")))
    assert [d for (d,) in found] == [date(2023, 11, d) for d in (3, 4, 6, 7)]
