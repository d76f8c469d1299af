"""Period counts and marts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perigee.catalog.bindings import LINEITEM_SQL, Query, lineitem_approaches, table
from perigee.operators.days import day_sequence, missing_days
from perigee.operators.periods import (
    peak_periods,
    period_average,
    period_change,
    period_counts,
    top_period,
    total_count,
)
from perigee.plans.marts import APPROACH_MARTS, KPI_MARTS, day_counts

_PERIOD_SQL = {
    "day": "CAST({d} AS DATE)",
    "month": "strftime({d}, '%Y-%m')",
    "year": "CAST(year({d}) AS INTEGER)",
}


def counts_sql(relation: str, column: str, grain: str) -> str:
    """Period table as a CTE named `c`."""
    period = _PERIOD_SQL[grain].format(d=column)
    year = _PERIOD_SQL["year"].format(d=column)
    return (
        f"WITH c AS (SELECT {period} AS period, {year} AS yr, count(*) AS n "
        f"FROM ({relation}) AS r GROUP BY 1, 2) "
    )


def average_sql(relation: str, column: str, grain: str, names: tuple[str, str, str], within: str = "") -> str:
    period, n, average = names
    return counts_sql(relation, column, grain) + (
        f"SELECT period AS {period}, n AS {n}, avg(n) OVER ({within}) AS {average} FROM c"
    )


def peaks_sql(relation: str, column: str, grain: str, names: tuple[str, str]) -> str:
    period, n = names
    return counts_sql(relation, column, grain) + (
        f"SELECT period AS {period}, n AS {n} FROM c WHERE n = (SELECT max(n) FROM c)"
    )


def top_sql(relation: str, column: str, grain: str, names: tuple[str, str]) -> str:
    period, n = names
    return counts_sql(relation, column, grain) + (
        f"SELECT period AS {period}, n AS {n} FROM c ORDER BY c.n DESC, c.period NULLS FIRST LIMIT 1"
    )


def change_sql(relation: str, column: str, grain: str, names: tuple[str, str, str, str], within: str = "") -> str:
    period, n, previous, change = names
    lag = f"lag(n) OVER ({within} ORDER BY period NULLS FIRST)"
    return counts_sql(relation, column, grain) + (
        f"SELECT period AS {period}, n AS {n}, {lag} AS {previous}, n - {lag} AS {change} FROM c"
    )


def total_sql(relation: str, name: str) -> str:
    return f"SELECT count(*) AS {name} FROM ({relation}) AS r"


def mart_sql(relation: str, column: str = "close_approach_date") -> dict[str, str]:
    """SQL of every period mart on a relation of approach rows."""
    by_year = "PARTITION BY yr"
    return {
        "close-approach-analysis/asteroid_monthly_average_close_approaches": average_sql(
            relation, column, "month", ("Month", "Close_Approaches_Count", "Avg_Monthly_Approaches"), by_year
        ),
        "close-approach-analysis/asteroid_yearly_average_close_approaches": average_sql(
            relation, column, "year", ("Year", "Total_Approaches", "Avg_Yearly_Approaches")
        ),
        "close-approach-analysis/asteroid_monthly_no_close_approaches": peaks_sql(
            relation, column, "month", ("Month", "Total_Approaches")
        ),
        "close-approach-analysis/asteroid_yearly_no_close_approach": peaks_sql(
            relation, column, "year", ("Year", "Total_Approaches")
        ),
        "close-approach-analysis/asteroid_monthly_trend_analysis": change_sql(
            relation, column, "month", ("Month", "Total_Approaches", "Prev_Month_Approaches", "MoM_Change"), by_year
        ),
        "close-approach-analysis/asteroid_yearly_trend": change_sql(
            relation, column, "year", ("Year", "Total_Approaches", "Prev_Year_Approaches", "YoY_Change")
        ),
        "kpi/total_close_approaches": total_sql(relation, "Total_Close_Approaches"),
        "kpi/monthly_avg_close_approaches": average_sql(
            relation, column, "month", ("Month", "Close_Approaches_Count", "Avg_Monthly_Close_Approaches"), by_year
        ),
        "kpi/yearly_avg_close_approaches": average_sql(
            relation, column, "year", ("Year", "Close_Approaches_Count", "Avg_Yearly_Close_Approaches")
        ),
        "kpi/peak_month": top_sql(relation, column, "month", ("Month", "Close_Approaches_Count")),
        "kpi/peak_year": top_sql(relation, column, "year", ("Year", "Close_Approaches_Count")),
        "kpi/monthly_change": change_sql(
            relation,
            column,
            "month",
            ("Month", "Close_Approaches_Count", "Prev_Close_Approaches_Count", "Month_Change"),
        ),
        "kpi/yearly_change": change_sql(
            relation,
            column,
            "year",
            ("Year", "Close_Approaches_Count", "Prev_Close_Approaches_Count", "Year_Change"),
        ),
    }


# --- marts on lineitem as approach rows -----------------------------------------------------


def _mart(build):
    return lambda spark, sf_dir: build(day_counts(lineitem_approaches(spark, sf_dir)))


def _mart_queries() -> dict[str, Query]:
    sql = mart_sql(LINEITEM_SQL)
    prefixes = {"close-approach-analysis": "mart_approach_", "kpi": "mart_kpi_"}
    found = {}
    for path, build in {**APPROACH_MARTS, **KPI_MARTS}.items():
        group, name = path.split("/")
        found[prefixes[group] + name.removeprefix("asteroid_")] = Query(_mart(build), sql[path])
    return found


# --- operators on other tables --------------------------------------------------------------

_ORDERS = "SELECT o_orderdate FROM orders"


def _orders(spark: SparkSession, sf_dir: str, grain: str) -> DataFrame:
    return period_counts(table(spark, sf_dir, "orders"), "o_orderdate", grain)


def _average(grain: str, within: str | None):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        averaged = period_average(_orders(spark, sf_dir, grain), within)
        return averaged.select("period", "n", F.col("average").alias("avg_n"))

    return run


def _pick(operator, grain: str):
    return lambda spark, sf_dir: operator(_orders(spark, sf_dir, grain)).select("period", "n")


def _change(grain: str, within: str | None):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return period_change(_orders(spark, sf_dir, grain), within).select("period", "n", "previous", "change")

    return run


def _peak_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = period_counts(table(spark, sf_dir, "lineitem"), "l_shipdate", "day")
    return peak_periods(counts).select("period", "n")


def _counts(grain: str):
    return lambda spark, sf_dir: period_counts(table(spark, sf_dir, "lineitem"), "l_shipdate", grain)


def _counts_sql(grain: str) -> str:
    return counts_sql("SELECT l_shipdate FROM lineitem", "l_shipdate", grain) + 'SELECT period, yr AS "year", n FROM c'


def _gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days without an order, between the first and the last order."""
    counts = _orders(spark, sf_dir, "day")
    span = counts.agg(F.min("period").alias("first"), F.max("period").alias("last"))
    days = span.select(F.explode(day_sequence(F.col("first"), F.col("last"))).alias("day"))
    return missing_days(days, counts)


_GAPS_SQL = """
WITH o AS (SELECT CAST(o_orderdate AS DATE) AS d FROM orders),
     days AS (SELECT CAST(unnest(generate_series(min(d), max(d), INTERVAL 1 DAY)) AS DATE) AS "day" FROM o)
SELECT "day" FROM days WHERE "day" NOT IN (SELECT d FROM o)
"""

_PN = ("period", "n")
_PNA = ("period", "n", "avg_n")
_PNC = ("period", "n", "previous", "change")
_BY_YEAR = "PARTITION BY yr"

QUERIES: dict[str, Query] = {
    "period_counts_day": Query(_counts("day"), _counts_sql("day")),
    "period_counts_month": Query(_counts("month"), _counts_sql("month")),
    "period_counts_year": Query(_counts("year"), _counts_sql("year")),
    "period_avg_monthly": Query(
        _average("month", "year"), average_sql(_ORDERS, "o_orderdate", "month", _PNA, _BY_YEAR)
    ),
    "period_avg_yearly": Query(_average("year", None), average_sql(_ORDERS, "o_orderdate", "year", _PNA)),
    "peak_months": Query(_pick(peak_periods, "month"), peaks_sql(_ORDERS, "o_orderdate", "month", _PN)),
    "peak_years": Query(_pick(peak_periods, "year"), peaks_sql(_ORDERS, "o_orderdate", "year", _PN)),
    "peak_days_ties": Query(
        _peak_days, peaks_sql("SELECT l_shipdate FROM lineitem", "l_shipdate", "day", _PN)
    ),
    "mom_change_reset": Query(_change("month", "year"), change_sql(_ORDERS, "o_orderdate", "month", _PNC, _BY_YEAR)),
    "mom_change": Query(_change("month", None), change_sql(_ORDERS, "o_orderdate", "month", _PNC)),
    "yoy_change": Query(_change("year", None), change_sql(_ORDERS, "o_orderdate", "year", _PNC)),
    "total_rows": Query(
        lambda spark, sf_dir: total_count(table(spark, sf_dir, "orders")), total_sql(_ORDERS, "n")
    ),
    "top_month": Query(_pick(top_period, "month"), top_sql(_ORDERS, "o_orderdate", "month", _PN)),
    "top_year": Query(_pick(top_period, "year"), top_sql(_ORDERS, "o_orderdate", "year", _PN)),
    "day_range_gaps": Query(_gaps, _GAPS_SQL),
    **_mart_queries(),
}
