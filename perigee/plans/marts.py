"""The 17 marts.

Period marts start from day counts, so one scan of the date column serves all 13 of them.
Cluster marts start from approach rows, or from parts by all labels, so that one scan serves
all four.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from datetime import date
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perigee.functions.labels import band, flag_label, horizon_label
from perigee.operators.periods import (
    peak_periods,
    period_average,
    period_change,
    period_counts,
    top_period,
    total_count,
)
from perigee.operators.profiles import merge_profile, profile, profile_parts

# Measured columns, band edges and names, and labels.
DATE = "close_approach_date"
MEASURES = {
    "diameter": "estimated_diameter_min_kilometers",
    "velocity": "relative_velocity_kilometers_per_second",
    "miss_distance": "miss_distance_astronomical",
    "absolute_magnitude": "absolute_magnitude_h",
}
EXTREMES = {"approach": DATE}
BANDS = {
    "size_cluster": ("diameter", 1, 5, ("Small", "Medium", "Large")),
    "velocity_cluster": ("velocity", 10, 25, ("Slow", "Moderate", "Fast")),
    "distance_cluster": ("miss_distance", 0.1, 1, ("Very Close", "Moderate", "Far")),
    "magnitude_cluster": ("absolute_magnitude", 15, 20, ("Bright", "Moderately Bright", "Dim")),
}
HAZARD = ("Hazardous", "Non-Hazardous")
HORIZON = ("Near Future", "Far Future")
HORIZON_MONTHS = 1
# The label that moves with time, and the column that says which mart's labels a row of the rollup is grouped by.
MOVING = "approach_cluster"
SUMMARY = "summary"


def hazard_label() -> Column:
    return flag_label(F.col("is_potentially_hazardous_asteroid"), *HAZARD)


def approach_label(as_of: date | None) -> Column:
    return horizon_label(F.col(DATE), as_of, HORIZON_MONTHS, *HORIZON)


def band_labels() -> dict[str, Column]:
    return {
        name: band(F.col(MEASURES[measure]), low, high, names) for name, (measure, low, high, names) in BANDS.items()
    }


# --- period marts ---------------------------------------------------------------------------


def day_counts(approaches: DataFrame, weight: str | None = None) -> DataFrame:
    """Day-grain period table of approach rows, or of the rollup's dated rows with their `row_count` as weight.

    The counting is spread as usual; its result, one row per calendar day, then goes to one
    partition, where coarser groupings and windows need no further shuffle.
    """
    if SUMMARY in approaches.columns:
        approaches = approaches.filter(F.col(SUMMARY).contains(MOVING))
    return period_counts(approaches, DATE, "day", weight).repartition(1)


def _coarser(days: DataFrame, grain: str) -> DataFrame:
    return period_counts(days, "period", grain, weight="n")


def _total(days: DataFrame, n: str) -> DataFrame:
    return total_count(days, weight="n").select(F.col("n").alias(n))


def _named(df: DataFrame, period: str, n: str, **derived: str) -> DataFrame:
    return df.select(
        F.col("period").alias(period), F.col("n").alias(n), *(F.col(c).alias(name) for c, name in derived.items())
    )


def _month_average(days: DataFrame, n: str, average: str) -> DataFrame:
    return _named(period_average(_coarser(days, "month"), within="year"), "Month", n, average=average)


def _year_average(days: DataFrame, n: str, average: str) -> DataFrame:
    return _named(period_average(_coarser(days, "year")), "Year", n, average=average).orderBy("Year")


def _peaks(days: DataFrame, grain: str, n: str) -> DataFrame:
    return _named(peak_periods(_coarser(days, grain)), grain.capitalize(), n)


def _top(days: DataFrame, grain: str, n: str) -> DataFrame:
    return _named(top_period(_coarser(days, grain)), grain.capitalize(), n)


def _change(days: DataFrame, grain: str, n: str, previous: str, change: str, within: str | None = None) -> DataFrame:
    changes = period_change(_coarser(days, grain), within)
    return _named(changes, grain.capitalize(), n, previous=previous, change=change)


# Mart directories and column names.
APPROACH_MARTS: Mapping[str, Callable[[DataFrame], DataFrame]] = {
    "close-approach-analysis/asteroid_monthly_average_close_approaches": partial(
        _month_average, n="Close_Approaches_Count", average="Avg_Monthly_Approaches"
    ),
    "close-approach-analysis/asteroid_yearly_average_close_approaches": partial(
        _year_average, n="Total_Approaches", average="Avg_Yearly_Approaches"
    ),
    "close-approach-analysis/asteroid_monthly_no_close_approaches": partial(
        _peaks, grain="month", n="Total_Approaches"
    ),
    "close-approach-analysis/asteroid_yearly_no_close_approach": partial(_peaks, grain="year", n="Total_Approaches"),
    "close-approach-analysis/asteroid_monthly_trend_analysis": partial(
        _change,
        grain="month",
        n="Total_Approaches",
        previous="Prev_Month_Approaches",
        change="MoM_Change",
        within="year",
    ),
    "close-approach-analysis/asteroid_yearly_trend": partial(
        _change, grain="year", n="Total_Approaches", previous="Prev_Year_Approaches", change="YoY_Change"
    ),
}
KPI_MARTS: Mapping[str, Callable[[DataFrame], DataFrame]] = {
    "kpi/total_close_approaches": partial(_total, n="Total_Close_Approaches"),
    "kpi/monthly_avg_close_approaches": partial(
        _month_average, n="Close_Approaches_Count", average="Avg_Monthly_Close_Approaches"
    ),
    "kpi/yearly_avg_close_approaches": partial(
        _year_average, n="Close_Approaches_Count", average="Avg_Yearly_Close_Approaches"
    ),
    "kpi/peak_month": partial(_top, grain="month", n="Close_Approaches_Count"),
    "kpi/peak_year": partial(_top, grain="year", n="Close_Approaches_Count"),
    "kpi/monthly_change": partial(
        _change,
        grain="month",
        n="Close_Approaches_Count",
        previous="Prev_Close_Approaches_Count",
        change="Month_Change",
    ),
    "kpi/yearly_change": partial(
        _change,
        grain="year",
        n="Close_Approaches_Count",
        previous="Prev_Close_Approaches_Count",
        change="Year_Change",
    ),
}


# --- cluster marts --------------------------------------------------------------------------


@dataclass(frozen=True)
class ClusterMart:
    """Two labels to group by (output name to label), and measures to summarize (output name to measure)."""

    keys: Mapping[str, str]
    averages: Mapping[str, str] = field(default_factory=dict)
    minima: Mapping[str, str] = field(default_factory=dict)
    maxima: Mapping[str, str] = field(default_factory=dict)


# Mart directories and column names.
CLUSTER_MARTS: Mapping[str, ClusterMart] = {
    "clustering-based-analysis/asteroid_hazardous_close_approach_clusters": ClusterMart(
        keys={"hazard_cluster": "hazard_cluster", "approach_cluster": "approach_cluster"},
        minima={"first_approach": "approach"},
        maxima={"last_approach": "approach"},
    ),
    "clustering-based-analysis/asteroid_size_velocity_cluster": ClusterMart(
        keys={"size_cluster": "size_cluster", "velocity_cluster": "velocity_cluster"},
        averages={"avg_diameter": "diameter", "avg_velocity": "velocity"},
        minima={"min_diameter": "diameter", "min_velocity": "velocity"},
        maxima={"max_diameter": "diameter", "max_velocity": "velocity"},
    ),
    "clustering-based-analysis/asteroid_distance_orbit_body_clusters": ClusterMart(
        keys={"orbiting_body": "orbiting_body", "distance_cluster": "distance_cluster"},
        averages={"avg_miss_distance": "miss_distance"},
        minima={"min_miss_distance": "miss_distance"},
        maxima={"max_miss_distance": "miss_distance"},
    ),
    "clustering-based-analysis/clustered_asteroids_by_magnitude_and_diameter": ClusterMart(
        keys={"magnitude_cluster": "magnitude_cluster", "diameter_cluster": "size_cluster"},
        averages={"avg_absolute_magnitude": "absolute_magnitude", "avg_diameter": "diameter"},
        minima={"min_absolute_magnitude": "absolute_magnitude"},
        maxima={"max_absolute_magnitude": "absolute_magnitude"},
    ),
}
OBJECTS = "num_asteroids"


def summary_name(mart: ClusterMart) -> str:
    return " ".join(mart.keys.values())


def _in_order(df: DataFrame, mart: ClusterMart) -> DataFrame:
    summaries = [name for pair in (mart.averages, mart.minima, mart.maxima) for name in pair]
    return df.select(*mart.keys, OBJECTS, *summaries).orderBy(*mart.keys)


def cluster_labels(as_of: date | None) -> dict[str, Column]:
    return {
        "hazard_cluster": hazard_label(),
        "approach_cluster": approach_label(as_of),
        **band_labels(),
        "orbiting_body": F.col("orbiting_body"),
    }


def cluster_mart(mart: ClusterMart, approaches: DataFrame, as_of: date | None = None) -> DataFrame:
    """A cluster mart straight from approach rows."""
    labels = cluster_labels(as_of)
    columns = {**MEASURES, **EXTREMES}

    def named(summaries: Mapping[str, str]) -> dict[str, str]:
        return {name: columns[measure] for name, measure in summaries.items()}

    keys = {name: labels[label] for name, label in mart.keys.items()}
    summary = profile(
        approaches, keys, "id", OBJECTS, named(mart.averages), named(mart.minima), named(mart.maxima)
    )
    return _in_order(summary, mart)


def cluster_parts(approaches: DataFrame, as_of: date | None = None) -> DataFrame:
    """Parts by all labels at once: at most 324 label combinations for each orbiting body."""
    return profile_parts(approaches, cluster_labels(as_of), "id", MEASURES, EXTREMES)


def cluster_mart_from_parts(mart: ClusterMart, parts: DataFrame) -> DataFrame:
    """The same mart from `cluster_parts` or from the rollup's parts, so that one scan serves all four."""
    if SUMMARY in parts.columns:
        parts = parts.filter(F.col(SUMMARY) == summary_name(mart))
    keys = {name: F.col(label) for name, label in mart.keys.items()}
    return _in_order(merge_profile(parts, keys, OBJECTS, mart.averages, mart.minima, mart.maxima), mart)
