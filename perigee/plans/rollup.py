"""One summary of the approach rows that all 17 marts can be taken from.

It has the rows grouped by the two labels of each cluster mart, side by side: the sizes of the groupings add up
instead of multiplying, so it is small however the labels are spread. A label that moves with time is left to the
approach date; the period marts count the same rows. Its size follows the calendar and the labels, not the rows: per day
one group for each flag and approach date, and at most 9 for each other pair of bands (3 for each body).
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perigee.operators.profiles import merge_parts, part_columns
from perigee.plans.marts import (
    CLUSTER_MARTS,
    DATE,
    MEASURES,
    MOVING,
    SUMMARY,
    approach_label,
    cluster_labels,
    summary_name,
)


def approach_rollup(approaches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Parts of every profile, from one scan; `by` adds columns to group by, such as the partitions to keep apart."""
    labels = {name: label for name, label in cluster_labels(None).items() if name != MOVING}
    keys = [*by, DATE, *labels]
    sets = {
        summary_name(mart): [*by, *(DATE if label == MOVING else label for label in mart.keys.values())]
        for mart in CLUSTER_MARTS.values()
    }
    # grouping_id has a bit for each key, set where a grouping leaves the key out.
    numbers = {
        name: sum(1 << place for place, key in enumerate(reversed(keys)) if key not in used) for name, used in sets.items()
    }
    which = F.element_at(F.create_map(*(F.lit(x) for name, n in numbers.items() for x in (n, name))), F.col("grouping"))
    grouped = approaches.withColumns(labels).groupingSets(list(sets.values()), *keys)
    parts = grouped.agg(*part_columns("id", MEASURES), F.grouping_id().cast("int").alias("grouping"))
    return parts.withColumn(SUMMARY, which).drop("grouping")


def rollup_cluster_parts(rollup: DataFrame, as_of: date | None = None) -> DataFrame:
    """Parts of each cluster mart's own labels, marked with the mart's summary name."""
    dated = rollup.withColumns({"approach_min": F.col(DATE), "approach_max": F.col(DATE)})
    keys = {name: F.col(name) for name in (SUMMARY, *cluster_labels(as_of))}
    return merge_parts(dated.withColumn(MOVING, approach_label(as_of)), keys)
