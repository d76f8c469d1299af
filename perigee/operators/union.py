"""Union of stores."""

from __future__ import annotations

from pyspark.sql import DataFrame


def union_stores(first: DataFrame, second: DataFrame) -> DataFrame:
    """All rows of both, duplicates kept. Columns are matched by name, and must be the same."""
    return first.unionByName(second)
