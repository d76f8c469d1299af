"""Queries on the test tables, each with SQL that gives the same rows."""

from __future__ import annotations

from perigee.catalog import cluster_queries, feed_queries, period_queries, store_queries
from perigee.catalog.bindings import Query

QUERIES: dict[str, Query] = {
    **period_queries.QUERIES,
    **cluster_queries.QUERIES,
    **feed_queries.QUERIES,
    **store_queries.QUERIES,
}
