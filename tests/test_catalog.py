"""Every registered query against its SQL on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_point
from perigee.catalog import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
)
DATA = Path("/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not DATA.is_dir(), reason="test tables are not here")


@pytest.fixture(scope="module")
def check():
    connection = duckdb.connect()
    for name in TABLES.split():
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return connection


def test_every_query_of_the_catalog_is_registered_with_sql():
    assert all(query.sql for query in QUERIES.values())
    assert QUERIES.keys() <= entry_point.queries().keys()
    assert QUERIES.keys() <= entry_point.oracle_sql().keys()


def test_entry(spark):
    result = entry_point.entry(spark)
    assert result.columns == ["Month", "Close_Approaches_Count", "Avg_Monthly_Approaches"]
    assert result.count() > 0


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, check, name):
    result = entry_point.queries()[name](spark, str(DATA))
    columns = sorted(result.columns)
    found = sorted((tuple(row[c] for c in columns) for row in result.collect()), key=repr)
    cursor = check.execute(entry_point.oracle_sql()[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == columns
    places = [names.index(c) for c in columns]
    wanted = sorted((tuple(row[i] for i in places) for row in cursor.fetchall()), key=repr)
    assert found == wanted
    assert found
