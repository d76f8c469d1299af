"""Marts and other tables with their catalog entries."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from perigee.sinks.files import current_path, exists, replace_directory

# Properties of the views made here: the table of files a view shows now, and the one it showed before.
ENTRY, FORMER = "perigee.entry", "perigee.former"
PARTITIONS_AT_ONCE = 200


@dataclass(frozen=True)
class Touched:
    """Partitions that a run wrote and dropped, as values by column name."""

    written: Sequence[dict] = field(default_factory=list)
    dropped: Sequence[dict] = field(default_factory=list)


def write_mart(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Replace the mart by a new version, or with mode `error` refuse if there is anything at `path`."""
    if mode == "overwrite" or not exists(df.sparkSession, path):
        replace_directory(df, path)
    else:
        df.write.mode(mode).parquet(path)


def read_mart(spark: SparkSession, path: str) -> DataFrame:
    """The current version of a table that is replaced whole."""
    return spark.read.parquet(current_path(spark, path))


def register_table(spark: SparkSession, name: str, path: str, touched: Touched | None = None) -> None:
    """Make the current version of the table at `path` known to the catalog as `name`, or renew what it knows.

    Every version gets an external table `<name>__<hash>`, and `name` is a view of the newest: a new version, also one
    of other columns, is shown by replacing the view, which is one step in the catalog. The table before it keeps its
    entry until the next version. `touched` says which partitions of a version already known changed; without it, a partitioned
    table is listed whole. Only entries are ever dropped, never files. A managed table or somebody else's view
    of that name is refused; an external table's entry makes way for the view.
    """
    shown = _quoted(name)
    kind, properties = _known(spark, shown)
    if kind not in (None, "EXTERNAL") and ENTRY not in properties:
        raise ValueError(f"{name} is {kind.lower()} and was not registered here")
    location = current_path(spark, path)
    columns = spark.read.parquet(location).schema
    mark = hashlib.md5(f"{location}|{columns.json()}".encode()).hexdigest()[:12]
    entry = f"{name}__{mark}"
    known = spark.catalog.tableExists(_quoted(entry))
    if not known:
        spark.sql(f"CREATE TABLE {_quoted(entry)} USING parquet LOCATION {_literal(location)}")
    partitioned = any(column.isPartition for column in spark.catalog.listColumns(_quoted(entry)))
    if partitioned and (touched is None or not known):
        spark.catalog.recoverPartitions(_quoted(entry))
    elif partitioned:
        _follow(spark, _quoted(entry), touched)
    spark.catalog.refreshTable(_quoted(entry))
    if properties.get(ENTRY) == entry:
        return
    if kind == "EXTERNAL":
        spark.sql(f"DROP TABLE {shown}")
    former = properties.get(ENTRY, "")
    marks = f"{_literal(ENTRY)} = {_literal(entry)}, {_literal(FORMER)} = {_literal(former)}"
    spark.sql(f"CREATE OR REPLACE VIEW {shown} TBLPROPERTIES ({marks}) AS SELECT * FROM {_quoted(entry)}")
    old = properties.get(FORMER)
    if old and old not in (entry, former):
        spark.sql(f"DROP TABLE IF EXISTS {_quoted(old)}")


def unregister_table(spark: SparkSession, name: str) -> None:
    """Take the entries that `register_table` made for `name` out of the catalog; files stay."""
    kind, properties = _known(spark, _quoted(name))
    if kind == "VIEW" and ENTRY in properties:
        spark.sql(f"DROP VIEW {_quoted(name)}")
        for entry in filter(None, (properties.get(ENTRY), properties.get(FORMER))):
            spark.sql(f"DROP TABLE IF EXISTS {_quoted(entry)}")


def _known(spark: SparkSession, quoted: str) -> tuple[str | None, dict[str, str]]:
    """Kind of a catalog entry (None if there is none) and, of a view, its properties."""
    if not spark.catalog.tableExists(quoted):
        return None, {}
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {quoted}").filter("col_name = 'Type'").first()
    kind = described.data_type if described else "TEMPORARY VIEW"
    shown = spark.sql(f"SHOW TBLPROPERTIES {quoted}").collect() if kind == "VIEW" else []
    return kind, {row.key: row.value for row in shown}


def _follow(spark: SparkSession, table: str, touched: Touched) -> None:
    """Drop and add entries of single partitions; nothing is listed."""
    for specs in _batches(touched.dropped):
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {', '.join(specs)}")
    for specs in _batches(touched.written):
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {' '.join(specs)}")


def _batches(partitions: Sequence[dict]) -> Iterator[list[str]]:
    specs = [f"PARTITION ({', '.join(f'`{k}` = {_literal(v)}' for k, v in values.items())})" for values in partitions]
    for first in range(0, len(specs), PARTITIONS_AT_ONCE):
        yield specs[first : first + PARTITIONS_AT_ONCE]


def _quoted(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.split("."))


def _literal(value: object) -> str:
    if isinstance(value, int):
        return str(value)
    escaped = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"
