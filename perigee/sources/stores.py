"""Stored approach rows."""

from __future__ import annotations

import json
import re
from collections import defaultdict
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from datetime import date
from functools import reduce
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perigee.functions.dates import partition_day
from perigee.schema import APPROACH_COLUMNS, APPROACH_FIELDS, APPROACH_SCHEMA, DAY_PARTITIONS
from perigee.sinks.files import current_path

#: Where a plain store's path says its day.
PLAIN_DAY = r"(\d+)/(\d+)/(\d+)\.parquet(?:/part-[^/]*)?$"
FILES_AT_ONCE = 8
_DAY_TYPES = [T.StructField(name, T.IntegerType()) for name in DAY_PARTITIONS]
_STORE_TYPES = [T.StructField("store", T.StringType()), *_DAY_TYPES]


def in_days(df: DataFrame, start: date | None, end: date | None) -> DataFrame:
    """Rows of the day partitions from `start` to `end`, both included; other directories are not read."""
    # The year alone is a bound that a catalog can use too.
    if start is not None:
        df = df.filter((partition_day() >= F.lit(start)) & (F.col("year") >= F.lit(start.year)))
    if end is not None:
        df = df.filter((partition_day() <= F.lit(end)) & (F.col("year") <= F.lit(end.year)))
    return df


def _read(spark: SparkSession, root: str, schema: T.StructType, start: date | None, end: date | None) -> DataFrame:
    return in_days(spark.read.schema(schema).parquet(root), start, end)


def read_days(
    spark: SparkSession, root: str, start: date | None = None, end: date | None = None, partitions: bool = False
) -> DataFrame:
    """A day store: the 25 columns, and the `year, month, day` of the feed with `partitions`."""
    df = _read(spark, root, T.StructType(APPROACH_SCHEMA.fields + _DAY_TYPES), start, end)
    return df if partitions else df.select(*APPROACH_COLUMNS)


def read_union(
    spark: SparkSession, root: str, start: date | None = None, end: date | None = None, partitions: bool = False
) -> DataFrame:
    """The union table: the 25 columns, and `store, year, month, day` with `partitions`."""
    df = _read(spark, current_path(spark, root), T.StructType(APPROACH_SCHEMA.fields + _STORE_TYPES), start, end)
    return df if partitions else df.select(*APPROACH_COLUMNS)


def read_plain_days(spark: SparkSession, root: str) -> DataFrame:
    """Day files kept as `<year>/<month>/<day>.parquet` with whatever types they were written in.

    For taking over an existing store. Types were inferred file by file, so a column may be whole numbers in one and
    fractions or text in the next. The footers are read in tasks, files of the same column types make a group, and each
    group is one scan of Spark's own, cast to the fixed types; a large file is read by several tasks. A value
    that does not fit fails the read; a column a file does not have, or has without a type, is null. `year, month, day`
    come from the path; a day may also be a folder with files of Spark's naming. Other files are refused.
    """
    listed = spark.read.schema("id string").option("recursiveFileLookup", True).parquet(root).inputFiles()
    files = [unquote(path) for path in listed]
    if odd := [path for path in files if not re.search(PLAIN_DAY, path)]:
        raise ValueError(f"not a day file: {odd[0]}")
    groups = defaultdict(list)
    for path, types in file_types(spark, files).items():
        groups[types].append(path)
    scans = [_as_fixed(spark, dict(json.loads(types)), sorted(paths)) for types, paths in sorted(groups.items())]
    empty = spark.createDataFrame([], T.StructType([*APPROACH_SCHEMA.fields, *_DAY_TYPES]))
    return reduce(DataFrame.union, scans) if scans else empty


def file_types(spark: SparkSession, files: list[str]) -> dict[str, str]:
    """For each file its columns and their types, as JSON, of the columns of the fixed schema.

    Tasks read the footers alone. Where a task cannot open the file, being in a store that only Spark reads, Spark
    infers its schema.
    """
    names = list(APPROACH_COLUMNS)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for path in batch.column(0).to_pylist():
                try:
                    store, place = pa.fs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", path))
                    with store.open_input_file(place) as file:
                        held = pq.read_schema(file)
                except (OSError, ValueError, NotImplementedError):
                    found.append(None)
                    continue
                found.append(json.dumps([(n, str(held.field(n).type)) for n in names if n in held.names]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string())], names=["path", "types"])

    if not files:
        return {}
    tasks = min(len(files), 4 * spark.sparkContext.defaultParallelism)
    listed = spark.createDataFrame([(path,) for path in files], "path string").repartition(tasks)
    found = {row.path: row.types for row in listed.mapInArrow(read, "path string, types string").collect()}

    def infer(path: str) -> str:
        held = {field.name: field.dataType.simpleString() for field in spark.read.parquet(path).schema}
        return json.dumps([(n, held[n]) for n in names if n in held])

    with ThreadPoolExecutor(FILES_AT_ONCE) as pool:
        closed = [path for path, types in found.items() if types is None]
        return found | dict(zip(closed, pool.map(infer, closed), strict=True))


def _as_fixed(spark: SparkSession, types: dict[str, str], files: list[str]) -> DataFrame:
    """Files of the same column types as approach rows with their day."""
    held = spark.read.parquet(files[0]).schema
    held = T.StructType([held[name] for name in APPROACH_COLUMNS if types.get(name, "null") != "null"])
    columns = [_fitted(name, kind, held) for name, _, kind in APPROACH_FIELDS]
    day = enumerate(DAY_PARTITIONS, start=1)
    place = F.col("_metadata.file_path")
    parts = [F.regexp_extract(place, PLAIN_DAY, index).cast("int").alias(name) for index, name in day]
    return spark.read.schema(held).parquet(*files).select(*columns, *parts)


def _fitted(name: str, kind: str, held: T.StructType) -> Column:
    """A column in its fixed type; a fraction is no whole number."""
    if name not in held.names:
        return F.lit(None).cast(kind).alias(name)
    value = F.col(name)
    if kind == "bigint" and isinstance(held[name].dataType, (T.FractionalType)):
        broken = F.raise_error(F.concat(F.lit(f"{name} is not a whole number: "), value.cast("string")))
        value = F.when(value != F.floor(value), broken.cast("bigint")).otherwise(value.cast("bigint"))
    return value.cast(kind).alias(name)
