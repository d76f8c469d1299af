"""Directories as Spark's file systems see them, and tables kept there in versions.

A table that is replaced whole has a directory for each version, `v<number>-<id>`. A version counts once it holds the
file `_COMPLETE`, which is made after all its rows are written; readers take the highest that does. So making one
empty file is the switch: nothing is renamed or deleted on the way, and a reader that began before keeps its files. The
version before the current one stays until the next replacement.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

VERSION = re.compile(r"v\d{10}-[0-9a-f]{32}")
COMPLETE = "_COMPLETE"
# Of tables that are as large as the stores: a third less than by default.
COMPRESSION = "zstd"


def _path(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), found


def mounted_path(spark: SparkSession, path: str) -> str | None:
    """The path as the operating system has it, if it is in a folder that is mounted and not in a store of its own."""
    files, found = _path(spark, path)
    return files.makeQualified(found).toUri().getPath() if files.getScheme() == "file" else None


def exists(spark: SparkSession, path: str) -> bool:
    files, found = _path(spark, path)
    return files.exists(found)


def remove(spark: SparkSession, path: str) -> None:
    files, found = _path(spark, path)
    files.delete(found, True)


def move_all(spark: SparkSession, places: Iterable[tuple[str, str]]) -> None:
    """Rename files or directories of one file system; the folders above the new places are made."""
    plain, files = spark._jvm.org.apache.hadoop.fs.Path, None
    for source, target in places:
        if files is None:
            files, _ = _path(spark, source)
        place = plain(target)
        files.mkdirs(place.getParent())
        if not files.rename(plain(source), place):
            raise OSError(f"could not move {source} to {target}")


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a directory, sorted; none if it is not there."""
    files, found = _path(spark, path)
    return sorted(status.getPath().getName() for status in files.listStatus(found)) if files.exists(found) else []


def versions(spark: SparkSession, path: str) -> list[str]:
    """Directories of the complete versions of the table at `path`, the newest last."""
    found = (f"{path.rstrip('/')}/{name}" for name in children(spark, path) if VERSION.fullmatch(name))
    return [place for place in found if exists(spark, f"{place}/{COMPLETE}")]


def current_path(spark: SparkSession, path: str) -> str:
    """Where the rows of the table at `path` are now: its newest version, or `path` itself if it has none."""
    found = versions(spark, path)
    return found[-1] if found else path


def replace_directory(df: DataFrame, path: str, partitions: Iterable[str] = ()) -> str:
    """Put the rows in place of the table at `path` as a new version, and give its directory.

    `df` may read the table itself. If the write fails, the table stays as it was. What is older than the version
    before goes, and with it rows that were written to `path` without a version.
    """
    spark, root = df.sparkSession, path.rstrip("/")
    before = versions(spark, path)
    number = 1 + max((int(name[1:11]) for name in children(spark, path) if VERSION.fullmatch(name)), default=0)
    version = f"{root}/v{number:010d}-{uuid.uuid4().hex}"
    writer = df.write.option("compression", COMPRESSION)
    writer = writer.partitionBy(*partitions) if partitions else writer
    try:
        writer.parquet(version)
    except BaseException:
        remove(spark, version)
        raise
    files, marker = _path(spark, f"{version}/{COMPLETE}")
    files.create(marker, False).close()
    if before:
        last = before[-1].rsplit("/", 1)[1]
        for name in children(spark, path):
            if not VERSION.fullmatch(name) or name < last:
                remove(spark, f"{root}/{name}")
    return version
