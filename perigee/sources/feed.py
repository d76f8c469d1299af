"""Feed documents, landed as text or relayed as messages.

All readers give `value` (the document) and `origin` (where and when it came in, in an order
that puts the newer document last), so everything after them is shared.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _file_origin() -> Column:
    return F.struct(
        F.col("_metadata.file_modification_time").alias("time"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
    )


def _message_origin() -> Column:
    # Offsets only compare within a topic partition, so the message time goes first.
    return F.struct("timestamp", "partition", "offset")


def read_feed(spark: SparkSession, path: str, whole_files: bool = False) -> DataFrame:
    """Landed documents: one per line, or one per file with `whole_files`."""
    text = spark.read.text(path, wholetext=whole_files)
    return text.select("value", _file_origin().alias("origin"))


def stream_feed(
    spark: SparkSession,
    path: str,
    max_files: int | None = None,
    whole_files: bool = False,
    archive: str | None = None,
    keep_seen: str | None = None,
) -> DataFrame:
    """Landed documents as a stream, oldest file first: one per line, or one per file with `whole_files`.

    With `archive`, Spark moves files there that an earlier batch has finished with, which also takes care of those that a
    lost run left. `keep_seen` is how long names of seen files are remembered (such as "30d"; a week by default); a file
    that lands with an older time than that before the newest is not taken.
    """
    reader = spark.readStream.format("text").option("wholetext", whole_files)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    if keep_seen:
        reader = reader.option("maxFileAge", keep_seen)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path).select("value", _file_origin().alias("origin"))


def stream_topic(
    spark: SparkSession, servers: str, topic: str, options: Mapping[str, str] | None = None
) -> DataFrame:
    """Messages of a Kafka topic as a stream, from the earliest one unless a checkpoint says otherwise.

    Needs Spark's Kafka connector on the class path. `maxOffsetsPerTrigger` among the options
    limits how much one batch takes.
    """
    settings = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
        **(options or {}),
    }
    messages = spark.readStream.format("kafka").options(**settings).load()
    return messages.select(F.col("value").cast("string").alias("value"), _message_origin().alias("origin"))
