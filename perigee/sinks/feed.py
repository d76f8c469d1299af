"""Publishing of feed documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _messages(documents: DataFrame) -> DataFrame:
    # Nothing is sent for an empty document. A message is one line: in JSON, line ends only stand between
    # tokens, where a space does as well.
    sent = documents.select("value").filter(~F.btrim("value", F.lit(" \t\r\n")).isin("", "{}", "null"))
    return sent.select(F.regexp_replace(F.btrim("value", F.lit(" \t\r\n")), "[\r\n]+", " ").alias("value"))


def publish_files(documents: DataFrame, path: str, compression: str = "none") -> None:
    """Add documents to a landing folder, one per line.

    With a `compression` (such as "lz4" or "gzip") the files are a tenth or less, since documents repeat their field
    names; all readers here take them as they are, each file by one task.
    """
    _messages(documents).write.mode("append").option("compression", compression).text(path)


def publish_topic(documents: DataFrame, servers: str, topic: str) -> None:
    """Send documents to a Kafka topic, one message each. Needs Spark's Kafka connector."""
    (
        _messages(documents)
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .save()
    )
