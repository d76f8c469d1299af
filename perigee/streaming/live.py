"""The live path: messages to day partitions."""

from __future__ import annotations

from urllib.parse import unquote, urlsplit

from pyspark.sql import DataFrame

from perigee.plans.ingest import FeedErrors, ingest
from perigee.sinks.files import move_all


def run_live(
    documents: DataFrame,
    out: str,
    checkpoint: str,
    errors: str,
    ledger: str | None = None,
    archive: str | None = None,
    tasks: int | None = None,
) -> None:
    """Take all messages not yet taken, store their days, and stop.

    Progress is kept at `checkpoint`, so a run takes each message once; a batch repeated after
    a failure writes the same days again. A later batch replaces the days of an earlier one.
    Unusable messages go to `errors/batch=<n>`; the others are stored, the checkpoint moves
    on, and FeedErrors is raised at the end, so that a bad message is reported once and does
    not hold up those behind it.

    With `archive`, the landed files that the run took are moved below that folder once they are stored, so that a
    landing folder holds what is new and no more. Their names come to the driver, as they do for Spark's own progress.
    `tasks` is as for `ingest`.
    """
    unusable, taken = 0, set()

    def store(batch: DataFrame, number: int) -> None:
        nonlocal unusable
        if archive:
            taken.update(row.file for row in batch.select("origin.file").distinct().collect())
        unusable += ingest(batch, out, f"{errors}/batch={number}", ledger=ledger, tasks=tasks)

    query = (
        documents.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if archive:
        files = sorted(unquote(file) for file in taken)
        move_all(documents.sparkSession, ((file, archive.rstrip("/") + urlsplit(file).path) for file in files))
    if unusable:
        raise FeedErrors(unusable, errors)
