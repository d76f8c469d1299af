"""Session settings and the shared folder used for work tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# What results depend on, plus file sizing. Cluster sizing (executors, memory, shuffle
# partitions) belongs to the submitter; adaptive execution fits partitions to the data.
SETTINGS = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "perigee", master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by the session.

    Without one, a local session gets a temporary folder; a cluster session is refused, since
    a folder of one machine would be lost with it.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="perigee-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def work_dir(spark: SparkSession, name: str) -> str:
    """New path for one run, below the shared folder."""
    return f"{shared_dir(spark)}/perigee/{name}-{uuid.uuid4().hex}"


_scopes: ContextVar[tuple[list[str], ...]] = ContextVar("scopes", default=())


@contextmanager
def work_scope(spark: SparkSession) -> Iterator[None]:
    """Work tables written inside are removed when it ends, but for those written with `keep`.

    For steps towards a result: what is kept must have been written, not only planned, before the scope ends.
    """
    made: list[str] = []
    token = _scopes.set((*_scopes.get(), made))
    try:
        yield
    finally:
        _scopes.reset(token)
        for path in made:
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(place, True)


def work_table(df: DataFrame, name: str, keep: bool = False, compression: str = "snappy") -> DataFrame:
    """Write `df` to the shared folder and read it back.

    For small results that several outputs start from: the scan behind them runs once, and a
    lost executor costs a re-read of the small table, not the scan. Inside a `work_scope` the table goes with it, or
    with the scope around that if it is to be kept. `compression` is for the few that grow with the rows.
    """
    spark = df.sparkSession
    path = work_dir(spark, name)
    scopes = _scopes.get()[:-1] if keep else _scopes.get()
    if scopes:
        scopes[-1].append(path)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
