"""What is written and shuffled on the way, and by how many tasks."""

import re
from datetime import datetime, timedelta
from functools import partial
from pathlib import Path

import pyarrow.parquet as pq
from conftest import TEN_ROWS, approach_frame, rows
from feeds import document, land, neo
from pyspark.sql import functions as F

from perigee.catalog import store_queries
from perigee.plans import jobs
from perigee.session import shared_dir
from perigee.sinks.days import write_days
from perigee.sinks.feed import publish_files
from perigee.sources.feed import stream_feed
from perigee.sources.stores import read_days, read_union


def made(spark, name):
    """The newest work folder of a query."""
    return max(Path(shared_dir(spark).removeprefix("file:"), "perigee").glob(f"{name}-*"), key=lambda p: p.stat().st_mtime_ns)


def test_union_takes_days_as_the_stores_have_them(spark, tmp_path, monkeypatch):
    frame = approach_frame(spark, TEN_ROWS[:9]).withColumn("feed_date", F.col("close_approach_date"))
    for name in ("hist", "live"):
        write_days(frame, str(tmp_path / name))
    plans, replace = [], jobs.replace_directory

    def seen(df, *others):
        plans.append(df._jdf.queryExecution().toString())
        return replace(df, *others)

    monkeypatch.setattr(jobs, "replace_directory", seen)
    jobs.union(spark, str(tmp_path / "hist"), str(tmp_path / "live"), str(tmp_path / "union"))
    assert len(plans) == 1 and "Exchange" not in plans[0] and "Rebalance" not in plans[0]
    assert rows(read_union(spark, str(tmp_path / "union"))) == rows(approach_frame(spark, TEN_ROWS[:9] * 2))
    for name in ("hist", "union"):
        files = list((tmp_path / name).rglob("*.parquet"))
        assert files and all(pq.ParquetFile(f).metadata.row_group(0).column(0).compression == "ZSTD" for f in files)


def test_live_takes_compressed_documents(spark, tmp_path):
    first = [document({f"2024-01-{d:02d}": [neo(f"{d}-{i}")]}) for d in range(1, 6) for i in range(20)]
    for texts in (first, [document({"2024-01-03": [neo("last")]})]):
        land(tmp_path / "in", f"{len(texts)}.json", *texts)
        sent = partial(publish_files, path=str(tmp_path / "sent"), compression="lz4")
        sent(spark.read.text(str(tmp_path / "in" / f"{len(texts)}.json")).coalesce(1))
    assert all(f.name.endswith(".lz4") for f in (tmp_path / "sent").glob("part-*"))
    landed = stream_feed(spark, str(tmp_path / "sent"), max_files=1)
    jobs.live(spark, landed, str(tmp_path / "out"), str(tmp_path / "checkpoint"), tasks=3)
    wanted = {"1-19", "2-19", "last", "4-19", "5-19"}
    assert {i for (i,) in rows(read_days(spark, str(tmp_path / "out")), "id")} == wanted


def test_queries_land_compressed_documents(spark, tmp_path):
    times = [(i, datetime(2024, 1, 1 + i % 3), i, "error", float(i), "{}") for i in range(30)]
    spark.createDataFrame(times, "event_id long, ts timestamp, user_id long, event_type string, value double, props string").write.parquet(
        str(tmp_path / "events.parquet")
    )
    store_queries.land(spark, str(tmp_path), str(tmp_path / "landing"))
    files = list((tmp_path / "landing").glob("part-*"))
    assert files and all(f.name.endswith(".lz4") for f in files)
    assert spark.read.text(str(tmp_path / "landing")).count() == 33


def test_whole_files_are_landed_by_several_tasks(spark, tmp_path):
    spark.range(1, 61).selectExpr("id AS c_custkey", "'A' AS c_mktsegment").coalesce(1).write.parquet(str(tmp_path / "customer.parquet"))
    found = rows(store_queries._relayed(spark, str(tmp_path)))
    assert found == sorted((f'{{ "id": {i},  "name": "A" }}',) for i in range(1, 61))
    files = [f.name for f in (made(spark, "relayed") / "landing").rglob("part-*")]
    assert len(files) == 60 and len({re.match(r"part-(\d+)", name)[1] for name in files}) > 4


def test_plain_days_are_written_by_many_tasks_a_file_a_day(spark, tmp_path, monkeypatch):
    columns = "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double"
    columns += ", l_returnflag string, l_linestatus string, l_shipdate timestamp"
    items = [(i, 1, 1 + i % 7, 5.0, 9.0, 0.1, 0.01, "R", "O", datetime(2024, 1, 1) + timedelta(days=i % 90)) for i in range(180)]
    spark.createDataFrame(items, columns).write.parquet(str(tmp_path / "lineitem.parquet"))
    store_queries._plain_store(spark, str(tmp_path), str(tmp_path / "plain"))
    days = {}
    for file in (tmp_path / "plain").rglob("part-*.parquet"):
        days.setdefault(file.parent, []).append(re.match(r"part-(\d+)", file.name)[1])
    assert len(days) == 90 and all(len(parts) == 1 for parts in days.values())
    assert len({parts[0] for parts in days.values()}) > spark.sparkContext.defaultParallelism


def test_whole_files_are_written_by_the_tasks_themselves(spark, tmp_path, monkeypatch):
    given = [("{1}", 0), ("{2}\n", 1), ("{3}", None), (None, 1), ("{1}", 0)]
    frame = spark.createDataFrame(given, "value string, folder int")
    found = []
    for name in ("mounted", "store"):
        if name == "store":
            monkeypatch.setattr(store_queries, "mounted_path", lambda *_: None)
        store_queries.land_whole(frame, str(tmp_path / name))
        files = [f for f in (tmp_path / name).rglob("part-*") if f.is_file()]
        found.append(sorted((f.parent.name, f.read_bytes()) for f in files))
    assert found[0] == found[1] and len(found[0]) == 5
    assert not list((tmp_path / "mounted").rglob(".*.crc"))


def test_relay_publishes_few_files_of_many(spark, tmp_path):
    few = 16 * spark.sparkContext.defaultParallelism
    (tmp_path / "landing").mkdir()
    for i in range(few + 20):
        (tmp_path / "landing" / f"{i}.json").write_text(f"{{\n{i}\n}}\n")
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    # As if the files were so many that each task of the scan has its share.
    spark.conf.set("spark.sql.files.openCostInBytes", "1g")
    try:
        jobs.relay(spark, str(tmp_path / "landing"), partial(publish_files, path=str(tmp_path / "sent")), whole_files=True)
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", before)
    assert rows(spark.read.text(str(tmp_path / "sent"))) == sorted((f"{{ {i} }}",) for i in range(few + 20))
    assert len(list((tmp_path / "sent").glob("part-*"))) <= few
