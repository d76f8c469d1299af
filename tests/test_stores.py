from datetime import date, timedelta
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from conftest import TEN_ROWS, approach_frame, rows
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from perigee.operators.union import union_stores
from perigee.schema import APPROACH_COLUMNS, APPROACH_SCHEMA
from perigee.session import shared_dir, work_dir, work_table
from perigee.sinks.days import write_days
from perigee.sinks.feed import publish_files, publish_topic
from perigee.sinks.marts import read_mart, register_table, write_mart
from perigee.sources.feed import read_feed, stream_topic
from perigee.sources.stores import read_days, read_plain_days


@pytest.fixture()
def dated(spark):
    """The ten rows with the day they are stored under; the row without a date has one too."""
    frame = approach_frame(spark, TEN_ROWS)
    return frame.withColumn("feed_date", F.coalesce("close_approach_date", F.lit(date(2024, 6, 1))))


def parquet_files(root):
    return sorted(str(p.relative_to(root)) for p in Path(root).rglob("*.parquet"))


def test_day_store_layout_and_columns(spark, dated, tmp_path):
    root = str(tmp_path / "days")
    write_days(dated, root)
    stored = read_days(spark, root)
    assert stored.columns == list(APPROACH_COLUMNS)
    assert rows(stored) == rows(dated.drop("feed_date"))
    assert (tmp_path / "days/year=2024/month=3/day=31").is_dir()
    assert len(parquet_files(root)) == 10


def test_day_written_again_is_replaced(spark, dated, tmp_path):
    root = str(tmp_path / "days")
    write_days(dated, root)
    write_days(dated, root)
    assert rows(read_days(spark, root)) == rows(dated.drop("feed_date"))
    one = dated.filter("id = '1'").withColumn("name", F.lit("new"))
    write_days(one, root)
    assert rows(read_days(spark, root), "id", "name") == rows(
        dated.withColumn("name", F.when(F.col("id") == "1", "new")), "id", "name"
    )


def test_empty_day_writes_nothing(spark, dated, tmp_path):
    root = str(tmp_path / "days")
    write_days(dated, root)
    write_days(dated.filter("false"), root)
    assert read_days(spark, root).count() == 10


def test_day_range_reads_only_its_directories(spark, dated, tmp_path):
    root = str(tmp_path / "days")
    write_days(dated, root)
    picked = read_days(spark, root, date(2024, 1, 11), date(2024, 3, 31), partitions=True)
    assert rows(picked, "id", "year", "month", "day") == [("5", 2024, 1, 11), ("6", 2024, 3, 1), ("7", 2024, 3, 31)]
    # A directory out of range may even be unreadable.
    broken = next((tmp_path / "days/year=2023").rglob("*.parquet"))
    broken.write_bytes(b"x")
    broken.with_name(f".{broken.name}.crc").write_bytes(b"")
    assert rows(read_days(spark, root, date(2024, 5, 1)), "id") == [("10",), ("9",)]


def test_whole_numbers_and_fractions_are_stored_alike(spark, tmp_path):
    """Days whose values are all whole do not change the type of a column."""
    root = str(tmp_path / "days")
    for day, value in ((1, 20.0), (2, 20.5)):
        one = approach_frame(spark, [(str(day), date(2024, 1, day), True, value, *[None] * 4)])
        write_days(one.withColumn("feed_date", F.col("close_approach_date")), root)
    kinds = {
        pq.read_schema(tmp_path / "days" / name).field("absolute_magnitude_h").type for name in parquet_files(root)
    }
    assert kinds == {pa.float64()}
    assert rows(read_days(spark, root), "absolute_magnitude_h") == [(20.0,), (20.5,)]


def _plain_file(root, day, **changes):
    values = {name: [None] for name in APPROACH_COLUMNS}
    values.update({"id": ["1"], "close_approach_date": [str(day)], "absolute_magnitude_h": [20.5]})
    values.update({name: [value] for name, value in changes.items()})
    path = root / f"{day.year}/{day.month:02d}/{day.day:02d}.parquet"
    path.parent.mkdir(parents=True, exist_ok=True)
    kinds = {
        "string": pa.string(),
        "double": pa.float64(),
        "boolean": pa.bool_(),
        "date": pa.string(),
        "bigint": pa.int64(),
    }
    arrays = {}
    for field in APPROACH_SCHEMA:
        value = values[field.name]
        if isinstance(value[0], (int, str)):
            arrays[field.name] = pa.array(value)
        else:
            arrays[field.name] = pa.array(value, kinds[field.dataType.simpleString()])
    pq.write_table(pa.table(arrays), path)


def test_plain_day_files_are_cast(spark, tmp_path):
    for number in (1, 2):
        _plain_file(tmp_path, date(2024, 1, number), relative_velocity_kilometers_per_second=f"{number}.5")
    taken = read_plain_days(spark, str(tmp_path))
    assert [f.dataType for f in taken.schema][: len(APPROACH_SCHEMA)] == [f.dataType for f in APPROACH_SCHEMA]
    assert rows(
        taken, "close_approach_date", "relative_velocity_kilometers_per_second", "year", "month", "day"
    ) == [(date(2024, 1, 1), 1.5, 2024, 1, 1), (date(2024, 1, 2), 2.5, 2024, 1, 2)]


def test_plain_day_files_of_different_types_are_taken_over(spark, tmp_path):
    _plain_file(tmp_path, date(2024, 1, 1), absolute_magnitude_h=20, epoch_date_close_approach=5)
    _plain_file(tmp_path, date(2024, 1, 2), absolute_magnitude_h=20.5, epoch_date_close_approach=6.0)
    _plain_file(tmp_path, date(2024, 1, 3), absolute_magnitude_h="21.25")
    taken = read_plain_days(spark, str(tmp_path))
    assert rows(taken, "day", "absolute_magnitude_h", "epoch_date_close_approach") == [
        (1, 20.0, 5),
        (2, 20.5, 6),
        (3, 21.25, None),
    ]


def test_plain_day_value_that_does_not_fit_fails(spark, tmp_path):
    _plain_file(tmp_path, date(2024, 1, 1), absolute_magnitude_h="bright")
    with pytest.raises(Exception, match="bright"):
        read_plain_days(spark, str(tmp_path)).collect()


def test_one_day_with_most_rows_is_split(spark, tmp_path):
    """A day too large for one task is written by several."""
    rows_, hot = 60000, 40000
    day = F.when(F.col("id") < hot, F.lit(date(2024, 1, 1))).otherwise(
        F.date_add(F.lit(date(2024, 1, 2)), (F.col("id") % 20).cast("int"))
    )
    wide = F.concat(*(F.sha2(F.concat(F.col("id").cast("string"), F.lit(str(i))), 512) for i in range(3)))
    frame = spark.range(0, rows_, numPartitions=8).select(
        day.alias("feed_date"),
        *(
            (F.col("id") if name == "id" else wide if name == "name" else F.lit(None)).cast(kind.dataType).alias(name)
            for name, kind in zip(APPROACH_COLUMNS, APPROACH_SCHEMA)
        ),
    )
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "2m")
    try:
        write_days(frame, str(tmp_path / "days"))
    finally:
        spark.conf.set(size, before)
    files = [name for name in parquet_files(tmp_path / "days") if "month=1/day=1/" in name]
    assert len(files) > 2
    assert read_days(spark, str(tmp_path / "days")).select("id").distinct().count() == rows_


def test_union_keeps_duplicates_and_matches_names(spark, ten):
    turned = ten.select(*reversed(APPROACH_COLUMNS))
    both = union_stores(ten, turned)
    assert both.columns == list(APPROACH_COLUMNS)
    assert both.count() == 20
    assert rows(both.distinct()) == rows(ten)
    with pytest.raises(AnalysisException):
        union_stores(ten, ten.withColumnRenamed("name", "title"))


def test_mart_modes(spark, ten, tmp_path):
    path = str(tmp_path / "mart")
    write_mart(ten, path)
    write_mart(ten.limit(3), path)
    assert read_mart(spark, path).count() == 3
    with pytest.raises(AnalysisException, match="ALREADY_EXISTS"):
        write_mart(ten, path, mode="error")


def test_registered_mart_follows_its_files(spark, ten, tmp_path):
    path = str(tmp_path / "it's a mart")
    write_mart(ten.select("id"), path)
    register_table(spark, "registered_mart", path)
    assert spark.table("registered_mart").count() == 10
    write_mart(ten.select("id").limit(2), path)
    register_table(spark, "registered_mart", path)
    assert spark.sql("SELECT count(*) FROM registered_mart").collect()[0][0] == 2


def test_registered_store_finds_new_days(spark, dated, tmp_path):
    path = str(tmp_path / "days")
    write_days(dated.filter("id = '1'"), path)
    register_table(spark, "registered_days", path)
    write_days(dated.filter("id = '9'"), path)
    register_table(spark, "registered_days", path)
    found = spark.sql("SELECT id, year, month FROM registered_days")
    assert rows(found) == [("1", 2023, 11), ("9", 2024, 5)]


def test_landed_documents(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.json").write_text('{"a": 1}\n{"a": 2}\n')
    assert rows(read_feed(spark, str(tmp_path / "in")), "value") == [('{"a": 1}',), ('{"a": 2}',)]
    (tmp_path / "whole").mkdir()
    (tmp_path / "whole/a.json").write_text('{\n"a": 1\n}')
    assert rows(read_feed(spark, str(tmp_path / "whole"), whole_files=True), "value") == [('{\n"a": 1\n}',)]


def test_empty_documents_are_not_published(spark, tmp_path):
    folder = str(tmp_path / "out")
    documents = spark.createDataFrame([("{}",), ("",), (" ",), ("null",), (None,), ('{"a": 1}',)], "value string")
    publish_files(documents, folder)
    publish_files(documents, folder)
    assert rows(spark.read.text(folder)) == [('{"a": 1}',), ('{"a": 1}',)]


def test_topic_needs_the_connector(spark, ten):
    """The topic reader and writer are Spark's; without the connector they say so."""
    with pytest.raises(AnalysisException, match="kafka"):
        stream_topic(spark, "nowhere:9092", "feed")
    with pytest.raises(AnalysisException, match="kafka"):
        publish_topic(ten.select(F.col("id").alias("value")), "nowhere:9092", "feed")


def test_work_tables_go_to_the_named_folder(spark, ten):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert work_dir(spark, "a") != work_dir(spark, "a")
    kept = work_table(ten.select("id"), "kept")
    assert kept.inputFiles()[0].startswith(f"file://{shared_dir(spark)}/perigee/kept-")
    assert rows(kept) == rows(ten, "id")


def test_without_a_named_folder(monkeypatch):
    """A local session makes one of its own; a cluster session is refused."""

    class Context:
        def __init__(self, master):
            self.master, self.folder = master, None

        def setCheckpointDir(self, folder):
            self.folder = folder

        def getCheckpointDir(self):
            return self.folder

    class Session:
        def __init__(self, master):
            self.conf, self.sparkContext = {}, Context(master)

    alone = Session("local[2]")
    assert "perigee-" in shared_dir(alone) and shared_dir(alone) == shared_dir(alone)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(Session("yarn"))


def test_long_range_of_days(spark, tmp_path):
    """Several hundred days in one write, one directory each."""
    start = date(2023, 1, 1)
    frame = approach_frame(spark, [(str(i), start + timedelta(days=i), True, *[None] * 5) for i in range(400)])
    write_days(frame.withColumn("feed_date", F.col("close_approach_date")), str(tmp_path / "days"))
    assert len({name.rsplit("/", 1)[0] for name in parquet_files(tmp_path / "days")}) == 400
    assert read_days(spark, str(tmp_path / "days")).count() == 400
