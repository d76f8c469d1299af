import os
from datetime import date

import pytest
from conftest import rows
from feeds import document, land, neo
from pyspark.sql import functions as F

from perigee.operators.flatten import MALFORMED, flatten_feed
from perigee.plans.ingest import FeedErrors, ingest
from perigee.sources.feed import read_feed, stream_feed
from perigee.sources.stores import read_days
from perigee.streaming.live import run_live


class Live:
    def __init__(self, spark, root):
        self.spark, self.root = spark, root
        self.landing, self.out, self.errors = root / "landing", str(root / "out"), str(root / "errors")

    def run(self, max_files=None):
        documents = stream_feed(self.spark, str(self.landing), max_files)
        run_live(documents, self.out, str(self.root / "checkpoint"), self.errors)

    def ids(self):
        return [i for (i,) in rows(read_days(self.spark, self.out), "id")]


@pytest.fixture()
def live(spark, tmp_path):
    (tmp_path / "landing").mkdir()
    return Live(spark, tmp_path)


def day_document(number, *ids):
    day = f"2024-01-{number:02d}"
    return document({day: [neo(i, day) for i in ids]})


def aged(path, seconds):
    """Set the time a file was last changed, counted from a fixed start."""
    os.utime(path, (1704067200 + seconds, 1704067200 + seconds))


def test_stream_equals_batch(spark, live):
    for number in (1, 2, 3):
        land(live.landing, f"{number}.json", day_document(number, number, 10 + number))
    live.run()
    batch = flatten_feed(read_feed(spark, str(live.landing))).drop("feed_date")
    assert rows(read_days(spark, live.out)) == rows(batch)


def test_restart_takes_only_what_is_new(live):
    land(live.landing, "1.json", day_document(1, 1))
    live.run()
    live.run()
    assert live.ids() == ["1"]
    progress = sorted(p.name for p in (live.root / "checkpoint/commits").iterdir() if not p.name.startswith("."))
    land(live.landing, "2.json", day_document(2, 2))
    live.run()
    assert live.ids() == ["1", "2"]
    after = sorted(p.name for p in (live.root / "checkpoint/commits").iterdir() if not p.name.startswith("."))
    assert (progress, after) == (["0"], ["0", "1"])


def test_later_run_replaces_a_day(live):
    land(live.landing, "1.json", day_document(1, 1, 2, 3), day_document(2, 4))
    live.run()
    land(live.landing, "2.json", day_document(1, 5))
    live.run()
    assert live.ids() == ["4", "5"]


def test_same_day_again_changes_nothing(live):
    land(live.landing, "1.json", day_document(1, 1, 2))
    live.run()
    land(live.landing, "2.json", day_document(1, 1, 2))
    live.run()
    assert live.ids() == ["1", "2"]


def test_newest_file_of_a_batch_counts(live):
    aged(land(live.landing, "a.json", day_document(1, 1)), 200)
    aged(land(live.landing, "b.json", day_document(1, 2)), 100)
    live.run()
    assert live.ids() == ["1"]


def test_last_line_of_a_file_counts(live):
    land(live.landing, "1.json", *(day_document(1, i) for i in range(1, 40)))
    live.run()
    assert live.ids() == ["39"]


def test_files_taken_one_by_one(live):
    aged(land(live.landing, "b.json", day_document(1, 1)), 100)
    aged(land(live.landing, "a.json", day_document(1, 2)), 200)
    aged(land(live.landing, "c.json", day_document(2, 3)), 300)
    live.run(max_files=1)
    assert live.ids() == ["2", "3"]


def test_bad_message_is_reported_once_and_does_not_block(spark, live):
    land(live.landing, "1.json", "not json", day_document(1, 1))
    with pytest.raises(FeedErrors) as raised:
        live.run()
    assert raised.value.count == 1
    assert live.ids() == ["1"]
    found = spark.read.parquet(live.errors)
    assert rows(found, "value", "reason", "batch") == [("not json", MALFORMED, 0)]
    land(live.landing, "2.json", day_document(2, 2))
    live.run()
    assert live.ids() == ["1", "2"]


def test_bad_message_does_not_replace_a_good_day(live):
    land(live.landing, "1.json", day_document(1, 1))
    live.run()
    land(live.landing, "2.json", document({"2024-01-01": [neo(2), neo(3, close_approach_data=[])]}))
    with pytest.raises(FeedErrors):
        live.run()
    assert live.ids() == ["1"]


def test_one_day_with_most_messages(spark, live):
    """Half of many messages are for one day; each day keeps its newest."""
    for part in range(4):
        lines = []
        for i in range(100):
            number = 1 if i % 2 else 2 + i % 20
            lines.append(day_document(number, f"{part}-{i}"))
        aged(land(live.landing, f"{part}.json", *lines), part)
    live.run()
    days = rows(read_days(spark, live.out).groupBy("close_approach_date").agg(F.max("id"), F.count("*")))
    assert days[0] == (date(2024, 1, 1), "3-99", 1)
    assert len(days) == 11 and {n for *_, n in days} == {1}


def test_newest_message_of_a_topic_counts(spark, tmp_path):
    """Messages as a topic gives them: the time decides, then the place in the topic."""
    from datetime import datetime

    early, late = datetime(2024, 1, 1, 1), datetime(2024, 1, 1, 2)
    messages = [
        (day_document(1, 1), (late, 0, 5)),
        (day_document(1, 2), (early, 1, 900)),
        (day_document(2, 3), (late, 1, 10)),
        (day_document(2, 4), (late, 1, 9)),
    ]
    kind = "value string, origin struct<timestamp: timestamp, partition: int, offset: bigint>"
    out = str(tmp_path / "out")
    assert ingest(spark.createDataFrame(messages, kind).repartition(3), out, str(tmp_path / "errors")) == 0
    assert rows(read_days(spark, out), "id") == [("1",), ("3",)]
