"""The queries against their SQL, and the pipeline against a plain version, on the smallest tables."""

from __future__ import annotations

import sys
import zlib
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

import __spark_entry__ as entry_point  # noqa: E402
import brute  # noqa: E402
import corpus_pipeline  # noqa: E402
from perigee.llm.queries import QUERIES, SQL  # noqa: E402
from perigee.session import work_table  # noqa: E402

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.is_dir(), reason="test tables are not here")


def test_all_are_registered():
    assert QUERIES.items() <= entry_point.queries().items()
    assert SQL.items() <= entry_point.oracle_sql().items()
    assert {name.split("_")[0] for name in QUERIES} == {*(f"op{n}" for n in range(1, 14)), "pipeline"}


@pytest.mark.parametrize("name", list(SQL))
def test_query(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "benchmark", "conversations", "pages", "labels"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    result = QUERIES[name](spark, str(DATA))
    cursor = connection.execute(SQL[name])
    names = [column[0] for column in cursor.description]
    assert sorted(names) == sorted(result.columns)
    wanted = sorted(cursor.fetchall(), key=repr)
    assert sorted((tuple(row) for row in result.select(*names).collect()), key=repr) == wanted
    assert wanted


def _documents(spark):
    rows = spark.read.parquet(f"{DATA}/documents.parquet").collect()
    return {row.doc_id: row for row in rows}


def test_held_out_accuracy(spark):
    found = QUERIES["op2_language"](spark, str(DATA)).collect()
    docs = _documents(spark)
    held = [row for row in found if row.held_out]
    assert all(row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 4 == 2) for row in found)
    assert sum(docs[row.doc_id].lang == row.lang_pred for row in held) >= 0.95 * len(held)


def test_scores(spark):
    docs = _documents(spark)
    train = {i: zlib.crc32(str(i).encode()) % 7 != 2 for i in docs}
    wanted, total = brute.unigram_scores([(i, row.text, train[i]) for i, row in docs.items()])
    found = QUERIES["op4_score"](spark, str(DATA)).collect()
    assert len(found) == len(docs)
    for row in found:
        tokens, known, base = wanted[row.doc_id]
        assert (row.held_out, row.n_tokens, row.n_known) == (not train[row.doc_id], tokens, known)
        assert row.train_tokens == total and row.base_score == pytest.approx(base, abs=1e-6)
    held = [row for row in found if row.held_out]
    assert sum(row.score for row in held) > sum(row.base_score for row in held)


def test_private_values(spark):
    docs = _documents(spark)
    found = {row.doc_id: row.spans for row in QUERIES["op6_private"](spark, str(DATA)).collect()}
    for doc_id, row in docs.items():
        wanted = [f"{kind}:{start}:{end}" for kind, start, end in brute.private_spans(row.text)]
        assert [s for s in found[doc_id].split(",") if s and not s.startswith("term")] == wanted


def test_pages_give_their_articles(spark):
    found = QUERIES["op7_pages"](spark, str(DATA)).collect()
    assert found and all(row.n_chars == len(row.text) for row in found)
    assert all(row.text and "&amp;" not in row.text and "©" not in row.text for row in found)


def test_lines(spark):
    docs = _documents(spark)
    wanted = brute.line_dedup([(i, row.text) for i, row in docs.items()])
    found = {row.doc_id: (row.text, row.n_removed) for row in QUERIES["op9_lines"](spark, str(DATA)).collect()}
    assert sum(found[i] != wanted[i] for i in docs) <= 0.01 * len(docs)


def test_pipeline(spark):
    """Each stage against a plain version of itself on what the one before gave."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns, given = docs.columns, docs
    items = [(row.item_id, row.text) for row in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    sizes = []
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = {row.doc_id: row for row in given.collect()}
        given = work_table(stage(spark, given, str(DATA)), "stage")
        after = {row.doc_id: row for row in given.collect()}
        pairs = [(i, row.text) for i, row in before.items()]
        if number < 4:
            assert given.columns == columns, name
        if number == 0:
            wanted = {i for i, text in pairs if brute.quality(text)[-1]}
        elif number == 1:
            plain = brute.line_dedup(pairs)
            wanted = {i for i, (text, gone) in plain.items() if not gone or brute.WORD.search(text)}
            assert all(after[i].text == plain[i][0] for i in wanted)
            assert all(row.n_chars == len(row.text) for row in after.values())
        elif number == 2:
            wanted = {i for i, (_, first) in brute.near_groups(pairs).items() if i == first}
        elif number == 3:
            wanted = {i for i, found in brute.leaks(pairs, items).items() if not found[1]}
        else:
            taken, _ = brute.mix([(i, row.text, row.source) for i, row in before.items()])
            wanted = {i for i, n in taken.items() if n}
            assert {i: row.taken for i, row in after.items()} == {i: taken[i] for i in wanted}
        assert set(after) == wanted, name
        sizes.append(len(after))
    assert corpus_pipeline.run(spark, str(DATA)).count() == sizes[-1]
