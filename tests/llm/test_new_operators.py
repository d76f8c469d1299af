"""Search, near-dedup by odd sketches and the Merkle manifest against plain versions, on tables with the cases that go wrong easily."""

from __future__ import annotations

import random
import sys
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

import brute  # noqa: E402
from perigee.llm import merkle, search, sketches  # noqa: E402

WORDS = [a + b + c for a in "bdfglmnprst" for b in "aeiou" for c in ("n", "r", "s", "lo")]


def prose(r, n):
    return " ".join(r.choice(WORDS) for _ in range(n))


def edited(r, text, edits):
    words = text.split(" ")
    for _ in range(edits):
        words[r.randrange(len(words))] = r.choice(WORDS)
    return " ".join(words)


@pytest.fixture(scope="module")
def rows():
    """(doc_id, text, source): null, empty, long and equal texts, repeated rows, null and equal ids, a large group."""
    r = random.Random(3)
    base, long_one = prose(r, 120), prose(r, 30_000)
    texts = [None, "", " \n ", "one", "One", "one two", "É!! 漢字 x-y_z 42", long_one, long_one + " end", "z" * 40_000]
    texts += [edited(r, base, r.randrange(12)) for _ in range(60)]
    texts += [base] * 10
    texts += [edited(r, prose(r, n), 0) for n in (4, 5, 6, 9, 30, 80) for _ in range(4)]
    texts += [edited(r, prose(random.Random(n), 60), k) for n in range(6) for k in (0, 1, 2, 4)]
    out = [(i, t, ("a", None, "b", "", "a", "a", "lone" if i == 6 else "é")[i % 7]) for i, t in enumerate(texts)]
    return out + [out[20], out[20], (20, "another text under the same id", "a"), (None, base, "b"), (None, None, None)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    clashing = ("key", "node", "n", "rank", "score", "tree", "idx", "at", "path", "component", "terms", "slot")
    return frame.withColumns({name: F.lit(name) for name in clashing}).repartition(3)


def test_search(spark, docs, rows):
    r = random.Random(9)
    items = [(i, prose(r, n)) for i, n in enumerate((1, 2, 8, 25, 70))]
    items += [(5, None), (6, ""), (7, "qqq zzz"), (None, WORDS[3]), (8, WORDS[5].upper() + "!" + WORDS[6]), (8, WORDS[5].upper() + "!" + WORDS[6])]
    frame = spark.createDataFrame(items, "item_id long, text string").withColumn("key", F.lit(1))
    wanted = brute.search([(i, t) for i, t, _ in rows], items)
    found = search.search(docs, frame)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(wanted, key=repr)
    few = search.search(docs, frame, top=3)
    assert sorted(map(tuple, few.collect()), key=repr) == sorted((x for x in wanted if x[1] <= 3), key=repr)
    assert search.search(docs.filter("false"), frame).count() == 0
    assert search.search(docs, frame.filter("false")).count() == 0


def test_search_in_several_blocks(spark, docs, rows, monkeypatch):
    """Small blocks of queries, documents and length classes give the same."""
    r = random.Random(10)
    items = [(i, prose(r, 20)) for i in range(6)]
    monkeypatch.setattr(search, "QUERY_TERMS", 40)
    frame = spark.createDataFrame(items, "item_id long, text string")
    wanted = brute.search([(i, t) for i, t, _ in rows], items, 5)
    assert sorted(map(tuple, search.search(docs, frame, 5).collect()), key=repr) == sorted(wanted, key=repr)


def test_masks_stop_early():
    """Of many documents with one mask, only those of masks that can win are looked at; more than 64 terms make a mask."""
    import pyarrow as pa

    n, size = 400, 70
    held = [list(range(size)) if i % 100 == 0 else [i % size] for i in range(n)]
    counts = [[1 + i % 3] * len(t) for i, t in enumerate(held)]
    block = search.Block(
        pa.array(range(n), pa.int64()), np.full(n, 100), pa.array(held, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int64())), size
    )
    best, looked = search.Best(3), []
    put = best.put
    best.put = lambda scores, none, ids: (looked.extend(ids.tolist()), put(scores, none, ids))
    block.search(np.arange(size), np.full(size, 1000), best)
    assert sorted(best.ids.tolist()) == [100, 200, 300] or set(best.ids.tolist()) <= {0, 100, 200, 300}
    assert len(looked) < n / 2


@pytest.mark.parametrize(("shingle", "percent"), [(4, 80), (5, 80), (2, 90)])
def test_near_components(docs, rows, shingle, percent):
    found = sketches.with_components(docs, shingle, percent)
    wanted = brute.similar_groups([(i, t) for i, t, _ in rows], shingle, percent)
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(wanted, key=repr)


def test_near_components_in_small_blocks(docs, rows, monkeypatch):
    """Buckets cut into many blocks, nothing compared with the first node: the same links."""
    monkeypatch.setattr(sketches, "SKETCH_BLOCK", 7)
    monkeypatch.setattr(sketches, "BLOCK_SETS", 5)
    found = sketches.with_components(docs, 4, 80)
    wanted = brute.similar_groups([(i, t) for i, t, _ in rows], 4, 80)
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(wanted, key=repr)


def test_near_components_of_nothing(docs):
    assert sketches.with_components(docs.filter("false")).count() == 0
    assert sketches.with_components(docs.filter("text IS NULL")).filter("kept AND n_shingles = 0").count() == 2


def test_sketches_tell_similarity():
    """The estimate is near the similarity, and no pair of 0.8 is dropped; most of 0.5 are."""
    r = np.random.default_rng(4)
    for similarity, error in ((0.95, 0.05), (0.8, 0.12)):
        odd = []
        for _ in range(150):
            union = r.integers(0, 2**63, 400).astype(np.uint64)
            shared = int(400 * similarity)
            rest = (400 - shared) // 2
            sampled = np.stack([sketches.samples(union[: shared + rest]), sketches.samples(np.delete(union, slice(shared, shared + rest)))])
            a, b = sketches.odd_sketches(sampled)
            odd.append(int(np.bitwise_count(a ^ b).sum()))
        assert max(odd) <= sketches.most_odd_bits(80)
        assert abs(np.mean([sketches.estimated_similarity(x) for x in odd]) - similarity) < 0.02
        assert max(abs(sketches.estimated_similarity(x) - similarity) for x in odd) < error + 0.03
    a, b = (sketches.samples(r.integers(0, 2**63, 300).astype(np.uint64)) for _ in range(2))
    a, b = sketches.odd_sketches(np.stack([a, b]))
    assert int(np.bitwise_count(a ^ b).sum()) > sketches.most_odd_bits(80)


@pytest.mark.parametrize("arity", [2, 3, 5])
def test_manifest(docs, rows, arity):
    leaves = docs.withColumn("digest", merkle.leaf_digest(F.col("doc_id"), F.col("text")))
    found, root = merkle.manifest(leaves, "source", ["doc_id"], arity)

    def field(value):
        return "-" if value is None else f"{len(str(value).encode())}:{value}"

    wanted, wanted_root = brute.manifest([(s, i, brute.sha(field(i) + field(t))) for i, t, s in rows], arity)
    assert root == wanted_root
    got = [(x.digest, x.subroot, [(s.slot, s.siblings) for s in x.path]) for x in found.collect()]
    assert sorted(got, key=repr) == sorted(wanted, key=repr)
    folded = found.select(merkle.folded(F.col("digest"), F.col("path")).alias("f")).distinct().collect()
    assert [x.f for x in folded] == [root]
    other = found.select(merkle.folded(F.sha2("digest", 256), F.col("path")).alias("f")).filter(F.col("f") == root)
    assert other.count() == 0


def test_manifest_of_little(spark):
    one = spark.createDataFrame([(1, "s", "d0")], "doc_id long, source string, digest string")
    found, root = merkle.manifest(one, "source", ["doc_id"])
    assert root == "d0" and [x.path for x in found.collect()] == [[]]
    found, root = merkle.manifest(one.filter("false"), "source", ["doc_id"])
    assert root is None and found.count() == 0


def test_manifest_of_equal_rows(spark):
    """Rows repeated are leaves of their own, in several ranges."""
    many = spark.range(50).select(F.lit(1).alias("doc_id"), F.lit(None).cast("string").alias("source"), F.lit("d").alias("digest"))
    found, root = merkle.manifest(many, "source", ["doc_id"])
    assert root == brute.tree(["d"] * 50, 3)[0] and found.select("idx").distinct().count() == 50
