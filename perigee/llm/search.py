"""Ranked lexical search: the best documents for every item of a query set, exactly.

Documents are read in blocks of similar length. In a block, an item's documents are grouped by their presence mask, the
bitmap of the item's terms that they hold. A mask and a length bound the score of its documents from above; masks are
evaluated by descending bound until the next one cannot reach the item's best documents any more. Each task keeps the
best of all it has read, so the bar rises from block to block.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from perigee.llm.code import ship_code
from perigee.llm.filters import signed
from perigee.llm.words import separated_by, slices, word_hashes
from perigee.session import work_table

#: A term is a longest run of ASCII letters and digits and of whatever is not ASCII.
SEPARATORS = bytes(b for b in range(0x80) if not chr(b).isalnum())
#: Documents listed for an item.
TOP = 50
#: Terms of the items that are searched together, about; larger query sets are dealt into several such blocks.
QUERY_TERMS = 1 << 18
BLOCK_DOCS = 2048
#: Length classes of a block; each has bounds of its own.
LEVELS = 8
BLOCK_WORDS = 1 << 18
#: Best lists are cut by item and slice of the tasks before they are cut by item.
SLICES = 64


def _blocks(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Terms of the texts a block at a time: the block's first row, the terms' hashes, each text's offset among them."""
    words, offsets = word_hashes(texts, separated_by(SEPARATORS))
    for first, last in slices(offsets, BLOCK_WORDS):
        own = offsets[first : last + 1]
        yield first, words[own[0] : own[-1]], own - own[0]


def item_terms(items: DataFrame) -> DataFrame:
    """key and terms (distinct hashes) of every item (key, text) that has any."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, words, offsets in _blocks(batch.column(1)):
                own = [np.unique(words[low:high]) for low, high in zip(offsets[:-1], offsets[1:], strict=True)]
                ends = np.cumsum([0, *map(len, own)])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, len(own)),
                        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), signed(np.concatenate(own))),
                    ],
                    names=["key", "terms"],
                )

    return items.select("key", "text").mapInArrow(read, "key long, terms array<long>").filter("size(terms) > 0")


def term_counts(docs: DataFrame, vocabulary: np.ndarray) -> DataFrame:
    """doc_id, n (terms with repeats), and terms and counts: what the document holds of the sorted `vocabulary`, by place."""
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for batch in batches:
            for first, words, offsets in _blocks(batch.column(1)):
                place = np.minimum(np.searchsorted(known, words), len(known) - 1)
                found = np.flatnonzero(known[place] == words)
                owner = np.searchsorted(offsets, found, "right") - 1
                pairs, counts = np.unique(owner * len(known) + place[found], return_counts=True)
                ends = pa.array(np.searchsorted(pairs, np.arange(len(offsets)) * len(known)), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, len(offsets) - 1),
                        pa.array(np.diff(offsets), pa.int64()),
                        pa.ListArray.from_arrays(ends, pa.array(pairs % len(known), pa.int32())),
                        pa.ListArray.from_arrays(ends, pa.array(counts, pa.int64())),
                    ],
                    names=["doc_id", "n", "terms", "counts"],
                )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        read, "doc_id long, n long, terms array<int>, counts array<long>"
    )


def holders(counted: DataFrame, size: int) -> np.ndarray:
    """For each of `size` terms how many documents hold it. One number per term is all that leaves the tasks."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, dtype=np.int64)
        for batch in batches:
            total += np.bincount(batch.column(0).flatten().to_numpy(), minlength=size)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int64()), pa.array(total[held])], names=["term", "n"])

    sums = counted.select("terms").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    out = np.zeros(size, dtype=np.int64)
    for term, n in sums.collect():
        out[term] = n
    return out


def contribution(weight: np.ndarray, count: np.ndarray, length: np.ndarray) -> np.ndarray:
    """What `count` occurrences of a term add to the score; it rises with the count and falls with the length."""
    return weight * ((1_000_000_000 * count) // np.maximum(1000 * count + 20 * length, 1))


class Best:
    """The best documents of one item so far: score, id (and whether there is none), best first."""

    def __init__(self, top: int):
        self.top = top
        self.scores = np.zeros(0, dtype=np.int64)
        self.none, self.ids = np.zeros(0, dtype=bool), np.zeros(0, dtype=np.int64)

    @property
    def bar(self) -> int:
        """The least score that can still get in; at equal scores the id decides."""
        return int(self.scores[-1]) if len(self.scores) >= self.top else 1

    def put(self, scores: np.ndarray, none: np.ndarray, ids: np.ndarray) -> None:
        good = scores >= self.bar
        scores = np.concatenate([self.scores, scores[good]])
        none, ids = np.concatenate([self.none, none[good]]), np.concatenate([self.ids, ids[good]])
        first = np.lexsort((ids, none, -scores))[: self.top]
        self.scores, self.none, self.ids = scores[first], none[first], ids[first]


class Block:
    """Documents of similar length with their counts by term."""

    def __init__(self, ids: pa.Array, lengths: np.ndarray, terms: pa.Array, counts: pa.Array, size: int):
        self.none = ids.is_null().to_numpy(zero_copy_only=False)
        self.ids = ids.fill_null(0).to_numpy()
        self.lengths = lengths
        owner = np.repeat(np.arange(len(ids)), terms.value_lengths().to_numpy())
        flat = terms.flatten().to_numpy()
        order = np.argsort(flat, kind="stable")
        self.owner, self.counts = owner[order], counts.flatten().to_numpy()[order]
        self.starts = np.searchsorted(flat[order], np.arange(size + 1))
        # The lengths ascend, so a class's first document is its shortest.
        self.classes = np.unique(np.linspace(0, len(ids), LEVELS + 1).astype(np.int64)[:-1])
        self.level = np.searchsorted(self.classes, np.arange(len(ids)), "right") - 1

    def masks(self, held: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The documents in groups of equal mask and length class: a document of each group, and each document's group."""
        bits = np.packbits(held, axis=0)
        groups = self.level
        for row in range(0, len(bits), 4):
            word = np.zeros(bits.shape[1], dtype=np.int64)
            for byte in bits[row : row + 4]:
                word = word << 8 | byte
            _, groups = np.unique(groups << 32 | word, return_inverse=True)
        _, firsts, groups = np.unique(groups, return_index=True, return_inverse=True)
        return firsts, groups

    def search(self, terms: np.ndarray, weights: np.ndarray, best: Best) -> None:
        """Put the block's documents that get into `best` there."""
        counts = np.zeros((len(terms), len(self.ids)), dtype=np.int64)
        for row, term in enumerate(terms.tolist()):
            low, high = self.starts[term], self.starts[term + 1]
            counts[row, self.owner[low:high]] = self.counts[low:high]
        most = np.maximum.reduceat(counts, self.classes, axis=1)
        caps = contribution(weights[:, None], most, self.lengths[self.classes][None, :])
        # No mask can do better than all terms together.
        if caps.sum(0).max() < best.bar:
            return
        held = counts > 0
        firsts, groups = self.masks(held)
        bounds = np.where(held[:, firsts], caps[:, self.level[firsts]], 0).sum(0)
        order = np.argsort(-bounds, kind="stable")
        order = order[: np.searchsorted(-bounds[order], -best.bar, "right")]
        # Members of the groups, group after group by descending bound.
        place = np.full(len(firsts), len(order))
        place[order] = np.arange(len(order))
        ranked = place[groups]
        members = np.argsort(ranked, kind="stable")
        ends = np.searchsorted(ranked[members], np.arange(len(order)), "right")
        low, step, done = 0, best.top, 0
        while done < len(order) and bounds[order[done]] >= best.bar:
            # As many groups as bring `step` documents, one at least.
            done = max(done + 1, int(np.searchsorted(ends, low + step, "right")))
            docs = members[low : ends[done - 1]]
            scores = contribution(weights[:, None], counts[:, docs], self.lengths[docs][None, :]).sum(0)
            best.put(scores, self.none[docs], self.ids[docs])
            low, step = int(ends[done - 1]), 2 * step


def best_of_tasks(counted: DataFrame, keys: list[int], items: list[np.ndarray], weights: np.ndarray, n: int, words: int, top: int) -> DataFrame:
    """key, doc_id and score: for each item the best documents of every task."""
    sent = counted.sparkSession.sparkContext.broadcast((keys, items, weights))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, items, weights = sent.value
        best = [Best(top) for _ in keys]
        for batch in batches:
            sizes = batch.column(1).to_numpy()
            # Whole numbers of any size, as n * words may pass 64 bits.
            lengths = np.array([50 + 50 * size * n // max(words, 1) for size in sizes.tolist()], dtype=np.int64)
            order = np.argsort(lengths, kind="stable")
            for low in range(0, len(order), BLOCK_DOCS):
                rows = pa.array(order[low : low + BLOCK_DOCS])
                ids, _, terms, counts = (column.take(rows) for column in batch.columns)
                block = Block(ids, lengths[order[low : low + BLOCK_DOCS]], terms, counts, len(weights))
                for item, found in zip(items, best, strict=True):
                    block.search(item, weights[item], found)
        for key, found in zip(keys, best, strict=True):
            if len(found.ids):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([key] * len(found.ids), pa.int64()),
                        pa.array(found.ids, pa.int64(), mask=found.none),
                        pa.array(found.scores, pa.int64()),
                    ],
                    names=["key", "doc_id", "score"],
                )

    held = counted.filter("size(terms) > 0")
    return held.mapInArrow(read, "key long, doc_id long, score long")


def first_rows(found: DataFrame, top: int) -> DataFrame:
    """The first `top` rows of each item with their rank, cut by slices of the tasks first."""
    best_first = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    sliced = found.withColumn("slice", F.spark_partition_id() % SLICES)
    rank = F.row_number().over(Window.partitionBy("key", "slice").orderBy(*best_first))
    sliced = sliced.withColumn("rank", rank).filter(F.col("rank") <= top).drop("rank", "slice")
    rank = F.row_number().over(Window.partitionBy("key").orderBy(*best_first))
    return sliced.withColumn("rank", rank).filter(F.col("rank") <= top)


def search(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """item_id, rank, doc_id, score: the `top` documents (doc_id, text) of the highest score for each item (item_id, text).

    Scores are above 0, equal ones by ascending doc_id (null last). A null or empty text has no terms: such an item gets
    no rows, such a document is not counted. Every row of `docs` is a document; rows of `items` repeated with id and
    text are one item. An empty table on either side gives no rows. Other columns are not looked at.
    """
    spark = docs.sparkSession
    ship_code(spark)
    keyed = items.select(F.xxhash64("item_id", "text").alias("key"), "item_id", "text").dropDuplicates(["key"])
    keyed = work_table(keyed, "search-items")
    terms = work_table(item_terms(keyed), "search-terms")
    total = terms.agg(F.sum(F.size("terms"))).first()[0] or 0
    blocks = max(1, math.ceil(total / QUERY_TERMS))
    out = None
    for block in range(blocks):
        rows = terms.filter(F.pmod("key", F.lit(blocks)) == block).orderBy("key").collect()
        own = [np.array(row.terms, dtype=np.int64).view(np.uint64) for row in rows]
        vocabulary = np.unique(np.concatenate(own)) if own else np.zeros(1, dtype=np.uint64)
        counted = work_table(term_counts(docs, vocabulary), "search-counts")
        n, words = counted.filter("n > 0").agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        held = holders(counted, len(vocabulary))
        weights = np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1))) for df in held.tolist()], dtype=np.int64)
        places = [np.searchsorted(vocabulary, x) for x in own]
        found = best_of_tasks(counted, [row.key for row in rows], places, weights, n, words, top)
        found = work_table(found, "search-best")
        out = found if out is None else out.union(found)
    ranked = first_rows(out, top).join(keyed.select("key", "item_id"), "key")
    return ranked.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def op11_search(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return search(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text"))


OP11_SQL = r"""
WITH doc_terms AS (
  SELECT doc_id, t, count(*)::BIGINT AS tf FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t
    FROM documents) GROUP BY 1, 2),
item_terms AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t
  FROM benchmark),
lengths AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM doc_terms GROUP BY 1),
totals AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS words FROM lengths),
measured AS (SELECT doc_id, 100 - 50 + (50 * n * docs) // words AS m FROM lengths, totals),
weights AS (
  SELECT t, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
  FROM doc_terms, totals GROUP BY t, docs),
scored AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
  FROM item_terms JOIN doc_terms USING (t) JOIN weights USING (t) JOIN measured USING (doc_id) GROUP BY 1, 2),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank
  FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50
"""
