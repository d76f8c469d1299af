"""Finding benchmark passages in documents by a prefix-filtered set join.

An item is cut into windows of words, a window into shingles. For a document to hold a window it
must hold all its shingles, so the rarest one, by its count in the documents, is enough to find
it: that is the prefix that is joined. Where a document has it, the window's place follows from
the shingle's place in the window; it must lie inside the document, and its words must be equal.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from perigee.llm.code import ship_code
from perigee.llm.filters import contains, signed, value_filter
from perigee.llm.words import combine, separated_by, slices, word_hashes
from perigee.session import work_table

WINDOW = 10
SHINGLE = 3
#: Bytes between words, after A-Z is lower-cased.
SEPARATORS = bytes([*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])
#: Bits of the filter that tells which shingles of the documents are worth sending. Its size is fixed, so it can
#: be broadcast whatever the size of the benchmark; a fuller filter lets more through, and the join sorts them out.
FILTER_BITS = 1 << 23
BLOCK_WORDS = 1 << 18


def _shingles(words: np.ndarray, size: int) -> np.ndarray:
    return combine(*(words[i : len(words) - size + 1 + i] for i in range(size)))


def _positions(words: np.ndarray, offsets: np.ndarray, sizes: tuple[int, ...], held: np.ndarray):
    """Shingles of the texts that pass the filter: token, its place among the words, its text's row."""
    tokens, places = [], []
    ends = np.repeat(offsets[1:], np.diff(offsets))
    for size in sizes:
        if len(words) >= size:
            token = _shingles(words, size)
            ok = np.flatnonzero(contains(held, token))
            ok = ok[ok + size <= ends[ok]]
            tokens.append(token[ok])
            places.append(ok)
    tokens = np.concatenate(tokens) if tokens else np.zeros(0, dtype=np.uint64)
    places = np.concatenate(places) if places else np.zeros(0, dtype=np.int64)
    return tokens, places, np.searchsorted(offsets, places, "right") - 1


def _blocks(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Words of the texts a block at a time: the block's first row, the words, each text's offset among them."""
    words, offsets = word_hashes(texts, separated_by(SEPARATORS))
    for first, last in slices(offsets, BLOCK_WORDS):
        own = offsets[first : last + 1]
        yield first, words[own[0] : own[-1]], own - own[0]


def item_windows(benchmark: DataFrame) -> DataFrame:
    """Windows of the items: item_id, window (a hash), words (hashes). An item of fewer words is one window."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, words, offsets in _blocks(batch.column(1)):
                rows, own, names = [], [], []
                for row in range(len(offsets) - 1):
                    text = words[offsets[row] : offsets[row + 1]]
                    size = min(len(text), WINDOW)
                    if size:
                        windows = np.lib.stride_tricks.sliding_window_view(text, size)
                        rows += [first + row] * len(windows)
                        own += list(windows)
                        names.append(combine(*windows.T) + np.uint64(size))
                if rows:
                    flat = pa.array(np.concatenate(own).view(np.int64), pa.int64())
                    ends = np.cumsum([0, *map(len, own)]).astype(np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0).take(pa.array(rows)),
                            signed(np.concatenate(names)),
                            pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat),
                        ],
                        names=["item_id", "window", "words"],
                    )

    kind = benchmark.schema["item_id"].dataType.simpleString()
    return benchmark.select("item_id", "text").mapInArrow(
        cut, f"item_id {kind}, window long, words array<long>"
    )


def window_shingles(windows: DataFrame) -> DataFrame:
    """Shingles of distinct windows: window, words, token, offset."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, tokens, offsets = [], [], []
            for row, words in enumerate(batch.column(1).to_pylist()):
                values = np.array(words, dtype=np.int64).view(np.uint64)
                own = _shingles(values, min(SHINGLE, len(values)))
                rows += [row] * len(own)
                tokens.append(own)
                offsets += range(len(own))
            if rows:
                taken = pa.array(rows)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(taken), batch.column(1).take(taken)]
                    + [signed(np.concatenate(tokens)), pa.array(offsets, pa.int32())],
                    names=["window", "words", "token", "offset"],
                )

    return windows.select("window", "words").mapInArrow(
        cut, "window long, words array<long>, token long, offset int"
    )


def count_tokens(docs: DataFrame, held: Broadcast, sizes: tuple[int, ...]) -> DataFrame:
    """How often each shingle that passes the filter stands in the documents: token, n."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, words, offsets in _blocks(batch.column(0)):
                tokens, counts = np.unique(_positions(words, offsets, sizes, held.value)[0], return_counts=True)
                if len(tokens):
                    yield pa.RecordBatch.from_arrays(
                        [signed(tokens), pa.array(counts, pa.int64())], names=["token", "n"]
                    )

    return docs.select("text").mapInArrow(count, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))


def prefix_positions(docs: DataFrame, held: Broadcast, sizes: tuple[int, ...]) -> DataFrame:
    """key, n_words and, for each shingle that passes the filter, token, place and the words around it.

    `docs` has key and text. Every text gives a row; the words around are as many as a window may reach.
    """
    before, after = WINDOW - min(sizes, default=1), WINDOW

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, words, offsets in _blocks(batch.column(1)):
                rows = len(offsets) - 1
                tokens, places, owner = _positions(words, offsets, sizes, held.value)
                order = np.argsort(owner, kind="stable")
                tokens, places, owner = tokens[order], places[order], owner[order]
                low = np.maximum(places - before, offsets[owner])
                high = np.minimum(places + after, offsets[owner + 1])
                length = high - low
                ends = np.cumsum(np.concatenate([[0], length]))
                around = words[np.arange(ends[-1]) - np.repeat(ends[:-1] - low, length)]
                hits = pa.StructArray.from_arrays(
                    [
                        signed(tokens),
                        pa.array(places - offsets[owner], pa.int64()),
                        pa.array(places - low, pa.int32()),
                        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), signed(around)),
                    ],
                    names=["token", "place", "lead", "around"],
                )
                upto = np.searchsorted(owner, np.arange(rows + 1))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, rows),
                        pa.array(np.diff(offsets), pa.int64()),
                        pa.ListArray.from_arrays(pa.array(upto, pa.int32()), hits),
                    ],
                    names=["key", "n_words", "hits"],
                )

    hit = "struct<token: long, place: long, lead: int, around: array<long>>"
    return docs.select("key", "text").mapInArrow(find, f"key long, n_words long, hits array<{hit}>")


def document_key():
    """Rows with the same id and text are one document here, so repeated rows get equal results."""
    return F.xxhash64("doc_id", "text")


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Where windows of the items stand in the documents (doc_id, text).

    Gives documents (key, n_words; see `document_key`), occurrences (key, start, length, window), one row each, and
    the windows' items (window, item_id). Null texts have no words; items without words have no windows, and an empty
    benchmark or document table gives no occurrences.
    """
    spark = docs.sparkSession
    ship_code(spark)
    items = work_table(item_windows(benchmark), "leak-windows")
    distinct = items.groupBy("window").agg(F.any_value("words").alias("words"))
    shingles = work_table(window_shingles(distinct), "leak-shingles")
    lengths = [row[0] for row in shingles.select(F.least(F.size("words"), F.lit(SHINGLE))).distinct().collect()]
    sizes = tuple(sorted(lengths))
    counts = count_tokens(docs, value_filter(shingles.select("token").distinct(), FILTER_BITS), sizes)
    rarest = F.min_by(
        F.struct("token", "offset", "words"), F.struct(F.coalesce(F.col("n"), F.lit(0)), F.col("token"), F.col("offset"))
    )
    prefixes = shingles.join(counts, "token", "left").groupBy("window").agg(rarest.alias("p")).select("window", "p.*")
    prefixes = work_table(prefixes, "leak-prefixes")
    keyed = docs.select(document_key().alias("key"), "text")
    scanned = work_table(
        prefix_positions(keyed, value_filter(prefixes.select("token").distinct(), FILTER_BITS), sizes), "leak-positions"
    )
    start, length = F.col("place") - F.col("offset"), F.size("words")
    first = F.col("lead") - F.col("offset")
    occurrences = (
        scanned.select("key", "n_words", F.inline("hits"))
        .join(prefixes, "token")
        .filter((start >= 0) & (start + length <= F.col("n_words")))
        .filter((first >= 0) & (F.slice("around", F.greatest(first, F.lit(0)) + 1, length) == F.col("words")))
        .select("key", start.alias("start"), length.cast("long").alias("length"), "window")
        .distinct()
    )
    return scanned.select("key", "n_words"), work_table(occurrences, "leak-hits"), items.select("window", "item_id")


def covered_words(occurrences: DataFrame) -> DataFrame:
    """n_hit per key: words inside any occurrence, each counted once."""
    order = Window.partitionBy("key").orderBy("start", "end")
    seen = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    spans = occurrences.select("key", "start", (F.col("start") + F.col("length")).alias("end")).distinct()
    new = F.greatest(F.col("end") - F.greatest(F.col("start"), F.coalesce("seen", F.lit(0))), F.lit(0))
    return spans.withColumn("seen", seen).groupBy("key").agg(F.sum(new).alias("n_hit"))


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents in which no window of an item stands, with their columns as they are."""
    _, occurrences, _ = find_leaks(docs, benchmark)
    return (
        docs.withColumn("__key", document_key())
        .join(occurrences.select(F.col("key").alias("__key")).distinct(), "__key", "left_anti")
        .drop("__key")
    )


def op8_decontaminate(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    _, occurrences, items = found = find_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    listed = (
        occurrences.select("key", "window")
        .distinct()
        .join(items.distinct(), "window")
        .select("key", F.col("item_id").cast("string").alias("item"))
        .groupBy("key")
        .agg(F.array_sort(F.collect_set("item")).alias("items"))
    )
    keyed = docs.select("doc_id", document_key().alias("key"))
    sizes = found[0].groupBy("key").agg(F.any_value("n_words").alias("n_words"))
    none = F.lit(0).cast("long")
    return (
        keyed.join(sizes, "key")
        .join(covered_words(occurrences), "key", "left")
        .join(listed, "key", "left")
        .select(
            "doc_id",
            "n_words",
            F.coalesce("n_hit", none).alias("n_hit"),
            F.coalesce(F.size("items").cast("long"), none).alias("n_items"),
            F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")), 256).alias("items_sha256"),
            (F.coalesce("n_hit", none) > 0).alias("contaminated"),
        )
    )


OP8_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
    CASE WHEN text IS NULL THEN [] ELSE regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') END AS words
  FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM benchmark),
w AS (
  SELECT DISTINCT item_id, size, list_slice(words, i, i + size - 1) AS w
  FROM (SELECT *, least(10, len(words)) AS size, unnest(range(1, len(words) - least(10, len(words)) + 2)) AS i
        FROM b WHERE len(words) > 0)),
sizes AS (SELECT DISTINCT size FROM w),
p AS (
  SELECT r, size, i, list_slice(words, i, i + size - 1) AS w
  FROM (SELECT r, size, words, unnest(range(1, len(words) - size + 2)) AS i
        FROM d, sizes WHERE len(words) >= size)),
hits AS (SELECT r, i, p.size, item_id FROM p JOIN w ON p.w = w.w AND p.size = w.size),
spans AS (
  SELECT r, i, i + size AS stop, max(i + size) OVER (PARTITION BY r ORDER BY i, size
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen
  FROM (SELECT DISTINCT r, i, size FROM hits)),
covered AS (SELECT r, sum(greatest(stop - greatest(i, coalesce(seen, 0)), 0))::BIGINT AS n_hit FROM spans GROUP BY r),
listed AS (
  SELECT r, count(*)::BIGINT AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT r, item_id::VARCHAR AS item FROM hits) GROUP BY r)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
  coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (r) LEFT JOIN listed USING (r)
"""
