"""Documents that share nearly all their word shingles: an exact Jaccard join and its components.

Documents are dealt into bands of size; a tile is a band and what of the next can be near it. In a
tile, sets that are near differ in at most d elements, so if the elements are dealt into more
than d parts by hash, one part is equal in both. Equal parts are the tile's buckets. What meets in a
bucket is held against bounds first (sizes, then bit counts of hashed bitmaps, which bound the
overlap from above) and then against the sorted arrays of shingles themselves.

A bucket's members are first compared with one of them only. Components follow; where a bucket
still holds several, its members are compared with each other in blocks of bounded size, which
makes the result complete without ever writing all pairs of a group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perigee.llm.code import ship_code
from perigee.llm.components import connected_components
from perigee.llm.filters import contains, signed, unsigned, value_filter
from perigee.llm.words import SPACES, combine, mix, separated_by, slices, word_hashes
from perigee.session import work_table

SHINGLE = 3
#: Linked if 100 * intersection >= PERCENT * union.
PERCENT = 90
BAND = 1.5
BLOCK_WORDS = 1 << 18
#: Elements and sets of a block of a group. A task holds two blocks.
BLOCK_ELEMENTS = 1 << 19
BLOCK_SETS = 512
FILTER_BITS = 1 << 26


def _bands() -> np.ndarray:
    """Smallest size of each band."""
    sizes = [1]
    while sizes[-1] < 1 << 40:
        sizes.append(max(sizes[-1] + 1, int(sizes[-1] * BAND)))
    return np.array(sizes)


BANDS = _bands()


def text_sets(texts: pa.Array, shingle: int = SHINGLE) -> Iterator[np.ndarray]:
    """For each text its sorted distinct shingles as hashes; with fewer words, the whole sequence is one."""
    all_words, all_offsets = word_hashes(texts, separated_by(SPACES))
    for first, last in slices(all_offsets, BLOCK_WORDS):
        offsets = all_offsets[first : last + 1] - all_offsets[first]
        words = all_words[all_offsets[first] : all_offsets[last]]
        shingles = (
            combine(*(words[i : len(words) - shingle + 1 + i] for i in range(shingle)))
            if len(words) >= shingle
            else words[:0]
        )
        for low, high in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
            if high - low >= shingle:
                yield np.unique(shingles[low : high - shingle + 1])
            elif high > low:
                yield combine(*(words[i : i + 1] for i in range(low, high))) + np.uint64(high - low)
            else:
                yield words[:0]


def set_name(elements: np.ndarray) -> np.ndarray:
    return mix(np.array([mix(elements).sum() + np.uint64(len(elements))], dtype=np.uint64))


def _most_difference(smaller: int, percent: int) -> int:
    """Most elements in which a set of at most `smaller` elements and a near one can differ."""
    return smaller * (100 - percent) // percent


def bucket_keys(elements: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Names of the set's parts in the tiles it belongs to: near sets have one in common.

    Empty parts have no name. A set with more of them than the tile allows for is also dealt out in
    another way, and so on until it has few enough; of two near sets the one that got there first finds
    the other in that dealing.
    """
    size = len(elements)
    band = int(np.searchsorted(BANDS, size, "right")) - 1
    tiles = [band]
    below = int(BANDS[band]) - 1
    if size * percent <= below * 100:
        tiles.append(band - 1)
    out = []
    for tile in tiles:
        differ = _most_difference(int(BANDS[tile + 1]) - 1, percent)
        if not differ:
            continue  # only equal sets are near
        spare = differ // 32
        parts, dealing = differ + 1 + spare, 0
        while True:
            scrambled = mix(elements + np.uint64(tile * 1_000_003 + dealing * 7919 + 1))
            part = ((scrambled >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
            order = np.argsort(part, kind="stable")
            starts = np.flatnonzero(np.diff(part[order].astype(np.int64), prepend=-1))
            sums = np.add.reduceat(mix(scrambled)[order], starts)
            names = part[order][starts] + np.uint64((tile << 40) + (dealing << 32))
            out.append(mix(sums + mix(names)))
            if parts - len(starts) <= spare:
                break
            dealing += 1
    return np.concatenate(out) if out else np.zeros(0, dtype=np.uint64)


def bitmap(elements: np.ndarray) -> bytes:
    """Bits at the elements' hashes; about half as many again as there are elements, a power of two."""
    width = max(64, 1 << (2 * len(elements) - 1).bit_length())
    bits = np.zeros(width, dtype=np.uint8)
    bits[(elements & np.uint64(width - 1)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def _fold(bits: np.ndarray, size: int) -> np.ndarray:
    """A bitmap of fewer bytes over the same elements."""
    return np.bitwise_or.reduce(bits.reshape(-1, size), axis=0)


def overlap_bound(size_a: int, bits_a: bytes, size_b: int, bits_b: bytes) -> int:
    """Most elements that two sets can share: bits that only one has stand for an element each at least."""
    a, b = np.frombuffer(bits_a, dtype=np.uint8), np.frombuffer(bits_b, dtype=np.uint8)
    size = min(len(a), len(b))
    a, b = _fold(a, size), _fold(b, size)
    only_a, only_b = np.bitwise_count(a & ~b).sum(), np.bitwise_count(b & ~a).sum()
    return min(size_a - int(only_a), size_b - int(only_b))


def _near(shared, size_a, size_b, percent: int):
    return 100 * shared >= percent * (size_a + size_b - shared)


def document_sets(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """key, node, n and keys of every document (key, text): its set's name, size and buckets. No words: no node."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, sizes, keys = [], [], []
            for elements in text_sets(batch.column(1), shingle):
                names.append(int(set_name(elements).view(np.int64)[0]) if len(elements) else None)
                sizes.append(len(elements))
                keys.append(bucket_keys(elements, percent) if len(elements) else elements)
            ends = np.cumsum([0, *map(len, keys)])
            flat = np.concatenate(keys) if keys else np.zeros(0, dtype=np.uint64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(names, pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), signed(flat)),
                ],
                names=["key", "node", "n", "keys"],
            )

    return docs.select("key", "text").mapInArrow(read, "key long, node long, n long, keys array<long>")


def shared_members(sets: DataFrame) -> DataFrame:
    """key, node, first: the members of buckets with several different sets, and the smallest of each bucket.

    The first pass over the parts keeps two nodes per bucket and task; the members of the few
    buckets with different ones are then found by way of a filter of those buckets.
    """
    parts = sets.select("node", F.explode("keys").alias("key"))
    buckets = parts.groupBy("key").agg(F.min("node").alias("first"), F.max("node").alias("last")).filter("first != last")
    buckets = work_table(buckets.select("key", "first"), "near-buckets")
    held = value_filter(buckets.select("key"), FILTER_BITS)

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            keys = unsigned(lists.flatten())
            nodes = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), lists.value_lengths().to_numpy())
            ok = contains(held.value, keys)
            yield pa.RecordBatch.from_arrays(
                [signed(keys[ok]), pa.array(nodes[ok], pa.int64())], names=["key", "node"]
            )

    found = sets.filter("node IS NOT NULL").select("node", "keys").mapInArrow(pick, "key long, node long").distinct()
    return found.join(buckets, "key").select("key", "node", "first")


def candidate_sets(docs: DataFrame, nodes: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """node, n, bits and elements of the sets named, one row each, read from the texts again."""
    held = value_filter(nodes.select("node").distinct(), FILTER_BITS)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = {}
            for elements in text_sets(batch.column(0), shingle):
                if len(elements):
                    name = set_name(elements)
                    if contains(held.value, name)[0]:
                        rows[int(name.view(np.int64)[0])] = elements
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(rows, pa.int64()),
                    pa.array([len(x) for x in rows.values()], pa.int64()),
                    pa.array([bitmap(x) for x in rows.values()], pa.binary()),
                    pa.array([x.tobytes() for x in rows.values()], pa.binary()),
                ],
                names=["node", "n", "bits", "elements"],
            )

    found = docs.select("text").mapInArrow(read, "node long, n long, bits binary, elements binary")
    one = F.any_value(F.struct("n", "bits", "elements")).alias("s")
    return found.groupBy("node").agg(one).select("node", "s.*")


def near_pairs(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Those of the pairs (a, b) that are linked: bounds first, then the arrays of what is left."""

    def side(name: str, *columns: str) -> DataFrame:
        return sets.select(F.col("node").alias(name), *(F.col(c).alias(f"{c}_{name}") for c in columns))

    def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, *rest = (column.to_pylist() for column in batch.columns)
            ok = [_near(overlap_bound(n_a, x, n_b, y), n_a, n_b, percent) for n_a, x, n_b, y in zip(*rest, strict=True)]
            yield pa.RecordBatch.from_arrays([x.filter(pa.array(ok, pa.bool_())) for x in batch.columns[:2]], names=["a", "b"])

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = (np.frombuffer(v.as_buffer(), dtype=np.uint64) for v in (x, y))
                x, y = (x, y) if len(x) < len(y) else (y, x)
                places = np.minimum(np.searchsorted(y, x), len(y) - 1)
                ok.append(bool(_near(int((y[places] == x).sum()), len(x), len(y), percent)))
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(ok, pa.bool_())) for c in batch.columns[:2]], names=["a", "b"])

    sized = pairs.join(side("a", "n", "bits"), "a").join(side("b", "n", "bits"), "b")
    sized = sized.filter(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
    possible = sized.select("a", "b", "n_a", "bits_a", "n_b", "bits_b").mapInArrow(bound, "a long, b long")
    full = possible.join(side("a", "elements"), "a").join(side("b", "elements"), "b")
    return full.select("a", "b", "elements_a", "elements_b").mapInArrow(exact, "a long, b long")


def _block_links(rows, percent: int) -> list[tuple[int, int]]:
    """Links that join the components (label) among the sets of two blocks, as few as will do."""
    nodes, labels = rows["node"].to_numpy(), rows["label"].to_numpy()
    sizes = rows["n"].to_numpy()
    width = min(map(len, rows["bits"]))
    bits = np.stack([_fold(np.frombuffer(b, dtype=np.uint8), width) for b in rows["bits"]])
    possible = np.zeros((len(nodes), len(nodes)), dtype=bool)
    for i in range(len(nodes)):
        others = slice(i + 1, None)
        only_i = np.bitwise_count(bits[i] & ~bits[others]).sum(1, dtype=np.int64)
        only_j = np.bitwise_count(bits[others] & ~bits[i]).sum(1, dtype=np.int64)
        bound = np.minimum(sizes[i] - only_i, sizes[others] - only_j)
        possible[i, others] = _near(bound, sizes[i], sizes[others], percent) & (labels[others] != labels[i])
    used = np.flatnonzero(possible.any(0) | possible.any(1))
    if not len(used):
        return []
    possible, nodes, labels, sizes = possible[np.ix_(used, used)], nodes[used], labels[used], sizes[used]
    sets = [np.frombuffer(rows["elements"].iloc[i], dtype=np.uint64) for i in used]
    _, places, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    common = np.flatnonzero(counts > 1)
    column = np.full(len(counts), -1)
    column[common] = np.arange(len(common))
    owner, place = np.repeat(np.arange(len(sets)), list(map(len, sets))), column[places]
    owner, place = owner[place >= 0], place[place >= 0]
    order = np.argsort(place, kind="stable")
    owner, place = owner[order], place[order]
    shared = np.zeros((len(sets), len(sets)), dtype=np.float32)
    step = max(1, (1 << 24) // len(sets))
    for low in range(0, len(common), step):
        part = slice(*np.searchsorted(place, [low, low + step]))
        held = np.zeros((len(sets), min(step, len(common) - low)), dtype=np.float32)
        held[owner[part], place[part] - low] = 1
        shared += held @ held.T
    near = possible & _near(shared.astype(np.int64), sizes[:, None], sizes[None, :], percent)
    root = {label: label for label in labels.tolist()}

    def find(x):
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    links = []
    for i, j in np.argwhere(near).tolist():
        x, y = find(int(labels[i])), find(int(labels[j]))
        if x != y:
            root[x] = y
            links.append((int(nodes[i]), int(nodes[j])))
    return links


def open_links(members: DataFrame, labels: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Links (a, b) between the components that still meet in a bucket.

    Buckets of two have been settled by their only pair. Sets that meet in the others, one way or another,
    make a group, so that a set is compared once and not in each of its buckets. A group is cut into
    blocks of bounded numbers of sets and elements; every two blocks make a task's work, whatever the size of the group.
    """
    labelled = members.join(labels, "node", "left").withColumn("label", F.coalesce("component", "node"))
    buckets = labelled.groupBy("key").agg(
        F.count("*").alias("size"), F.min("label").alias("low"), F.max("label").alias("high")
    )
    still_open = labelled.join(buckets.filter("size > 2 AND low != high").select("key"), "key", "left_semi")
    meetings = still_open.filter("node != first").select(F.col("node").alias("a"), F.col("first").alias("b"))
    groups = connected_components(meetings).withColumnRenamed("component", "group")
    placed = (
        groups.join(labels, "node", "left")
        .join(sets.select("node", "n"), "node")
        .select("group", "node", "n", F.coalesce("component", "node").alias("label"))
    )
    placed = work_table(placed, "near-open")
    blocks = F.greatest(F.ceil(F.sum("n") / F.lit(BLOCK_ELEMENTS)), F.ceil(F.count("*") / F.lit(BLOCK_SETS)))
    blocks = placed.groupBy("group").agg(blocks.cast("int").alias("blocks"))
    placed = placed.drop("n").join(blocks, "group")
    placed = placed.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    tiles = placed.select("*", other).select(
        "group", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"), "node", "label"
    )
    full = tiles.join(sets, "node")

    def compare(rows):
        links = _block_links(rows, percent)
        return type(rows)({"a": [x for x, _ in links], "b": [y for _, y in links]}, dtype="int64")

    return full.groupBy("group", "x", "y").applyInPandas(compare, "a long, b long").distinct()


def document_key():
    """Rows with the same id and text are one document here, so repeated rows get equal results."""
    return F.xxhash64("doc_id", "text")


def near_groups(
    docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Sets of the documents (doc_id, text) and how they are linked: by `percent` of their shingles of `shingle` words.

    `percent` is 90 or more: below, a tile has so many parts that too many of them are empty. Very long texts are cut
    into shingles whole.

    Gives documents (key, node, n; see `document_key`), one row per row of `docs`; the links found (a, b) between
    sets; and the component of every set that has one (node, component). Null and empty texts have no node. Equal
    sets are one node. An empty table gives empty ones.
    """
    if not PERCENT <= percent <= 100:
        raise ValueError(f"percent must be from {PERCENT} to 100")
    ship_code(docs.sparkSession)
    keyed = docs.select(document_key().alias("key"), "text")
    sets = work_table(document_sets(keyed, shingle, percent), "near-sets")
    members = work_table(shared_members(sets), "near-members")
    pairs = members.filter("node != first").select(F.col("first").alias("a"), F.col("node").alias("b")).distinct()
    candidates = work_table(candidate_sets(keyed, members, shingle), "near-candidates")
    links = work_table(near_pairs(pairs, candidates, percent), "near-links")
    labels = work_table(connected_components(links), "near-labels")
    more = work_table(open_links(members, labels, candidates, percent), "near-more")
    stars = labels.select(F.col("node").alias("a"), F.col("component").alias("b"))
    labels = work_table(connected_components(stars.union(more)), "near-labels")
    return sets.select("key", "node", "n"), links.union(more), labels


def keep_one(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One document of each component, that with the smallest id (null ids last), with its columns as they are.

    Rows repeated with their id and text become one. Documents without words are linked with nothing and stay.
    """
    sets, _, labels = near_groups(docs, shingle, percent)
    ids = docs.select(document_key().alias("key"), "doc_id").distinct()
    grouped = (
        sets.distinct()
        .join(labels, "node", "left")
        .select("key", F.coalesce("component", "node").alias("component"))
        .join(ids, "key")
    )
    first = F.min_by("key", F.struct(F.col("doc_id").isNull(), "doc_id", "key"))
    kept = grouped.filter("component IS NOT NULL").groupBy("component").agg(first.alias("__key")).select("__key")
    alone = grouped.filter("component IS NULL").select(F.col("key").alias("__key")).distinct()
    keyed = docs.withColumn("__key", document_key())
    return keyed.join(kept.union(alone), "__key", "left_semi").dropDuplicates(["__key"]).drop("__key")


def op3_near_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    sets, _, labels = near_groups(docs)
    grouped = (
        docs.select("doc_id", document_key().alias("key"))
        .join(sets.distinct(), "key")
        .join(labels, "node", "left")
        .select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "node").alias("component"))
    )
    smallest = grouped.filter("component IS NOT NULL").groupBy("component").agg(F.min("doc_id").alias("smallest"))
    return grouped.join(smallest, "component", "left").select(
        "doc_id", "n_shingles", F.coalesce("smallest", "doc_id").alias("component_id")
    )


OP3_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, CASE WHEN text IS NULL THEN [] ELSE regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') END AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, list_slice(w, i, i + least(3, len(w)) - 1) AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - least(3, len(w)) + 2)) AS i FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*)::BIGINT AS n FROM shingles GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*)::BIGINT AS shared
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * shared >= 90 * (x.n + y.n - shared)),
reached AS (
  SELECT doc_id AS d, doc_id AS r FROM documents
  UNION SELECT d, b FROM reached JOIN links ON a = r)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, c.component_id
FROM documents d LEFT JOIN sizes USING (doc_id)
JOIN (SELECT d AS doc_id, min(r) AS component_id FROM reached GROUP BY d) c USING (doc_id)
"""
