"""Near-duplicate documents by MinHash and odd sketches, confirmed on whole sets.

A document's set of word shingles gives MinHash samples. Some of them, taken in bands, name buckets in which near
documents meet. All of them are folded into an odd sketch, a bitmap of parities: every sample flips one bit, so samples that
two sets share cancel out in the XOR of their sketches, and its population count tells how many differ, most precisely
where few do. Pairs whose count is too high for the similarity asked for are dropped; the others are compared exactly.

Equal sets are one node. A bucket's nodes are compared with one of them; where several components still meet in a bucket,
sketches are compared in blocks of bounded size, and nodes that may be near one of another component then by their sets.
No pairs are written but links and those with a bucket's first node.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perigee.llm.code import ship_code
from perigee.llm.components import connected_components
from perigee.llm.filters import contains, signed, unsigned, value_filter
from perigee.llm.jaccard import set_name, text_sets
from perigee.llm.words import combine, mix
from perigee.session import work_table

SHINGLE = 5
#: Near if 100 * intersection >= PERCENT * union.
PERCENT = 80
#: Sets of similarity s have a band in common with a chance of 1 - (1 - s**ROWS)**BANDS: 0.999997 at 0.8.
BANDS, ROWS = 24, 4
#: Samples of an odd sketch; the first BANDS * ROWS are those of the bands.
SAMPLES = 192
SKETCH_BITS = 512
#: A pair is dropped if its sketches differ by more than sets do that are less similar by this much. At 0.8 that is five
#: standard deviations of the count.
SLACK = 0.2
#: Shingles that are hashed at a time, nodes of a block of sketches, nodes and elements of a block of sets.
STEP = 1 << 12
SKETCH_BLOCK = 1 << 13
BLOCK_SETS, BLOCK_ELEMENTS = 512, 1 << 19
#: Largest filter of the documents whose sets are read again.
MOST_FILTER_BITS = 1 << 28

FACTORS = mix(np.arange(1, SAMPLES + 1, dtype=np.uint64)) | np.uint64(1)


def samples(elements: np.ndarray) -> np.ndarray:
    """MinHash samples of a set that is not empty: the least of its elements in `SAMPLES` orders."""
    out = np.full(SAMPLES, np.iinfo(np.uint64).max, dtype=np.uint64)
    for low in range(0, len(elements), STEP):
        np.minimum(out, np.multiply.outer(FACTORS, elements[low : low + STEP]).min(1), out=out)
    return out


def band_names(sampled: np.ndarray) -> np.ndarray:
    """Names of the buckets of each row of samples, `BANDS` a row."""
    parts = sampled[:, : BANDS * ROWS].reshape(-1, ROWS)
    numbers = np.tile(np.arange(BANDS, dtype=np.uint64), len(sampled))
    return combine(*parts.T, numbers).reshape(-1, BANDS)


def odd_sketches(sampled: np.ndarray) -> np.ndarray:
    """The odd sketch of each row of samples, as 64-bit words."""
    numbers = np.arange(SAMPLES, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    bits = (mix(sampled + numbers) % np.uint64(SKETCH_BITS)).astype(np.int64)
    flips = np.bincount((bits + np.arange(len(sampled))[:, None] * SKETCH_BITS).ravel(), minlength=len(sampled) * SKETCH_BITS)
    return np.packbits((flips & 1).astype(np.uint8), bitorder="little").view(np.uint64).reshape(len(sampled), -1)


def estimated_similarity(odd_bits: float) -> float:
    """The similarity of two sets whose sketches differ in so many bits."""
    differing = np.log1p(-2 * odd_bits / SKETCH_BITS) / np.log1p(-2 / SKETCH_BITS)
    return 1 - differing / (2 * SAMPLES)


def most_odd_bits(percent: int) -> int:
    """More differing bits than these no pair of this similarity has, but for `SLACK`."""
    differing = 2 * SAMPLES * (1 - (percent / 100 - SLACK))
    return int(SKETCH_BITS * (1 - (1 - 2 / SKETCH_BITS) ** differing) / 2)


def signed_sets(docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """key, node, n, bands and sketch of every document (key, text): its set's name, size and signature.

    No words: no node. Sets that are near no other but equal ones, being too small, have no bands.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, sizes, rows = [], [], []
            for elements in text_sets(batch.column(1), shingle):
                sizes.append(len(elements))
                names.append(int(set_name(elements).view(np.int64)[0]) if len(elements) else None)
                rows.append(samples(elements) if len(elements) else np.zeros(SAMPLES, dtype=np.uint64))
            sampled = np.array(rows, dtype=np.uint64).reshape(-1, SAMPLES)
            size = np.array(sizes, dtype=np.int64)
            # Of two different sets that are near, the larger has an element more than the smaller at least.
            many = 100 * size >= percent * (size + 1)
            bands, sketch = band_names(sampled)[many], odd_sketches(sampled)
            band_ends, sketch_ends = np.cumsum([0, *(many * BANDS)]), np.arange(len(size) + 1) * sketch.shape[1]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(names, pa.int64()),
                    pa.array(size),
                    pa.ListArray.from_arrays(pa.array(band_ends, pa.int32()), signed(bands.ravel())),
                    pa.ListArray.from_arrays(pa.array(sketch_ends, pa.int32()), signed(sketch.ravel())),
                ],
                names=["key", "node", "n", "bands", "sketch"],
            )

    schema = "key long, node long, n long, bands array<long>, sketch array<long>"
    return docs.select("key", "text").mapInArrow(read, schema)


def bucket_members(nodes: DataFrame) -> DataFrame:
    """band, node, first: the nodes of buckets with several, and the smallest of each bucket."""
    rows = nodes.select("node", F.explode("bands").alias("band"))
    buckets = rows.groupBy("band").agg(F.min("node").alias("first"), F.max("node").alias("last")).filter("first != last")
    return rows.join(work_table(buckets.select("band", "first"), "odd-buckets"), "band")


def sets_of(docs: DataFrame, keys: DataFrame, shingle: int) -> DataFrame:
    """node and elements (sorted) of the documents (key, text) that `keys` names; others may be among them."""
    wanted = keys.count()
    held = value_filter(keys, min(max(1 << 20, 1 << (16 * wanted).bit_length()), MOST_FILTER_BITS))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = contains(held.value, unsigned(batch.column(0)))
            rows = {}
            for elements in text_sets(batch.column(1).filter(pa.array(ok)), shingle):
                if len(elements):
                    rows[int(set_name(elements).view(np.int64)[0])] = elements
            ends = np.cumsum([0, *map(len, rows.values())])
            flat = np.concatenate([*rows.values(), np.zeros(0, dtype=np.uint64)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows, pa.int64()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), signed(flat))],
                names=["node", "elements"],
            )

    found = docs.select("key", "text").mapInArrow(read, "node long, elements array<long>")
    return found.groupBy("node").agg(F.any_value("elements").alias("elements"))


def may_be_near(n_a: Column, n_b: Column, sketch_a: Column, sketch_b: Column, percent: int) -> Column:
    """Whether two sets may be near, by their sizes and the population count of the XOR of their sketches."""
    words = range(SKETCH_BITS // 64)
    odd = sum((F.bit_count(F.get(sketch_a, F.lit(i)).bitwiseXOR(F.get(sketch_b, F.lit(i)))) for i in words), F.lit(0))
    return (100 * F.least(n_a, n_b) >= percent * F.greatest(n_a, n_b)) & (odd <= most_odd_bits(percent))


def near_pairs(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs (a, b) that are near; `nodes` has node, n, sketch and elements."""

    def side(name: str, *columns: str) -> DataFrame:
        return nodes.select(F.col("node").alias(name), *(F.col(c).alias(f"{c}_{name}") for c in columns))

    sized = pairs.join(side("a", "n", "sketch"), "a").join(side("b", "n", "sketch"), "b")
    possible = sized.filter(may_be_near(*map(F.col, ("n_a", "n_b", "sketch_a", "sketch_b")), percent))
    full = possible.select("a", "b", "n_a", "n_b").join(side("a", "elements"), "a").join(side("b", "elements"), "b")
    shared = F.size(F.array_intersect("elements_a", "elements_b"))
    full = full.select("a", "b", "n_a", "n_b", shared.alias("shared"))
    return full.filter((100 + percent) * F.col("shared") >= percent * (F.col("n_a") + F.col("n_b"))).select("a", "b")


def tiles(members: DataFrame, blocks: Column) -> DataFrame:
    """`members` (band, node and others) once for each pair of their bucket's blocks (x, y) that theirs (block) is in."""
    counted = members.groupBy("band").agg(blocks.cast("int").alias("blocks"))
    placed = members.join(counted, "band").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return placed.withColumns({"x": F.least("block", "other"), "y": F.greatest("block", "other")}).drop("other", "blocks")


def _possible(rows, i: int, sketches: np.ndarray, percent: int) -> np.ndarray:
    """Rows after the i-th that may be near it and have another label; two rows of a block meet in its own tile only."""
    n, label, block = rows
    rest = slice(i + 1, None)
    ok = (label[rest] != label[i]) & (100 * np.minimum(n[rest], n[i]) >= percent * np.maximum(n[rest], n[i]))
    if block is not None:
        ok &= block[rest] != block[i]
    found = i + 1 + np.flatnonzero(ok)
    odd = np.bitwise_count(sketches[found] ^ sketches[i]).sum(1, dtype=np.int64)
    return found[odd <= most_odd_bits(percent)]


def _columns(frame) -> tuple:
    """n, label, block (None in a block's own tile) and sketches of a tile's rows."""
    own = frame["x"].iloc[0] == frame["y"].iloc[0]
    sketches = np.stack(frame["sketch"].to_list()).astype(np.int64).view(np.uint64)
    return (frame["n"].to_numpy(), frame["label"].to_numpy(), None if own else frame["block"].to_numpy()), sketches


def open_members(members: DataFrame, labels: DataFrame) -> DataFrame:
    """band, node, label of the buckets of more than two nodes in which several components meet."""
    labelled = members.join(labels, "node", "left").select("band", "node", F.coalesce("component", "node").alias("label"))
    ends = labelled.groupBy("band").agg(F.count("*").alias("size"), F.min("label").alias("low"), F.max("label").alias("high"))
    # The only pair of a bucket of two has been compared.
    return labelled.join(ends.filter("size > 2 AND low != high").select("band"), "band")


def open_links(members: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between the components that meet in the buckets of `members` (band, node, label)."""
    sketched = members.join(nodes.select("node", "n", "sketch"), "node")
    blocks = F.ceil(F.count("*") / F.lit(SKETCH_BLOCK))

    def meet(frame):
        rows, sketches = _columns(frame)
        used = np.zeros(len(frame), dtype=bool)
        for i in range(len(frame) - 1):
            others = _possible(rows, i, sketches, percent)
            used[others] = True
            used[i] |= len(others) > 0
        return frame.loc[used, ["band", "node", "label"]]

    schema = "band long, node long, label long"
    left = tiles(sketched, blocks).groupBy("band", "x", "y").applyInPandas(meet, schema).distinct()
    left = work_table(left, "odd-open")
    blocks = F.greatest(F.ceil(F.count("*") / F.lit(BLOCK_SETS)), F.ceil(F.sum("n") / F.lit(BLOCK_ELEMENTS)))
    dealt = tiles(left.join(nodes.select("node", "n"), "node"), blocks)

    def compare(frame):
        rows, sketches = _columns(frame)
        names, sets, root = frame["node"].to_numpy(), frame["elements"].to_list(), {}

        def find(label):
            while root.get(label, label) != label:
                label = root[label]
            return label

        links = []
        for i in range(len(frame) - 1):
            for j in _possible(rows, i, sketches, percent).tolist():
                x, y = find(int(rows[1][i])), find(int(rows[1][j]))
                if x != y:
                    shared = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                    if (100 + percent) * shared >= percent * int(rows[0][i] + rows[0][j]):
                        root[x] = y
                        links.append((int(names[i]), int(names[j])))
        return type(frame)(links, columns=["a", "b"], dtype="int64")

    full = dealt.join(nodes.select("node", "sketch", "elements"), "node")
    return full.groupBy("band", "x", "y").applyInPandas(compare, "a long, b long").distinct()


def near_components(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Sets of the documents (key, text) and how they are linked.

    Gives documents (key, node, n), one row per row of `docs`; the links found (a, b) between sets; and the component
    of every set that has one (node, component). Null and empty texts have no node. Equal sets are one node. A text
    is read a bounded number of shingles at a time. An empty table gives empty ones.
    """
    ship_code(docs.sparkSession)
    read = work_table(signed_sets(docs, shingle, percent), "odd-sets")
    some = F.any_value(F.struct("n", "bands", "sketch")).alias("s")
    nodes = read.filter("size(bands) > 0").groupBy("node").agg(some, F.min("key").alias("key"))
    nodes = work_table(nodes.select("node", "key", "s.*"), "odd-nodes")
    members = work_table(bucket_members(nodes), "odd-members")
    met = nodes.join(members.select("node").distinct(), "node", "left_semi")
    sets = sets_of(docs, met.select("key"), shingle)
    met = work_table(met.select("node", "n", "sketch").join(sets, "node"), "odd-candidates")
    pairs = members.filter("node != first").select(F.col("first").alias("a"), F.col("node").alias("b")).distinct()
    links = work_table(near_pairs(pairs, met, percent), "odd-links")
    labels = work_table(connected_components(links), "odd-labels")
    still_open = work_table(open_members(members, labels), "odd-open")
    more = work_table(open_links(still_open, met, percent), "odd-more")
    stars = labels.select(F.col("node").alias("a"), F.col("component").alias("b"))
    labels = work_table(connected_components(stars.union(more)), "odd-labels")
    return read.select("key", "node", "n"), links.union(more), labels


def with_components(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row of `docs` (doc_id, text; other columns are not looked at).

    component_id is the smallest id of the documents reachable by links, and of documents with the same set; null only
    where all of them have none. Documents without words are linked with nothing. kept: the row has its component's id.
    """
    keyed = docs.select(F.xxhash64("doc_id", "text").alias("key"), "doc_id", "text")
    read, _, labels = near_components(keyed, shingle, percent)
    # Rows repeated with id and text have one key and one set.
    ids = keyed.select("key", "doc_id").distinct()
    firsts = read.filter("node IS NOT NULL").select("key", "node").distinct().join(ids, "key")
    firsts = firsts.groupBy("node").agg(F.min("doc_id").alias("doc_id"))
    firsts = firsts.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = firsts.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named = firsts.join(least, "component").select("node", "component_id")
    ids = ids.withColumnRenamed("key", "id_key")
    rows = read.join(ids, read["key"] == ids["id_key"]).select("doc_id", "node", "n")
    worded = rows.filter("node IS NOT NULL").join(named, "node").select("doc_id", "n", "component_id")
    wordless = rows.filter("node IS NULL").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    kept = F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")
    return worded.union(wordless).select("doc_id", F.col("n").alias("n_shingles"), "component_id", kept)


def op12_odd_sketches(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return with_components(docs, shingle=4, percent=80)


OP12_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, CASE WHEN text IS NULL THEN [] ELSE regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') END AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, list_slice(w, i, i + least(4, len(w)) - 1) AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - least(4, len(w)) + 2)) AS i FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*)::BIGINT AS n FROM shingles GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*)::BIGINT AS shared
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * shared >= 80 * (x.n + y.n - shared)),
reached AS (
  SELECT doc_id AS d, doc_id AS r FROM documents
  UNION SELECT d, b FROM reached JOIN links ON a = r)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d LEFT JOIN sizes USING (doc_id)
JOIN (SELECT d AS doc_id, min(r) AS component_id FROM reached GROUP BY d) c USING (doc_id)
"""
