"""Scoring texts with a bigram model held in a log-frequency Bloom filter.

Words are counted exactly, by block: a block's texts are kept as places in the block's own list of words, so what
is shuffled for counting and looking up is one row per word and block, not per word of text. Counts of
word pairs are quantised to powers of two and put into a Bloom filter, a pair once for each
level up to its own; a count is read back by probing level after level until one is missing. The filter holds all
pairs, from one occurrence on. It is cut into parts by hash. If it cannot pass a stated size, all parts are broadcast;
otherwise each block's pairs go to the tasks that fill the parts, are looked up there, and the levels found are sent back,
which gives the same counts. The probability
of a word mixes what the filter says of the pair with the word's own smoothed share; how much of each is left
open, and a text's probability is the mean over several answers, so texts made of known phrases gain by
the pairs and others lose next to nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from perigee.llm.code import ship_code
from perigee.llm.filters import signed
from perigee.llm.words import SPACES, combine, mix, separated_by, slices, text_bytes, word_hashes
from perigee.session import work_dir, work_table

#: Bytes of text of a block; a longer text is a block of its own.
BLOCK_BYTES = 1 << 23
#: Words that are scored at a time.
SLICE_WORDS = 1 << 17
#: Tokens of all blocks per part of the filter. A part's pairs are counted, put in and looked up by one task each.
PART_TOKENS = 1 << 20
#: There are no more parts than this; the rest of a pair's hash, 40 bits, tells it from others of its part.
MOST_PARTS = 1 << 24
#: A filter that cannot have more bytes than this is broadcast; it has an entry per training token at most.
BROADCAST_BYTES = 1 << 25
BITS_PER_ENTRY = 10
PROBES = 4
#: Shares of the pairs in a word's probability, each as likely as the others before a text is read.
PAIR_SHARES = (0.0, 0.1, 0.4, 0.8)
#: A context seen so often has half of that share.
HALF_SEEN = 4.0
END = np.uint64(0x5851F42D4C957F2D)


def _packed(places: np.ndarray) -> bytes:
    """Places byte by byte, all lowest bytes first: frequent words have small places, so the rest is mostly noughts."""
    return np.ascontiguousarray(places.astype("<i4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, dtype=np.uint8).reshape(4, -1).T).view("<i4").ravel()


def _packed_names(codes: np.ndarray) -> bytes:
    """The lower five bytes of each code, byte by byte."""
    return np.ascontiguousarray(codes.astype("<u8").view(np.uint8).reshape(-1, 8).T[:5]).tobytes()


def _unpacked_names(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, dtype=np.uint8).reshape(5, -1)
    whole = np.zeros((planes.shape[1], 8), dtype=np.uint8)
    whole[:, :5] = planes.T
    return whole.view("<u8").ravel()


def encode(docs: DataFrame) -> DataFrame:
    """Blocks of the texts (doc_id, train, text): ids, train flags, offsets, and each token's place in the block's list.

    The list has each token's hash and its count in training texts, most frequent first. The end of a text is a token.
    """
    kind = docs.schema["doc_id"].dataType

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, train = batch.column(2), pc.fill_null(batch.column(1), False).to_numpy(zero_copy_only=False)
            for first, last in slices(text_bytes(texts)[1], BLOCK_BYTES):
                words, own = word_hashes(texts.slice(first, last - first), separated_by(SPACES))
                ends = own[1:] + np.arange(1, last - first + 1)
                tokens = np.full(int(ends[-1]), END)
                inside = np.ones(len(tokens), dtype=bool)
                inside[ends - 1] = False
                tokens[inside] = words
                learnt = np.repeat(train[first:last], np.diff(ends, prepend=0))
                names, places, counts = np.unique(tokens, return_inverse=True, return_counts=True)
                order = np.argsort(-counts, kind="stable")
                rank = np.empty(len(order), dtype=np.int32)
                rank[order] = np.arange(len(order), dtype=np.int32)
                seen = np.bincount(places[learnt], minlength=len(names))[order]
                row = [
                    pa.array([uuid.uuid4().int >> 65], pa.int64()),
                    pa.ListArray.from_arrays(pa.array([0, last - first], pa.int32()), batch.column(0).slice(first, last - first)),
                    pa.array([train[first:last].tobytes()], pa.binary()),
                    pa.array([ends.astype(np.int64).tobytes()], pa.binary()),
                    pa.array([_packed(rank[places])], pa.binary()),
                    pa.array([names[order].tobytes()], pa.binary()),
                    pa.array([seen.astype(np.int64).tobytes()], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(row, names=["block", "ids", "train", "ends", "places", "names", "seen"])

    columns = "train binary, ends binary, places binary, names binary, seen binary"
    rows = docs.select("doc_id", "train", "text").mapInArrow(
        read, f"block long, ids array<{kind.simpleString()}>, {columns}"
    )
    path = work_dir(docs.sparkSession, "text-blocks")
    rows.write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(rows.schema).parquet(path)


def block_words(blocks: DataFrame) -> DataFrame:
    """block, place, token, n: the lists of the blocks as rows."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, names, seen in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                names, seen = np.frombuffer(names, dtype=np.uint64), np.frombuffer(seen, dtype=np.int64)
                for low in range(0, len(names), 1 << 16):
                    part = names[low : low + (1 << 16)]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(part), block), pa.int64()),
                            pa.array(np.arange(low, low + len(part)), pa.int32()),
                            signed(part),
                            pa.array(seen[low : low + len(part)], pa.int64()),
                        ],
                        names=["block", "place", "token", "n"],
                    )

    return blocks.select("block", "names", "seen").mapInArrow(read, "block long, place int, token long, n long")


def _contexts(tokens: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The token before each; the first of a text follows the end of another."""
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[np.concatenate([[0], ends[:-1]])] = END
    return before


def pair_codes(before: np.ndarray, tokens: np.ndarray, parts: int) -> np.ndarray:
    """A code of each pair: the part of the filter it belongs to, then 40 bits of its name there."""
    pairs = combine(before, tokens)
    return (pairs & np.uint64(parts - 1)) << np.uint64(40) | pairs >> np.uint64(24)


def _by_part(codes: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Part, first and last of sorted codes."""
    if not len(codes):
        return
    owners = codes >> np.uint64(40)
    starts = np.flatnonzero(np.concatenate([[True], owners[1:] != owners[:-1]]))
    yield from zip(owners[starts].tolist(), starts.tolist(), [*starts[1:].tolist(), len(codes)], strict=True)


def block_pairs(blocks: DataFrame, parts: int, training: bool) -> DataFrame:
    """block, part, names, counts: the different pairs of each block, a row per part, names ascending.

    Counts are of training texts; with `training`, pairs that occur in others only are left out.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, train, ends, places, names in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ends = np.frombuffer(ends, dtype=np.int64)
                tokens = np.frombuffer(names, dtype=np.uint64)[_unpacked(places)]
                codes = pair_codes(_contexts(tokens, ends), tokens, parts)
                del tokens
                learnt = np.repeat(np.frombuffer(train, dtype=bool), np.diff(ends, prepend=0))
                if training:
                    codes, counts = np.unique(codes[learnt], return_counts=True)
                else:
                    codes, own = np.unique(codes, return_inverse=True)
                    counts = np.bincount(own[learnt], minlength=len(codes))
                    del own
                cuts = list(_by_part(codes))
                columns = [
                    pa.array([block] * len(cuts), pa.int64()),
                    pa.array([part for part, _, _ in cuts], pa.int32()),
                    pa.array([_packed_names(codes[first:last]) for _, first, last in cuts], pa.binary()),
                    pa.array([_packed(counts[first:last]) for _, first, last in cuts], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["block", "part", "names", "counts"])

    rows = blocks.select("block", "train", "ends", "places", "names")
    return rows.mapInArrow(read, "block long, part int, names binary, counts binary")


def _probes(names: np.ndarray, level: np.ndarray | int, bits: np.ndarray | int) -> Iterator[np.ndarray]:
    """Bits, of so many, that stand for a name at a level."""
    h = mix(names + (np.asarray(level).astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
    step, low, bits = h >> np.uint64(32) | np.uint64(1), np.uint64(0xFFFFFFFF), np.asarray(bits).astype(np.uint64)
    for i in range(PROBES):
        yield (((h + np.uint64(i) * step & low) * bits) >> np.uint64(32)).astype(np.int64)


def fill_part(names: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The bytes of a part that holds names as often as `counts` says in all: each once for each level up to its own."""
    names, places = np.unique(names[counts > 0], return_inverse=True)
    counts = counts[counts > 0]
    levels = np.floor(np.log2(np.bincount(places, counts)) + 1e-9).astype(np.int64)
    size = int((levels + 1).sum()) * BITS_PER_ENTRY // 8 + 8
    bits = np.zeros(size * 8, dtype=np.uint8)
    for level in range(int(levels.max(initial=-1)) + 1):
        for at in _probes(names[levels >= level], level, size * 8):
            bits[at] = 1
    return np.packbits(bits, bitorder="little")


@dataclass(frozen=True)
class LogFrequencyFilter:
    """Counts of pairs, rounded down to powers of two: part i lies in bytes starts[i] to starts[i + 1]."""

    data: np.ndarray
    starts: np.ndarray

    def levels(self, codes: np.ndarray) -> np.ndarray:
        """How many levels the filter holds of each pair, 0 if none: they are probed in turn until one is missing."""
        owner, names = (codes >> np.uint64(40)).astype(np.int64), codes & np.uint64((1 << 40) - 1)
        base, bits = self.starts[owner], np.diff(self.starts)[owner] * 8
        found = np.zeros(len(codes), dtype=np.uint8)
        left = np.flatnonzero(bits)
        for level in range(64):
            ok = np.ones(len(left), dtype=bool)
            for at in _probes(names[left], level, bits[left]):
                ok &= (self.data[base[left] + (at >> 3)] >> (at & 7)) & 1 == 1
            left = left[ok]
            if not len(left):
                break
            found[left] += 1
        return found

    def counts(self, codes: np.ndarray) -> np.ndarray:
        return level_counts(self.levels(codes))


def level_counts(levels: np.ndarray) -> np.ndarray:
    """The least count with so many levels."""
    return np.where(levels > 0, 2.0 ** (levels.astype(float) - 1), 0.0)


def build_parts(blocks: DataFrame, parts: int) -> DataFrame:
    """part, bits: the parts of the filter of all pairs of training texts. Parts without pairs have no row."""

    def fill(table: pa.Table) -> pa.Table:
        rows = [(_unpacked_names(x), _unpacked(y)) for x, y in zip(*(table.column(c).to_pylist() for c in ("names", "counts")))]
        bits = fill_part(*(np.concatenate(x) for x in zip(*rows, strict=True)))
        return pa.table({"part": table.column("part").slice(0, 1), "bits": pa.array([bits.tobytes()], pa.binary())})

    pairs = block_pairs(blocks, parts, training=True).select("part", "names", "counts")
    return pairs.groupBy("part").applyInArrow(fill, "part int, bits binary")


def gather_parts(filled: DataFrame, parts: int) -> LogFrequencyFilter:
    """The whole filter, for one that is known to be small."""
    held = {row.part: row.bits for row in filled.collect()}
    sizes = [len(held.get(part, b"")) for part in range(parts)]
    data = np.frombuffer(b"".join(held[part] for part in sorted(held)), dtype=np.uint8)
    return LogFrequencyFilter(data, np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64))


def probe_parts(blocks: DataFrame, parts: int) -> DataFrame:
    """block, part, levels: how many levels each of the different pairs of a block has, in the order of their codes.

    The task that fills a part looks up the pairs of all blocks that fall into it.
    """

    def probe(table: pa.Table) -> pa.Table:
        names = [_unpacked_names(x) for x in table.column("names").to_pylist()]
        counts = [_unpacked(x) for x in table.column("counts").to_pylist()]
        data = fill_part(np.concatenate(names), np.concatenate(counts))
        held = LogFrequencyFilter(data, np.array([0, len(data)]))
        found = [held.levels(x).tobytes() for x in names]
        return pa.table(
            [table.column("block"), table.column("part"), pa.array(found, pa.binary())], names=["block", "part", "levels"]
        )

    pairs = block_pairs(blocks, parts, training=False)
    return pairs.groupBy("part").applyInArrow(probe, "block long, part int, levels binary")


def score_texts(docs: DataFrame, train: Column, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Scores of all texts (doc_id, text) under a model learnt from the rows for which `train` holds.

    Per row doc_id, train, n_tokens, n_known, train_tokens, base_score (words by their own smoothed shares) and
    score (the model's), both log10 probabilities. A null text is an empty one; an empty text is its end alone.
    Rows with equal texts get equal scores. If there is nothing to learn from, every share is 1. A text longer than a
    block is one of its own, read whole by one task. `broadcast_bytes` changes how pairs are looked up, not what is found.
    """
    spark = docs.sparkSession
    ship_code(spark)
    blocks = encode(docs.select("doc_id", train.alias("train"), "text"))
    # One shuffle counts a token and tells its blocks; a token has one row per block, however often it is used.
    token = Window.partitionBy("token")
    counted = block_words(blocks).select(
        "block",
        "place",
        F.sum("n").over(token).alias("c"),
        "n",
        (F.row_number().over(token.orderBy("block", "place")) == 1).alias("type"),
    )
    counted = work_table(counted.filter("c > 0"), "token-counts")
    tokens, types = counted.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count_if("type")).first()
    parts = 1
    while parts * PART_TOKENS < tokens and parts < MOST_PARTS:
        parts *= 2
    total = float(tokens + types + 1)
    looked_up = counted.select("block", "place", "c")
    held = None
    # A pair seen n times has no more than n levels, so there are no more entries than tokens.
    if tokens * BITS_PER_ENTRY // 8 + 8 * parts <= broadcast_bytes:
        held = spark.sparkContext.broadcast(gather_parts(build_parts(blocks, parts), parts))
    else:
        levels = probe_parts(blocks, parts).withColumnRenamed("part", "place")
        looked_up = looked_up.unionByName(levels, allowMissingColumns=True)
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = (
        f"doc_id {kind}, train boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    )

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return pa.table({name: [] for name in names}, schema=arrow_schema(left))
        row = {name: left.column(name)[0] for name in left.column_names}
        ends = np.frombuffer(row["ends"].as_buffer(), dtype=np.int64)
        places = _unpacked(row["places"].as_py())
        words = np.frombuffer(row["names"].as_buffer(), dtype=np.uint64)
        if held is None:
            sent = right.filter(pc.is_valid(right.column("levels"))).sort_by("place")
            right = right.filter(pc.is_null(right.column("levels")))
            tokens_here = words[places]
            _, pair = np.unique(
                pair_codes(_contexts(tokens_here, np.frombuffer(row["ends"].as_buffer(), dtype=np.int64)), tokens_here, parts),
                return_inverse=True,
            )
            levels = np.frombuffer(b"".join(sent.column("levels").to_pylist()), dtype=np.uint8)[pair]
            del tokens_here, pair, sent
        c = np.zeros(len(words), dtype=np.int64)
        c[right.column("place").to_numpy()] = right.column("c").to_numpy()
        log_share, known = np.log10((c + 1) / total), c > 0
        # The end before a text is always a word of the block's list, since every text has one.
        end = int(np.flatnonzero(words == END)[0])
        offsets = np.concatenate([[0], ends])
        sums = []
        for first, last in slices(offsets, SLICE_WORDS):
            here = places[offsets[first] : offsets[last]]
            starts = offsets[first:last] - offsets[first]
            before = np.empty_like(here)
            before[1:] = here[:-1]
            before[starts] = end
            context = c[before].astype(float)
            if held is None:
                found = level_counts(levels[offsets[first] : offsets[last]])
            else:
                found = held.value.counts(pair_codes(words[before], words[here], parts))
            weight = context / (context + HALF_SEEN)
            seen = np.minimum(found / np.maximum(context, 1), 1)
            own = (c[here] + 1) / total
            answers = np.stack(
                [np.add.reduceat(np.log10(own + s * weight * (seen - own)), starts) for s in PAIR_SHARES]
            )
            best = answers.max(0)
            sums.append(
                (
                    np.add.reduceat(known[here].astype(np.int64), starts),
                    np.add.reduceat(log_share[here], starts),
                    best + np.log10((10.0 ** (answers - best)).mean(0)),
                )
            )
        known_words, base, chance = (np.concatenate(x) for x in zip(*sums, strict=True))
        pa.default_memory_pool().release_unused()
        ids = row["ids"].values
        return pa.Table.from_arrays(
            [
                ids,
                pa.array(np.frombuffer(row["train"].as_buffer(), dtype=bool)),
                pa.array(np.diff(ends, prepend=0), pa.int64()),
                pa.array(known_words, pa.int64()),
                pa.array(np.full(len(ends), tokens), pa.int64()),
                pa.array(base),
                pa.array(chance),
            ],
            names=names,
        )

    names = [part.strip().split()[0] for part in schema.split(",")]

    def arrow_schema(left: pa.Table) -> pa.Schema:
        kinds = [pa.bool_(), *[pa.int64()] * 3, *[pa.float64()] * 2]
        ids = left.schema.field("ids").type.value_type
        return pa.schema(list(zip(names, [ids, *kinds], strict=True)))

    return blocks.drop("seen").groupBy("block").cogroup(looked_up.groupBy("block")).applyInArrow(score, schema)


def op4_score(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 2, F.lit(False))
    return score_texts(docs, ~held_out).select(
        "doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )
