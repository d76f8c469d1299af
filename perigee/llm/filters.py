"""Bloom filters of a fixed size over 64-bit values, put together by Spark, for use inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perigee.llm.code import ship_code
from perigee.llm.words import mix


def _probes(values: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    for salt in (1, 2):
        yield (mix(values + np.uint64(salt)) >> np.uint64(64 - bits.bit_length() + 1)).astype(np.int64)


def unsigned(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)


def signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.astype(np.uint64, copy=False).view(np.int64), pa.int64())


def value_filter(values: DataFrame, bits: int) -> Broadcast:
    """A filter of `bits` bits (a power of two) with the only column of `values`, longs.

    What is brought together and broadcast is the filter, whose size is given; a fuller filter lets more through.
    Its bytes hold bit i at bit i % 8 of byte i // 8.
    """
    spark = values.sparkSession
    ship_code(spark)

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = np.unique(np.concatenate(list(_probes(unsigned(batch.column(0)), bits))))
            owners = places >> 6
            starts = np.flatnonzero(np.diff(owners, prepend=-1))
            masks = np.uint64(1) << (places & 63).astype(np.uint64)
            words = np.bitwise_or.reduceat(masks, starts) if len(starts) else masks
            yield pa.RecordBatch.from_arrays([pa.array(owners[starts], pa.int64()), signed(words)], names=["word", "bits"])

    found = values.mapInArrow(put, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits"))
    # Joined into pieces of 64 KB, so that what the driver reads has few rows.
    piece = F.floor(F.col("word") / F.lit(1 << 13)).alias("piece")

    def join(rows):
        words = np.zeros(1 << 13, dtype=np.int64)
        words[rows["word"].to_numpy() & ((1 << 13) - 1)] = rows["bits"].to_numpy()
        return rows.head(1)[["piece"]].assign(words=[words.tobytes()])

    held = np.zeros(max(bits // 8, 1 << 16), dtype=np.uint8)
    for number, words in found.select(piece, "word", "bits").groupBy("piece").applyInPandas(
        join, "piece long, words binary"
    ).collect():
        held[number << 16 : (number + 1) << 16] = np.frombuffer(words, dtype=np.uint8)
    return spark.sparkContext.broadcast(held[: bits // 8])


def contains(held: np.ndarray, values: np.ndarray) -> np.ndarray:
    """For each value whether the filter may hold it; those put in are always found."""
    ok = np.ones(len(values), dtype=bool)
    for places in _probes(values, len(held) * 8):
        ok &= (held[places >> 3] >> (places & 7)) & 1 == 1
    return ok
