"""Words of many texts at once, as 64-bit hashes, for code that runs inside tasks.

A text's words are hashed from its UTF-8 bytes with numpy, a chunk of bytes at a time, so the
memory used does not follow the length of a text. Two different words get the same hash with
a chance of about 2**-64.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK = 1 << 20
BASE = 0x9E3779B97F4A7C15
MASK = (1 << 64) - 1

SPACES = bytes([0x20, *range(0x09, 0x0E)])


@cache
def separated_by(separators: bytes) -> np.ndarray:
    """Table over bytes: whether a byte belongs to a word."""
    table = np.ones(256, dtype=bool)
    table[list(separators)] = False
    return table


@cache
def _lower() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[ord("A") : ord("Z") + 1] += 32
    return table


@cache
def _byte_values() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))


@cache
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2**64."""
    forth = np.full(size, BASE, dtype=np.uint64)
    back = np.full(size, pow(BASE, -1, 1 << 64), dtype=np.uint64)
    forth[0] = back[0] = 1
    return np.multiply.accumulate(forth), np.multiply.accumulate(back)


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values, one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def combine(*columns: np.ndarray) -> np.ndarray:
    """One hash of several, in their order."""
    total = np.zeros(len(columns[0]), dtype=np.uint64)
    for column in columns:
        total = mix(total * np.uint64(BASE) + column)
    return total


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts in a row, and where each text starts (with one more for the end). Null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if not len(texts):
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    _, starts, values = texts.buffers()
    offsets = np.frombuffer(starts, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(values, dtype=np.uint8) if values else np.zeros(0, dtype=np.uint8)
    return data, offsets


def word_hashes(texts: pa.Array, word_byte: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of all texts, A-Z lower-cased, and the offset of each text's first word.

    A word is a longest run of bytes for which `word_byte` is true. Null texts have no words.
    """
    data, offsets = text_bytes(texts)
    hashes, counts = [], np.zeros(len(offsets) - 1, dtype=np.int64)
    low, end = int(offsets[0]), int(offsets[-1])
    while low < end:
        high = _cut(data, offsets, low, end, word_byte)
        found, owners = _chunk_hashes(data, offsets, low, high, word_byte)
        hashes.append(found)
        if len(owners):
            first = int(owners[0])
            part = np.bincount(owners - first)
            counts[first : first + len(part)] += part
        low = high
    words = np.concatenate(hashes) if hashes else np.zeros(0, dtype=np.uint64)
    return words, np.concatenate([[0], np.cumsum(counts)])


def _cut(data: np.ndarray, offsets: np.ndarray, low: int, end: int, word_byte: np.ndarray) -> int:
    """Where the chunk that starts at `low` ends: between two texts or, in a long one, between two words."""
    high = min(low + CHUNK, end)
    boundary = int(offsets[np.searchsorted(offsets, high, "right") - 1])
    if boundary > low:
        return boundary
    text_end = int(offsets[np.searchsorted(offsets, low, "right")])
    while high < text_end:
        gaps = np.flatnonzero(~word_byte[data[low:high]])
        if len(gaps):
            return low + int(gaps[-1]) + 1
        high = min(low + 2 * (high - low), text_end)
    return high


def _chunk_hashes(
    data: np.ndarray, offsets: np.ndarray, low: int, high: int, word_byte: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    part = _lower()[data[low:high]]
    inside = word_byte[part]
    starts, ends = inside.copy(), inside.copy()
    starts[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    between = np.unique(offsets[np.searchsorted(offsets, low, "right") : np.searchsorted(offsets, high, "left")]) - low
    starts[between] = inside[between]
    ends[between - 1] = inside[between - 1]
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    forth, back = _powers(1 << max(len(part), CHUNK).bit_length())
    sums = np.zeros(len(part) + 1, dtype=np.uint64)
    np.cumsum(_byte_values()[part] * forth[: len(part)], out=sums[1:])
    hashes = (sums[ends] - sums[starts]) * back[starts]
    owners = np.searchsorted(offsets, starts + low, "right") - 1
    return mix(hashes + (ends - starts).astype(np.uint64)), owners


def slices(offsets: np.ndarray, rows: int) -> list[tuple[int, int]]:
    """Ranges of texts with about `rows` words each, one text at least."""
    out, first = [], 0
    while first < len(offsets) - 1:
        last = int(np.searchsorted(offsets, offsets[first] + rows, "right")) - 1
        last = min(max(last, first + 1), len(offsets) - 1)
        out.append((first, last))
        first = last
    return out
