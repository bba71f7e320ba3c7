"""Words of texts by classes of bytes, as flat arrays, and bounded filters of 64-bit keys.

All separators of the splitters here are ASCII, so a byte of 0x80 or more is always part of
a word and texts can be split without decoding them.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.words import mix

_U = np.uint64
_MULTIPLY = 0x9E3779B97F4A7C15
LEAST_BITS, MOST_BITS = 16, 27


def lower_az() -> np.ndarray:
    """Maps each byte, A-Z to a-z."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


def classes(members: str) -> np.ndarray:
    """Whether each byte is one of these ASCII characters."""
    table = np.zeros(256, bool)
    table[[ord(c) for c in members]] = True
    return table


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and the n + 1 bounds of the texts; a null text is empty."""
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or not len(column):
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]], bounds - bounds[0]


def spans(inside: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of ``inside``; no run goes over a bound."""
    if not len(inside):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    edge = np.zeros(len(inside) + 1, bool)
    edge[bounds] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | edge[1:-1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def strings(data: np.ndarray, inside: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The runs of ``inside`` as an Arrow array of texts."""
    offsets = np.append(0, np.cumsum(ends - starts)).astype(np.int64)
    kept = np.ascontiguousarray(data[inside])
    return pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(kept))


def hashes(words: pa.Array) -> np.ndarray:
    """A 64-bit hash of each word, the same in every process."""
    if not len(words):
        return np.empty(0, _U)
    return pd.util.hash_array(words.to_numpy(zero_copy_only=False).astype(object), categorize=False)


def shingles(of_words: np.ndarray, owner: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the ``size`` words from each word on, and the words where one owner has them all."""
    n = len(of_words) - size + 1
    if n <= 0:
        return np.empty(0, _U), np.empty(0, np.int64)
    out = np.full(n, size, _U)
    for k in range(size):
        out *= _U(_MULTIPLY)
        out += of_words[k : k + n]
    at = np.flatnonzero(owner[:n] == owner[size - 1 :])
    return mix(out[at]), at


@dataclass
class Filter:
    """A bitmap of 64-bit keys by their leading bits: no key is missed, others may pass.

    Its size has a fixed bound, 2**MOST_BITS bits, whatever the number of keys.
    """

    words: np.ndarray
    bits: int

    def has(self, keys: np.ndarray) -> np.ndarray:
        slot = keys.view(_U) >> _U(64 - self.bits)
        return (self.words[(slot >> _U(6)).astype(np.int64)] >> (slot & _U(63)) & _U(1)).astype(bool)


def filter_of(keys: DataFrame, column: str) -> Filter:
    """The filter of a long column, put together from partial bitmaps on the executors."""
    count = keys.agg(F.count(column)).first()[0]
    bits = min(max(int(64 * count).bit_length(), LEAST_BITS), MOST_BITS)
    slot = F.shiftrightunsigned(F.col(column), 64 - bits)
    found = (
        keys.filter(F.col(column).isNotNull())
        .select(F.shiftrightunsigned(slot, 6).alias("at"), slot.bitwiseAND(63).cast("int").alias("bit"))
        .groupBy("at")
        .agg(F.expr("bit_or(shiftleft(1L, bit))").alias("word"))
        .toArrow()
    )
    words = np.zeros(1 << bits - 6, np.int64)
    words[found["at"].to_numpy()] = found["word"].to_numpy()
    return Filter(words.view(_U), bits)
