"""Pairs of similar sets of two blocks, by the exact number of tokens that they share.

Worked out inside tasks. Frequent tokens are bits of words, whose shared bits are counted
for a tile of pairs at once; all others are counted along lists of their holders.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs

#: So many of the most frequent tokens are bits; their codes are the smallest.
BITS = 256
#: Rows and columns of a tile.
ROWS, COLUMNS = 16, 1 << 12
#: Links of a batch.
LINKS = 1 << 16


class Block:
    """Sets as rows (rep, size, codes): ``size`` counts all tokens, ``codes`` names those
    that at least two sets have. Rows are sorted by size."""

    def __init__(self, rows: pa.Table, bits: int = BITS):
        sizes = rows.column("size").to_numpy()
        order = np.argsort(sizes, kind="stable")
        rows = rows.take(pa.array(order)).combine_chunks()
        self.sizes = sizes[order].astype(np.int64)
        self.reps = rows.column("rep").combine_chunks() if rows.num_rows else pa.array([], rows.schema.field("rep").type)
        lists = rows.column("codes").combine_chunks()
        flat = lists.flatten().to_numpy(zero_copy_only=False)
        owner = np.repeat(np.arange(len(order)), np.diff(lists.offsets.to_numpy()))
        often = flat < bits
        words = np.zeros((math.ceil(bits / 64), len(order)), np.uint64)
        code = flat[often]
        np.bitwise_or.at(words, (code // 64, owner[often]), np.uint64(1) << (code % 64).astype(np.uint64))
        self.words = words
        self.often = np.bitwise_count(words).sum(axis=0, dtype=np.int64)
        #: Other tokens, row by row, and from each code to its holders.
        self.tokens, self.owners = flat[~often], owner[~often]
        self.heads = np.searchsorted(self.owners, np.arange(len(order) + 1))
        by_code = np.argsort(self.tokens, kind="stable")
        self.holders = self.owners[by_code]
        self.codes, starts = np.unique(self.tokens[by_code], return_index=True)
        self.starts = np.append(starts, len(by_code))

    def __len__(self) -> int:
        return len(self.sizes)


def needed(total: int, threshold: float) -> int:
    """No pair of sets with so many tokens in all reaches the threshold by sharing fewer."""
    return max(1, math.ceil(threshold / (1 + threshold) * total - 1e-6))


def similar(left: Block, right: Block, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(rows of left, rows of right, similarities) of the pairs that reach the threshold;
    of one block, each pair once."""
    if not len(left) or not len(right):
        return
    same = left is right
    place = np.searchsorted(right.codes, left.tokens)
    place = np.where(place < len(right.codes), place, 0)
    held = right.codes[place] == left.tokens if len(right.codes) else np.zeros(len(place), bool)
    starts = np.where(held, right.starts[place], 0)
    many = np.where(held, right.starts[place + 1] - starts, 0) if len(right.codes) else np.zeros(len(place), np.int64)
    both, count = np.empty(ROWS * COLUMNS, np.uint64), np.empty(ROWS * COLUMNS, np.uint8)
    for top in range(0, len(left), ROWS):
        end = min(top + ROWS, len(left))
        least, most = int(left.sizes[top]), int(left.sizes[end - 1])
        low = int(np.searchsorted(right.sizes, least * (threshold - 1e-9)))
        high = int(np.searchsorted(right.sizes, most / (threshold - 1e-9), side="right"))
        low = max(low, top + 1) if same else low
        if low >= high:
            continue
        small = min(most, int(right.sizes[high - 1])) < 1 << 8
        shared = np.zeros((end - top, high - low), np.uint8 if small else np.uint32)
        a, b = left.heads[top], left.heads[end]
        n = many[a:b]
        if n.any():
            at = np.arange(n.sum()) + np.repeat(starts[a:b] - (np.cumsum(n) - n), n)
            column, row = right.holders[at] - low, np.repeat((left.owners[a:b] - top) * (high - low), n)
            inside = (column >= 0) & (column < high - low)
            np.add.at(shared.ravel(), (row + column)[inside], shared.dtype.type(1))
        for first in range(low, high, COLUMNS):
            last = min(first + COLUMNS, high)
            tile = shared[:, first - low : last - low]
            need = needed(least + int(right.sizes[first]), threshold)
            # No pair shares more frequent tokens than its sets have.
            by_others = need - np.minimum(left.often[top:end], right.often[first:last].max())
            if by_others.min() > 0:
                i, j = np.divmod(np.flatnonzero(tile >= by_others[:, None].astype(tile.dtype)), last - first)
                some = tile[i, j].astype(np.int64)
                some += np.bitwise_count(left.words[:, top + i] & right.words[:, first + j]).sum(axis=0, dtype=np.int64)
                i, j, some = i[keep := some >= need], j[keep], some[keep]
            else:
                x, y = (buffer[: tile.size].reshape(tile.shape) for buffer in (both, count))
                for a, b in zip(left.words, right.words):
                    np.bitwise_and(a[top:end, None], b[None, first:last], out=x)
                    tile += np.bitwise_count(x, out=y)
                i, j = np.divmod(np.flatnonzero(tile >= need), last - first)
                some = tile[i, j].astype(np.int64)
            if not len(i):
                continue
            i, j = i + top, j + first
            similarity = some / (left.sizes[i] + right.sizes[j] - some)
            keep = similarity >= threshold
            if same:
                keep &= j > i
            if keep.any():
                yield i[keep], j[keep], similarity[keep]


def block_links(folder: str, blocks: int, threshold: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """From numbers of pairs of blocks to links (a, b, similarity); the blocks' rows are the
    Parquet files in block=0, block=1... of the folder. A block without rows has none."""
    last = blocks * (blocks + 1) // 2 - 1

    def load(k: int) -> Block:
        system, path = _filesystem(folder)
        if system.get_file_info(f"{path}/block={k}").type == fs.FileType.NotFound:
            return Block(pa.table({"rep": pa.array([], pa.int64()), "size": pa.array([], pa.int32()), "codes": pa.array([], pa.list_(pa.int64()))}))
        return Block(pq.read_table(f"{path}/block={k}", columns=["rep", "size", "codes"], filesystem=system, partitioning=None))

    def batch(parts: list[tuple]) -> pa.RecordBatch:
        a, b = (pa.concat_arrays([p[k] for p in parts]) for k in (0, 1))
        return pa.RecordBatch.from_arrays([a, b, pa.array(np.concatenate([p[2] for p in parts]))], names=["a", "b", "similarity"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[int, Block] | None = None
        for numbers in batches:
            for number in numbers.column(0).to_pylist():
                # Counted from the end, the pairs (i, j) with one i are 1, 2, 3...
                back = last - number
                d = (math.isqrt(8 * back + 1) - 1) // 2
                i, j = blocks - 1 - d, blocks - 1 - (back - d * (d + 1) // 2)
                if held is None or held[0] != i:
                    held = (i, load(i))
                left = held[1]
                right = left if i == j else load(j)
                parts, many = [], 0
                for rows, others, similarity in similar(left, right, threshold):
                    parts.append((left.reps.take(pa.array(rows)), right.reps.take(pa.array(others)), similarity))
                    many += len(similarity)
                    if many >= LINKS:
                        yield batch(parts)
                        parts, many = [], 0
                if parts:
                    yield batch(parts)

    return run


def _filesystem(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path and the path within it; a bare path is a mounted folder."""
    if uri.startswith("file:/"):
        return fs.LocalFileSystem(), re.sub(r"^file:/+", "/", uri)
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)
