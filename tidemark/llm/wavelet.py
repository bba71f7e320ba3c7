"""A wavelet matrix of token ids in one compressed file.

Plane by plane, from the highest bit, the ids are parted stably by that bit. A plane is cut
into blocks of 65,536 bits, each compressed by itself; a directory holds the ones before
each block, so that access, rank and select read only the blocks they touch.
"""

from __future__ import annotations

import json
import struct

import numpy as np
import zstandard

MAGIC = b"WAVE1\n"
BLOCK = 1 << 16
_POPCOUNT = np.array([bin(b).count("1") for b in range(256)], np.uint8)


def planes(ids: np.ndarray, bits: int) -> tuple[list[np.ndarray], list[int]]:
    """The packed bits of each plane, and its number of zeros."""
    out, zeros = [], []
    ids = ids.astype(np.uint16 if bits <= 16 else np.uint32)
    for level in range(bits - 1, -1, -1):
        bit = (ids >> ids.dtype.type(level) & ids.dtype.type(1)).astype(bool)
        out.append(np.packbits(bit, bitorder="little"))
        zeros.append(int(len(bit) - np.count_nonzero(bit)))
        if level:
            ids = np.concatenate([ids[~bit], ids[bit]])
    return out, zeros


def pack(ids: np.ndarray, keys: list[int | None], lengths: list[int]) -> bytes:
    """The file of one shard: documents with their keys and lengths, and all their ids."""
    compress = zstandard.ZstdCompressor(level=1).compress
    bits = max(1, int(ids.max()).bit_length()) if len(ids) else 1
    body, sizes, ones, zeros = [], [], [], []
    if len(ids):
        packed, zeros = planes(ids, bits)
        for plane in packed:
            before = 0
            for at in range(0, len(plane), BLOCK // 8):
                block = plane[at : at + BLOCK // 8]
                ones.append(before)
                before += int(_POPCOUNT[block].sum())
                body.append(compress(block.tobytes()))
                sizes.append(len(body[-1]))
    sections = {
        "lengths": np.array(lengths, "<i8").tobytes(),
        "keys": np.array([k or 0 for k in keys], "<i8").tobytes(),
        "null": np.array([k is None for k in keys], "u1").tobytes(),
        "ones": np.array(ones, "<i8").tobytes(),
        "sizes": np.array(sizes, "<i8").tobytes(),
    }
    sections = {k: compress(v) for k, v in sections.items()}
    head = json.dumps({"n": len(ids), "bits": bits, "zeros": zeros, "sections": {k: len(v) for k, v in sections.items()}}).encode()
    return b"".join([MAGIC, struct.pack("<I", len(head)), head, *sections.values(), *body])


class Shard:
    """Reads a shard from a random-access file; blocks are read when they are needed."""

    def __init__(self, file, most_blocks: int = 256):
        self.file, self.most = file, most_blocks
        start = file.read_at(len(MAGIC) + 4, 0)
        if start[: len(MAGIC)] != MAGIC:
            raise ValueError("not a token shard")
        (size,) = struct.unpack("<I", start[len(MAGIC) :])
        head = json.loads(file.read_at(size, len(start)))
        at = len(start) + size
        found = {}
        for name, n in head["sections"].items():
            found[name] = zstandard.ZstdDecompressor().decompress(file.read_at(n, at))
            at += n
        self.n, self.bits, self.zeros = head["n"], head["bits"], head["zeros"]
        self.lengths = np.frombuffer(found["lengths"], "<i8")
        null = np.frombuffer(found["null"], "u1")
        self.keys = [None if gone else int(k) for k, gone in zip(np.frombuffer(found["keys"], "<i8"), null)]
        self.per_plane = -(-self.n // BLOCK)
        self.ones = np.frombuffer(found["ones"], "<i8").reshape(-1, max(1, self.per_plane))
        sizes = np.frombuffer(found["sizes"], "<i8")
        self.offsets = at + np.append(0, np.cumsum(sizes))
        self.blocks: dict[int, np.ndarray] = {}

    def _block(self, plane: int, block: int) -> np.ndarray:
        k = plane * self.per_plane + block
        if k not in self.blocks:
            if len(self.blocks) >= self.most:
                self.blocks.clear()
            data = self.file.read_at(int(self.offsets[k + 1] - self.offsets[k]), int(self.offsets[k]))
            self.blocks[k] = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
        return self.blocks[k]

    def _bit(self, plane: int, i: int) -> int:
        inside = i % BLOCK
        return int(self._block(plane, i // BLOCK)[inside // 8] >> (inside % 8) & 1)

    def rank1(self, plane: int, i: int) -> int:
        """Ones before place i of a plane."""
        if i >= self.n:
            return self.n - self.zeros[plane]
        inside = i % BLOCK
        block = self._block(plane, i // BLOCK)
        n = int(self.ones[plane, i // BLOCK]) + int(_POPCOUNT[block[: inside // 8]].sum())
        return n + int(_POPCOUNT[block[inside // 8] & ((1 << inside % 8) - 1)]) if inside % 8 else n

    def select(self, plane: int, bit: int, k: int) -> int:
        """The place of the k-th (from 0) one or zero of a plane."""
        ones = self.ones[plane]
        before = ones if bit else np.arange(len(ones)) * BLOCK - ones
        block = int(np.searchsorted(before, k, side="right")) - 1
        bits = np.unpackbits(self._block(plane, block), bitorder="little")[: min(BLOCK, self.n - block * BLOCK)]
        return block * BLOCK + int(np.flatnonzero(bits == bit)[k - int(before[block])])

    def access(self, i: int) -> int:
        """The id at place i."""
        value = 0
        for plane in range(self.bits):
            bit, ones = self._bit(plane, i), self.rank1(plane, i)
            value = value << 1 | bit
            i = self.zeros[plane] + ones if bit else i - ones
        return value

    def _range(self, token: int, lo: int, hi: int) -> tuple[int, int]:
        if token >> self.bits or not self.n:
            return 0, 0
        for plane in range(self.bits):
            a, b = self.rank1(plane, lo), self.rank1(plane, hi)
            if token >> (self.bits - 1 - plane) & 1:
                lo, hi = self.zeros[plane] + a, self.zeros[plane] + b
            else:
                lo, hi = lo - a, hi - b
        return lo, hi

    def count(self, token: int, lo: int = 0, hi: int | None = None) -> int:
        """How often an id occurs in the places lo to hi."""
        a, b = self._range(token, lo, self.n if hi is None else hi)
        return b - a

    def locate(self, token: int, k: int) -> int:
        """The place of the k-th (from 0) occurrence of an id."""
        a, b = self._range(token, 0, self.n)
        if not 0 <= k < b - a:
            raise IndexError(k)
        i = a + k
        for plane in range(self.bits - 1, -1, -1):
            bit = token >> (self.bits - 1 - plane) & 1
            i = self.select(plane, bit, i - self.zeros[plane] if bit else i)
        return i

    def all(self) -> np.ndarray:
        """All ids in order: the planes are put back together from the lowest."""
        if not self.n:
            return np.empty(0, np.uint32)
        kind = np.uint16 if self.bits <= 16 else np.uint32
        ids = np.zeros(self.n, kind)
        for plane in range(self.bits - 1, -1, -1):
            a, b = (int(self.offsets[k * self.per_plane]) for k in (plane, plane + 1))
            data = self.file.read_at(b - a, a)
            cuts = self.offsets[plane * self.per_plane : (plane + 1) * self.per_plane + 1] - a
            unpack = zstandard.ZstdDecompressor().decompress
            raw = b"".join(unpack(data[x:y]) for x, y in zip(cuts[:-1].tolist(), cuts[1:].tolist()))
            bit = np.unpackbits(np.frombuffer(raw, np.uint8), count=self.n, bitorder="little").astype(bool)
            whole = np.empty(self.n, kind)
            whole[~bit] = ids[: self.zeros[plane]]
            whole[bit] = ids[self.zeros[plane] :]
            ids = whole | (bit.astype(kind) << kind(self.bits - 1 - plane))
        return ids.astype(np.uint32)
