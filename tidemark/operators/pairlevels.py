"""Levels of all pairs of a group of records at once, worked out inside tasks in small tiles.

Scores with a form here have the same levels as their column form; linkage counts or picks
pairs by them without making a row of each pair.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Pairs of a tile: its matrices stay in the cache.
TILE = 1 << 17
WIDTH = 1 << 12
#: Groups of fewer rows share a tile.
SMALL = 64
#: Texts up to this many characters have a block form: one bit of a word for each.
LONGEST = 64
#: Bytes of the table of characters of a tile's columns.
TABLE = 1 << 22


def reached(score: float, levels: Sequence[float]) -> int:
    """Scores come from divisions: a score just under a level by rounding reaches it."""
    return sum(score >= x - 1e-9 for x in levels)


def _codes(values: pa.Array) -> np.ndarray:
    """Equal values have equal numbers; null is -1."""
    indices = values.dictionary_encode().indices
    return indices.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int32)


class Equal:
    """Levels by 1 for equal values and 0 for others."""

    width = WIDTH

    def __init__(self, levels: tuple[float, ...], values: pa.Array):
        self.codes = _codes(values)
        self.nulls = bool((self.codes < 0).any())
        self.low, self.high = reached(0.0, levels) + 1, reached(1.0, levels) + 1

    def tile(self, rows: slice, cols: slice) -> np.ndarray:
        a, b = self.codes[rows, None], self.codes[None, cols]
        out = (a == b).view(np.uint8) * np.uint8(self.high - self.low) + np.uint8(self.low)
        if self.nulls:
            out[(a < 0) | (b < 0)] = 0
        return out


class Near:
    """Levels by 1 for equal numbers, 0 from ``far`` apart; a null number scores 0."""

    width = WIDTH

    def __init__(self, far: float, levels: tuple[float, ...], values: pa.Array):
        self.none = values.is_null().to_numpy(zero_copy_only=False)
        self.nulls = bool(self.none.any())
        self.numbers = values.fill_null(0).to_numpy(zero_copy_only=False)
        if self.numbers.dtype.kind == "i":
            self.numbers = self.numbers.astype(np.int64)
        self.limits = [farthest(far, x) for x in levels]
        self.least = reached(0.0, levels) + 1

    def tile(self, rows: slice, cols: slice) -> np.ndarray:
        with np.errstate(invalid="ignore"):
            apart = np.subtract(self.numbers[rows, None], self.numbers[None, cols])
        np.abs(apart, out=apart)
        out = np.ones(apart.shape, np.uint8)
        for limit in self.limits:
            # As in Spark, an unknown number (NaN) is above all others.
            out += (~(apart > limit)).view(np.uint8)
        if self.nulls:
            out[self.none[rows, None] | self.none[None, cols]] = self.least
        return out


def farthest(far: float, level: float) -> float:
    """The largest distance at which ``max(0, 1 - distance / far)`` reaches the level."""
    if reached(0.0, [level]):
        return math.inf
    if not reached(1.0, [level]):
        return -1.0
    low, high = np.float64(0.0).view(np.int64), np.float64(far).view(np.int64)
    while high - low > 1:  # doubles from 0 on are ordered as their bits
        middle = low + (high - low) // 2
        if reached(max(0.0, 1 - float(middle.view(np.float64)) / far), [level]):
            low = middle
        else:
            high = middle
    return float(low.view(np.float64))


class Edits:
    """Levels by 1 - edits / longer length, of texts of at most LONGEST characters.

    Edit distances of a tile grow by one character of all its rows at a time (bit-parallel:
    a word holds a column of differences of the distance matrix). What all texts of the
    group have in common at the start and at the end takes no part in a distance.
    """

    def __init__(self, levels: tuple[float, ...], values: pa.Array):
        texts = values.to_pylist()
        self.none = np.array([t is None for t in texts], bool)
        self.nulls = bool(self.none.any())
        texts = [t or "" for t in texts]
        self.full = np.array([len(t) for t in texts], np.uint8)
        self.whole = reached(1.0, levels) + 1
        # One above the most edits by which a level is reached, for each longer length.
        most = [[sum(1 - d / n >= x - 1e-9 for d in range(n + 1)) if n else reached(1.0, [x]) for n in range(LONGEST + 1)] for x in levels]
        self.limits = np.array(most, np.uint8).reshape(len(levels), LONGEST + 1)
        longest, shortest = int(self.full.max()), int(self.full.min())
        chars = np.array(texts, f"U{max(longest, 1)}").view(np.uint32).reshape(len(texts), -1)
        head = tail = 0
        while head < shortest and (chars[:, head] == chars[0, head]).all():
            head += 1
        every, last = np.arange(len(texts)), self.full.astype(np.int64) - 1
        while tail < shortest - head and ((end := chars[every, last - tail]) == end[0]).all():
            tail += 1
        self.sizes = self.full.astype(np.int64) - head - tail
        size = max(longest - head - tail, 1)
        inside = chars[:, head : head + size]
        found, codes = np.unique(inside, return_inverse=True)
        self.codes = codes.reshape(inside.shape)
        self.alphabet = max(len(found), 1)
        self.word = next(t for t in (np.uint8, np.uint16, np.uint32, np.uint64) if size <= 8 * t().itemsize)
        self.same_size = shortest == longest
        self.width = int(min(WIDTH, max(SMALL, TABLE // (self.alphabet * self.word().itemsize))))
        self.ready: tuple | None = None

    def _columns(self, cols: slice) -> tuple[np.ndarray, np.ndarray]:
        """Of the columns' texts: the places of each character, and the places in use."""
        if self.ready is None or self.ready[0] != cols.start:
            span = slice(cols.start, cols.start + self.width)
            codes, sizes, w = self.codes[span], self.sizes[span], self.word
            places, used = np.zeros((self.alphabet, len(codes)), w), np.zeros(len(codes), w)
            for k in range(int(sizes.max(initial=0))):
                some = np.flatnonzero(sizes > k)
                places[codes[some, k], some] |= w(1 << k)
                used[some] |= w(1 << k)
            self.ready = (cols.start, places, used)
        n = cols.stop - cols.start
        return self.ready[1][:, :n], self.ready[2][:n]

    def distances(self, rows: slice, cols: slice) -> np.ndarray:
        places, used = self._columns(cols)
        order = np.argsort(-self.sizes[rows], kind="stable")
        sizes, codes = self.sizes[rows][order], self.codes[rows][order]
        up = np.full((len(order), len(used)), ~self.word(0), self.word)
        down = np.zeros_like(up)
        for k in range(int(sizes.max(initial=0))):
            n = int(np.searchsorted(-sizes, -k))  # a text that has ended stays as it is
            pv, mv = up[:n], down[:n]
            eq = places[codes[:n, k]]
            xv = eq | mv
            xh = eq & pv
            xh += pv
            xh ^= pv
            xh |= eq
            ph = xh | pv
            np.invert(ph, out=ph)
            ph |= mv
            xh &= pv
            ph += ph
            ph |= self.word(1)
            xh += xh
            np.bitwise_or(xv, ph, out=pv)
            np.invert(pv, out=pv)
            pv |= xh
            np.bitwise_and(ph, xv, out=mv)
        up &= used
        down &= used
        out = np.bitwise_count(up)
        out += sizes.astype(np.uint8)[:, None]
        out -= np.bitwise_count(down)
        if (order[1:] < order[:-1]).any():
            back = np.empty_like(out)
            back[order] = out
            return back
        return out

    def tile(self, rows: slice, cols: slice) -> np.ndarray:
        edits = self.distances(rows, cols)
        out = np.ones(edits.shape, np.uint8)
        longer = int(self.full[0]) if self.same_size else np.maximum(self.full[rows, None], self.full[None, cols])
        for limits in self.limits:
            out += (edits < limits[longer]).view(np.uint8)
        if self.nulls:
            a, b = self.none[rows, None], self.none[None, cols]
            out[a | b] = 0
            # The longer of no text and an empty one has no character, as in the column form.
            empty_a, empty_b = (self.full[rows, None] == 0) & ~a, (self.full[None, cols] == 0) & ~b
            out[(a & empty_b) | (empty_a & b)] = self.whole
        return out


class Group:
    """Records that meet: all pairs of ``left`` and ``right`` rows, or of ``left`` within.

    A pattern's code is 1 and its levels + 1 in mixed radix, the first rule's highest; 0
    stands for pairs that do not count: of one ident, met under an earlier rule, or (where
    several groups are given) of two groups.
    """

    def __init__(self, rows: pa.Table, makers: Sequence[Callable], bases: Sequence[int], earlier: Sequence[str], split: int | None, groups: np.ndarray | None):
        column = lambda c: rows.column(c).combine_chunks()
        self.scores = [make(column(f"v{k}")) for k, make in enumerate(makers)]
        self.bases, self.split, self.groups, self.size = bases, split, groups, rows.num_rows
        self.idents = _codes(column("rep"))
        self.repeats = len(self.idents) > 0 and int(self.idents.max()) + 1 < len(self.idents)
        keys = [_codes(column(c)) for c in earlier]
        self.earlier = [k for k in keys if (k >= 0).any()]
        self.kind = np.uint8 if math.prod(bases) < 1 << 8 else np.uint16

    def tiles(self) -> Iterator[tuple[slice, slice, np.ndarray]]:
        """(rows, columns, codes of their pairs); each pair is in one tile."""
        ends = self.size if self.split is None else self.split
        width = min(s.width for s in self.scores)
        for left in range(0, ends, width):
            stop = min(left + width, ends)
            top = left if self.split is None else self.split
            while top < self.size:
                before = max(0, min(top, stop) - left) if self.split is None else stop - left
                # Within a group a row meets the columns before it, so a tile gets wider as it goes down.
                high = int((math.sqrt(before * before + 4 * TILE) - before) / 2) if before < stop - left else TILE // before
                rows = slice(top, min(top + max(1, high), self.size))
                cols = slice(left, min(stop, rows.stop) if self.split is None else stop)
                yield rows, cols, self._codes_of(rows, cols)
                top = rows.stop

    def _codes_of(self, rows: slice, cols: slice) -> np.ndarray:
        out = None
        for score, base in zip(self.scores, self.bases):
            level = score.tile(rows, cols)
            if out is None:
                out = level.astype(self.kind)
            else:
                out *= self.kind(base)
                out += level
        out += self.kind(1)
        for counts in self._counting(rows, cols):
            out *= counts.view(np.uint8)
        return out

    def _counting(self, rows: slice, cols: slice) -> Iterator[np.ndarray]:
        if self.split is None and cols.stop > rows.start:
            yield np.arange(rows.start, rows.stop)[:, None] > np.arange(cols.start, cols.stop)[None, :]
        if self.groups is not None:
            yield self.groups[rows, None] == self.groups[None, cols]
        if self.repeats:
            yield self.idents[rows, None] != self.idents[None, cols]
        for keys in self.earlier:
            yield (keys[rows, None] != keys[None, cols]) | (keys[rows, None] < 0)


def groups(batches: Iterator[pa.RecordBatch], keys: Sequence[str], make: Callable[[pa.Table, int | None, np.ndarray | None], Group]) -> Iterator[tuple[pa.Table, Group]]:
    """The groups of rows sorted by ``keys`` and ``second`` (whether a row is on the right
    side), with their rows; small ones several at a time."""
    for rows, starts in _whole(batches, keys):
        bounds = np.array([*starts, rows.num_rows])
        second = rows.column("second").to_numpy()
        rights = np.add.reduceat(second.astype(np.int64), starts).tolist()
        alone = (rows.column("i").to_numpy() == rows.column("j").to_numpy())[starts].tolist()
        small = [x and y <= SMALL for x, y in zip(alone, np.diff(bounds).tolist())]
        k = 0
        while k < len(starts):
            end = k + 1
            while small[k] and end < len(starts) and small[end] and bounds[end + 1] - bounds[k] <= 2 * SMALL:
                end += 1
            part = rows.slice(bounds[k], bounds[end] - bounds[k])
            if alone[k]:
                numbers = np.repeat(np.arange(end - k), np.diff(bounds[k : end + 1])) if end > k + 1 else None
                yield part, make(part, None, numbers)
            elif 0 < rights[k] < part.num_rows:
                yield part, make(part, part.num_rows - rights[k], None)
            k = end


def _whole(batches: Iterator[pa.RecordBatch], keys: Sequence[str]) -> Iterator[tuple[pa.Table, list[int]]]:
    """Tables of whole groups with the first row of each."""
    held: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        held = table if held is None else pa.concat_tables([held, table]).combine_chunks()
        starts = _starts(held, keys)
        if len(starts) > 1:
            yield held.slice(0, starts[-1]), starts[:-1]
            held = held.slice(starts[-1])
    if held is not None and held.num_rows:
        yield held, _starts(held, keys)


def _starts(rows: pa.Table, keys: Sequence[str]) -> list[int]:
    if not rows.num_rows:
        return []
    new = np.zeros(rows.num_rows - 1, bool)
    for key in keys:
        values = rows.column(key).combine_chunks()
        new |= pc.not_equal(values[1:], values[:-1]).to_numpy(zero_copy_only=False)
    return [0, *(np.flatnonzero(new) + 1).tolist()]
