"""Vectorised splitting of texts: code points, character classes, word bounds, distinct words.

Texts are handled in pieces of bounded size as flat arrays. A long text is cut only
before white space that follows another character, where no word of any splitter here
can be in progress, so pieces give the same words as the whole text.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa

SPACE, LETTER, DIGIT, OTHER, MARK = 0, 1, 2, 3, 4
PIECE = 500_000
CODES = 0x110000

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_CUT = re.compile(r"(?<=\S)[ \n]")
_powers: list[np.ndarray] = []


def pieces(texts: list[str], size: int = PIECE) -> Iterator[tuple[list[str], list[int]]]:
    """Lists of pieces of about ``size`` characters in all, with the text each is from."""
    parts: list[str] = []
    owner: list[int] = []
    total = 0
    for k, text in enumerate(texts):
        at, n = 0, len(text)
        while True:
            end = n
            if n - at > size:
                cut = _CUT.search(text, at + size)
                end = cut.start() if cut else n
            parts.append(text[at:end])
            owner.append(k)
            total += end - at
            at = end
            if total >= size:
                yield parts, owner
                parts, owner, total = [], [], 0
            if at >= n:
                break
    if parts:
        yield parts, owner


def codepoints(parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All code points in one array, and the n + 1 bounds of the parts."""
    data = "".join(parts).encode("utf-32-le", "surrogatepass")
    bounds = np.zeros(len(parts) + 1, np.int64)
    np.cumsum([len(p) for p in parts], out=bounds[1:])
    return np.frombuffer(data, np.uint32), bounds


@lru_cache(maxsize=1)
def unicode_classes() -> np.ndarray:
    """Class of each code point by Python's tables, with marks as a class of their own."""
    kind = {"L": LETTER, "M": MARK, "N": DIGIT}
    out = np.full(CODES, OTHER, np.uint8)
    for code in range(CODES):
        char = chr(code)
        out[code] = SPACE if char.isspace() else kind.get(unicodedata.category(char)[0], OTHER)
    return out


@lru_cache(maxsize=1)
def simple_lower() -> np.ndarray:
    """Lower case of each code point, where that is one code point."""
    out = np.arange(CODES, dtype=np.uint32)
    for code in range(CODES):
        low = chr(code).lower()
        if len(low) == 1:
            out[code] = ord(low)
    return out


def runs(kinds: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Whether a run of equal kinds, or a new part, begins at each position."""
    new = np.empty(len(kinds), bool)
    if len(kinds):
        new[0] = True
        np.not_equal(kinds[1:], kinds[:-1], out=new[1:])
        new[bounds[:-1][bounds[:-1] < len(kinds)]] = True
    return new


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        _powers.clear()
        size = max(n, PIECE + (PIECE >> 2))
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            table = np.full(size, base, _U)
            table[0] = 1
            _powers.append(np.cumprod(table, dtype=_U))
    return _powers[0], _powers[1]


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (shifts and odd multipliers), in place."""
    h ^= h >> _U(33)
    h *= _U(0xFF51AFD7ED558CCD)
    h ^= h >> _U(29)
    h *= _U(0xC4CEB9FE1A85EC53)
    h ^= h >> _U(32)
    return h


def word_hashes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit key of each word, from one prefix sum over all characters.

    To find words by; different words can share one, so words must still be compared.
    """
    power, inverse = _power_tables(len(codes) + 1)
    v = codes.astype(_U)
    v += _U(1)
    v *= _U(0xD6E8FEB86659FD93)
    v ^= v >> _U(32)
    v *= power[: len(v)]
    sums = np.zeros(len(v) + 1, _U)
    np.cumsum(v, out=sums[1:])
    h = (sums[ends] - sums[starts]) * inverse[starts]
    h += (ends - starts).astype(_U) * _U(0xA0761D6478BD642F)
    return mix(h)


def distinct_words(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """The place of each word among the distinct ones, and these as UTF-32 bytes.

    Words are compared character by character, so different words are never taken for one.
    """
    n = len(starts)
    offsets = np.zeros(n + 1, np.int64)
    if n and starts[0] == 0 and ends[-1] == len(codes) and np.array_equal(starts[1:], ends[:-1]):
        offsets[1:] = ends
    else:
        np.cumsum(ends - starts, out=offsets[1:])
        codes = gather(codes, starts, ends - starts)
    offsets *= 4
    words = pa.Array.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(codes))])
    coded = words.dictionary_encode()
    return coded.indices.to_numpy().astype(np.int64), coded.dictionary.to_pylist()


def word_keys(words: list[bytes]) -> np.ndarray:
    """A keyed 64-bit hash (SipHash) of each word, the same in every process."""
    return pd.util.hash_array(np.array(words, object), categorize=False) if words else np.empty(0, _U)


def shared_contractions(
    codes: np.ndarray, kinds: np.ndarray, starts: np.ndarray, ends: np.ndarray, alone: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Where 's 't 'm 'd 're 've 'll begin a word: the apostrophes and the letters they take.

    ``starts`` and ``ends`` bound runs of equal class, ``alone`` tells which run may begin
    a word of its own and is followed by a run of the same text.
    """
    n = len(codes)
    at = np.flatnonzero((codes[starts] == 39) & (ends - starts == 1) & alone)
    at = at[at + 1 < len(starts)]
    at = at[kinds[starts[at + 1]] == LETTER]
    p = starts[at]
    length = ends[at + 1] - starts[at + 1]
    first = codes[p + 1]
    second = np.where(length >= 2, codes[np.minimum(p + 2, n - 1)], 0)
    takes = np.where(np.isin(first, [115, 116, 109, 100]), 1, 0)
    pair = ((first == 114) & (second == 101)) | ((first == 118) & (second == 101)) | (
        (first == 108) & (second == 108)
    )
    takes = np.where(pair, 2, takes)
    chosen = takes > 0
    return p[chosen], np.stack([takes[chosen], length[chosen]])


def space_led_words(
    codes: np.ndarray, kinds: np.ndarray, bounds: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Words of the byte-level pattern: contractions, runs of letters, digits or other
    characters with one blank before them, and white space; every character is in a word.
    """
    n = len(codes)
    new = runs(kinds, bounds)
    starts = np.flatnonzero(new)
    ends = np.append(starts[1:], n)
    part_end = np.zeros(n + 1, bool)
    part_end[bounds] = True
    part_end[n] = True
    inner = ~part_end[ends]
    blank = np.flatnonzero((kinds[starts] == SPACE) & inner)
    last = ends[blank] - 1
    new[last] = True
    new[ends[blank][codes[last] == 32]] = False
    p, take = shared_contractions(codes, kinds, starts, ends, new[starts] & inner)
    _contract(new, p, take)
    starts = np.flatnonzero(new)
    return starts, np.append(starts[1:], n)


def bare_words(
    codes: np.ndarray, kinds: np.ndarray, bounds: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Words of the lower-case pattern: contractions, runs of letters, single digits and
    runs of other characters; white space is dropped.
    """
    n = len(codes)
    new = runs(kinds, bounds)
    starts = np.flatnonzero(new)
    ends = np.append(starts[1:], n)
    part_end = np.zeros(n + 1, bool)
    part_end[bounds] = True
    p, take = shared_contractions(codes, kinds, starts, ends, ~part_end[ends])
    new |= kinds == DIGIT
    _contract(new, p, take)
    starts = np.flatnonzero(new)
    ends = np.append(starts[1:], n)
    kept = kinds[starts] != SPACE
    return starts[kept], ends[kept]


def _contract(new: np.ndarray, p: np.ndarray, take: np.ndarray) -> None:
    new[p + 1] = False
    longer = take[1] > take[0]
    new[(p + 1 + take[0])[longer]] = True


def gather(store: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The slices of ``store`` one after another."""
    total = int(lengths.sum())
    shift = starts - (np.cumsum(lengths) - lengths)
    return store[np.repeat(shift, lengths) + np.arange(total)]


class WordIds:
    """Ids of words, encoded on first sight.

    Words are found by a 64-bit key and then compared with the known word character by
    character; where different words share a key, the words at hand are encoded anew. Holds
    at most about ``most`` words and starts anew beyond that, which costs time and changes no
    result.
    """

    def __init__(self, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], most: int = 400_000):
        self.encode, self.most = encode, most
        self._clear()

    def _clear(self) -> None:
        self.keys = np.empty(0, _U)
        self.slots = np.empty(0, np.int64)
        self.ids_of = _Slices()
        self.spelled = _Slices()

    def ids(self, codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids in order, and the number of ids of each word."""
        if not len(starts):
            return np.empty(0, np.uint32), np.empty(0, np.int64)
        which, unique = pd.factorize(word_hashes(codes, starts, ends))
        slot, known = self._find(unique)
        if not known.all():
            if len(self.keys) + (~known).sum() > self.most and len(self.keys):
                self._clear()
                known[:] = False
            first = np.empty(len(unique), np.int64)
            first[which[::-1]] = np.arange(len(which))[::-1]
            new = np.flatnonzero(~known)
            slot[new] = self._add(unique[new], codes, starts[first[new]], ends[first[new]])
        slot = slot[which]
        sizes = ends - starts
        tiled = bool((starts[1:] == ends[:-1]).all())
        mine = codes[starts[0] : ends[-1]] if tiled else gather(codes, starts, sizes)
        if np.array_equal(sizes, self.spelled.lengths[slot]) and np.array_equal(mine, self.spelled.take(slot)):
            return self.ids_of.take(slot), self.ids_of.lengths[slot]
        which, words = distinct_words(codes, starts, ends)
        anew = _Slices()
        anew.add(*self.encode([w.decode("utf-32-le", "surrogatepass") for w in words]))
        return anew.take(which), anew.lengths[which]

    def _find(self, unique: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(self.keys):
            return np.zeros(len(unique), np.int64), np.zeros(len(unique), bool)
        at = np.minimum(np.searchsorted(self.keys, unique), len(self.keys) - 1)
        return self.slots[at], self.keys[at] == unique

    def _add(self, keys: np.ndarray, codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        spelled = gather(codes, starts, ends - starts)
        text = spelled.tobytes().decode("utf-32-le", "surrogatepass")
        cut = np.append(0, np.cumsum(ends - starts)).tolist()
        self.ids_of.add(*self.encode([text[a:b] for a, b in zip(cut[:-1], cut[1:])]))
        slots = len(self.spelled.lengths) + np.arange(len(keys))
        self.spelled.add(spelled, ends - starts)
        order = np.argsort(keys)
        at = np.searchsorted(self.keys, keys[order])
        self.keys = np.insert(self.keys, at, keys[order])
        self.slots = np.insert(self.slots, at, slots[order])
        return slots


class _Slices:
    """Slices of numbers, one after another in a growing array."""

    def __init__(self):
        self.store = np.empty(1 << 16, np.uint32)
        self.starts = self.lengths = np.empty(0, np.int64)
        self.used = 0

    def add(self, values: np.ndarray, lengths: np.ndarray) -> None:
        while self.used + len(values) > len(self.store):
            self.store = np.concatenate([self.store, np.empty_like(self.store)])
        self.store[self.used : self.used + len(values)] = values
        self.starts = np.concatenate([self.starts, self.used + np.cumsum(lengths) - lengths])
        self.lengths = np.concatenate([self.lengths, lengths])
        self.used += len(values)

    def take(self, slots: np.ndarray) -> np.ndarray:
        return gather(self.store, self.starts[slots], self.lengths[slots])


def split_ids(
    texts: list[str],
    kinds: np.ndarray,
    split: Callable,
    table: WordIds,
    lower: np.ndarray | None = None,
    safe: np.ndarray | None = None,
) -> list[np.ndarray | None]:
    """The ids of each text: split into words, look the words up, put the ids together.

    None for a text with a character outside ``safe``.
    """
    out: list[list[np.ndarray]] = [[] for _ in texts]
    odd = np.zeros(len(texts), bool)
    for parts, owner in pieces(texts):
        codes, bounds = codepoints(parts)
        if not len(codes):
            continue
        if safe is not None and not (fine := safe[codes]).all():
            bad = set((np.searchsorted(bounds, np.flatnonzero(~fine), side="right") - 1).tolist())
            odd[[owner[k] for k in bad]] = True
            parts, owner = [p for k, p in enumerate(parts) if k not in bad], [o for k, o in enumerate(owner) if k not in bad]
            codes, bounds = codepoints(parts)
            if not len(codes):
                continue
        if lower is not None:
            codes = lower[codes]
        starts, ends = split(codes, kinds[codes], bounds)
        ids, lengths = table.ids(codes, starts, ends)
        words = np.searchsorted(starts, bounds)
        cut = np.append(0, np.cumsum(lengths))[words].tolist()
        for k, a, b in zip(owner, cut[:-1], cut[1:]):
            if b > a:
                out[k].append(ids[a:b])
    none = np.empty(0, np.uint32)
    return [None if o else x[0] if len(x) == 1 else np.concatenate(x) if x else none for x, o in zip(out, odd)]


_last: list = [None, None]


def kept(value, make: Callable):
    """``make(value)``, made once for a broadcast value in each Python worker."""
    if _last[0] is not value:
        _last[:] = [value, make(value)]
    return _last[1]
