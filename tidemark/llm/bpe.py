"""Byte-level BPE: encoding by batched merge rounds over flat arrays, and decoding.

The words of many texts that have not been met before are put into one flat array of
symbols. Each round looks all neighbouring pairs up by binary search in the sorted pair
keys, takes the lowest rank of each word and merges its places from left to right; words
without a known pair leave the rounds.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.words import (
    CODES,
    DIGIT,
    LETTER,
    OTHER,
    SPACE,
    WordIds,
    gather,
    kept,
    space_led_words,
    split_ids,
)

_NONE = np.iinfo(np.int64).max


@lru_cache(maxsize=1)
def pattern_classes() -> np.ndarray:
    """Class of each code point by the tokenizer library's own tables of characters."""
    from tokenizers import Regex, pre_tokenizers

    valid = [c for c in range(CODES) if not 0xD800 <= c < 0xE000]
    text = "".join(map(chr, valid))
    code = np.array(valid)
    out = np.full(CODES, OTHER, np.uint8)
    for pattern, kind in ((r"\p{L}", LETTER), (r"\p{N}", DIGIT), (r"\s", SPACE)):
        rest = np.ones(len(valid), bool)
        split = pre_tokenizers.Split(Regex(pattern), behavior="removed")
        for _, (a, b) in split.pre_tokenize_str(text):
            rest[a:b] = False
        out[code[rest]] = kind
    return out


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, extra = [], 0
    for byte in range(256):
        if byte in plain:
            out.append(chr(byte))
        else:
            out.append(chr(256 + extra))
            extra += 1
    return out


@dataclass
class Vocabulary:
    """Sorted pair keys with rank and merged id, the bytes of each id, and special tokens."""

    first: np.ndarray
    keys: np.ndarray
    ranks: np.ndarray
    merged: np.ndarray
    token_bytes: np.ndarray
    token_starts: np.ndarray
    token_lengths: np.ndarray
    special: dict[str, int]
    kinds: np.ndarray


def load(path: str) -> Vocabulary:
    """A byte-level BPE tokenizer file of the tokenizers library, read on the driver.

    Raises ValueError for a file whose normaliser, model options or splitting differ from
    plain byte-level BPE.
    """
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, split = spec["model"], spec["pre_tokenizer"] or {}
    odd = (
        spec["normalizer"] is not None
        or split.get("type") != "ByteLevel"
        or split.get("add_prefix_space")
        or not split.get("use_regex", True)
        or model["type"] != "BPE"
        or any(model.get(k) for k in ("dropout", "byte_fallback", "ignore_merges", "end_of_word_suffix"))
    )
    if odd:
        raise ValueError(f"{path} is not a plain byte-level BPE tokenizer")
    vocab = model["vocab"]
    symbols = byte_symbols()
    byte_of = {c: b for b, c in enumerate(symbols)}
    keys, merged = [], []
    for a, b in (m if isinstance(m, list) else m.split(" ") for m in model["merges"]):
        keys.append(vocab[a] << 32 | vocab[b])
        merged.append(vocab[a + b])
    keys = np.array(keys, np.int64)
    order = np.argsort(keys, kind="stable")
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    spelled = {i: bytes(byte_of[c] for c in t) for t, i in vocab.items()}
    spelled |= {i: t.encode() for t, i in special.items()}
    table = [spelled.get(i, b"") for i in range(max(spelled) + 1)]
    lengths = np.array([len(t) for t in table], np.int64)
    return Vocabulary(
        first=np.array([vocab[c] for c in symbols], np.int64),
        keys=keys[order],
        ranks=order.astype(np.int64),
        merged=np.array(merged, np.int64)[order],
        token_bytes=np.frombuffer(b"".join(table), np.uint8),
        token_starts=np.cumsum(lengths) - lengths,
        token_lengths=lengths,
        special=special,
        kinds=pattern_classes(),
    )


def merge_rounds(vocab: Vocabulary, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words one after another, and the number of ids of each word."""
    sizes = np.array([len(w) for w in words], np.int64)
    symbols = vocab.first[np.frombuffer(b"".join(words), np.uint8)]
    word = np.repeat(np.arange(len(words)), sizes)
    counts = np.zeros(len(words), np.int64)
    done: list[tuple[np.ndarray, np.ndarray]] = []
    while len(symbols):
        inside = word[1:] == word[:-1]
        key = symbols[:-1] << 32 | symbols[1:]
        at = np.minimum(np.searchsorted(vocab.keys, key), len(vocab.keys) - 1)
        rank = np.full(len(symbols), _NONE)
        known = inside & (vocab.keys[at] == key)
        rank[:-1][known] = vocab.ranks[at[known]]
        heads = np.flatnonzero(np.append(True, ~inside))
        best = np.minimum.reduceat(rank, heads)
        best = np.repeat(best, np.diff(np.append(heads, len(symbols))))
        over = best == _NONE
        place = np.flatnonzero((rank == best) & ~over)
        # Overlapping places of one pair (a a a): take every second from the left.
        head = np.append(True, place[1:] != place[:-1] + 1)[: len(place)]
        inrun = np.arange(len(place)) - np.flatnonzero(head)[np.cumsum(head) - 1] if len(place) else place
        place = place[inrun % 2 == 0]
        if over.any():
            done.append((word[over], symbols[over]))
        symbols[place] = vocab.merged[at[place]]
        left = ~over
        left[place + 1] = False
        symbols, word = symbols[left], word[left]
    if not done:
        return np.empty(0, np.uint32), counts
    words_done = np.concatenate([w for w, _ in done])
    ids = np.concatenate([s for _, s in done])
    counts += np.bincount(words_done, minlength=len(words))
    return ids[np.argsort(words_done, kind="stable")].astype(np.uint32), counts


class Encoder:
    """Encodes lists of texts; keeps the ids of words it has met.

    With ``special`` the special tokens' strings in a text become their ids, as the
    library does by default; without, they are ordinary text.
    """

    def __init__(self, vocab: Vocabulary, special: bool = True):
        self.vocab = vocab
        self.special = vocab.special if special else {}
        self.table = WordIds(lambda words: merge_rounds(vocab, [w.encode("utf-8", "surrogatepass") for w in words]))

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        plain: list[str] = []
        plan: list[list[int]] = []  # of each text: places in plain, or -1 - id
        for text in texts:
            plan.append([])
            for part in self._parts(text):
                if isinstance(part, int):
                    plan[-1].append(-1 - part)
                elif part:
                    plan[-1].append(len(plain))
                    plain.append(part)
        got = split_ids(plain, self.vocab.kinds, space_led_words, self.table)
        none = np.empty(0, np.uint32)
        out = []
        for steps in plan:
            arrays = [got[s] if s >= 0 else np.array([-1 - s], np.uint32) for s in steps]
            out.append(arrays[0] if len(arrays) == 1 else np.concatenate(arrays) if arrays else none)
        return out

    def _parts(self, text: str) -> Iterator[str | int]:
        at = 0
        while self.special:
            found = [(text.find(s, at), -len(s), i) for s, i in self.special.items()]
            found = [f for f in found if f[0] >= 0]
            if not found:
                break
            where, size, token = min(found)
            yield text[at:where]
            yield token
            at = where - size
        yield text[at:]


def decode_ids(vocab: Vocabulary, arrays: list[np.ndarray]) -> list[str]:
    """The text of each id array; bytes that are not UTF-8 become U+FFFD."""
    counts = np.array([len(a) for a in arrays], np.int64)
    ids = np.concatenate(arrays) if arrays else np.empty(0, np.uint32)
    size = vocab.token_lengths[ids]
    data = gather(vocab.token_bytes, vocab.token_starts[ids], size).tobytes()
    ends = np.append(0, np.cumsum(size))[np.append(0, np.cumsum(counts))].tolist()
    return [data[a:b].decode("utf-8", "replace") for a, b in zip(ends[:-1], ends[1:])]


def chunked(arrays: list, most: int, size=len) -> Iterator[list]:
    """Lists of items whose sizes add up to about ``most``."""
    out: list = []
    total = 0
    for x in arrays:
        out.append(x)
        total += size(x)
        if total >= most:
            yield out
            out, total = [], 0
    if out:
        yield out


def slices(batches, column: int, most: int = 2_000_000) -> Iterator[pa.RecordBatch]:
    """The batches in slices with about ``most`` bytes in a text or binary column, so that what
    Python holds does not follow Spark's batch size. A longer value is a slice of its own.
    """
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        upto = np.cumsum(size, dtype=np.int64)
        a = 0
        while a < batch.num_rows:
            b = max(a + 1, int(np.searchsorted(upto, (upto[a - 1] if a else 0) + most, side="right")))
            yield batch.slice(a, b - a)
            a = b


def with_column(batch: pa.RecordBatch, names: list[str], arrays: list[pa.Array]) -> pa.RecordBatch:
    """The batch with columns at its end."""
    return pa.RecordBatch.from_arrays([*batch.columns, *arrays], [*batch.schema.names, *names])


def encode(
    docs: DataFrame, vocab: Vocabulary, text: str = "text", ids: str = "ids", count: str = "n_tokens", special: bool = True, decoded: str | None = None
) -> DataFrame:
    """Adds the ids of the whole text (binary: little-endian unsigned 32-bit) and their number.

    A null or empty text has no ids. Other columns pass through, repeated rows too; columns
    that are named ``ids`` or ``count`` already are replaced. With ``decoded``, a column of
    that name holds the text that the ids stand for (see decode), made in the same task
    instead of a second Python worker. Nothing is shuffled.
    """
    docs = without(docs, ids, count, *([decoded] if decoded else []))
    shared = docs.sparkSession.sparkContext.broadcast(vocab)
    at = docs.columns.index(text)

    def run(batches):
        encoder = kept(shared.value, lambda vocab: Encoder(vocab, special))
        for batch in slices(batches, at):
            got = encoder([t or "" for t in batch.column(at).to_pylist()])
            names, columns = [ids, count], [pa.array([a.astype("<u4", copy=False).tobytes() for a in got], pa.binary()), pa.array([len(a) for a in got], pa.int64())]
            if decoded:
                names.append(decoded)
                columns.append(pa.array(_decoded(shared.value, got), pa.string()))
            yield with_column(batch, names, columns)

    fields = [T.StructField(ids, T.BinaryType()), T.StructField(count, T.LongType())]
    fields += [T.StructField(decoded, T.StringType())] if decoded else []
    return docs.mapInArrow(run, T.StructType([*docs.schema, *fields]))


def _decoded(vocab: Vocabulary, arrays: list[np.ndarray]) -> list[str]:
    return [t for some in chunked(arrays, 200_000) for t in decode_ids(vocab, some)]


def decode(df: DataFrame, vocab: Vocabulary, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Adds the text that the ids stand for; special tokens are written out, null is empty.

    A column that is named ``text`` already is replaced.
    """
    df = without(df, text)
    shared = df.sparkSession.sparkContext.broadcast(vocab)
    at = df.columns.index(ids)

    def run(batches):
        for batch in slices(batches, at):
            arrays = [np.frombuffer(b or b"", "<u4") for b in batch.column(at).to_pylist()]
            yield with_column(batch, [text], [pa.array(_decoded(shared.value, arrays), pa.string())])

    return df.mapInArrow(run, T.StructType([*df.schema, T.StructField(text, T.StringType())]))


def without(df: DataFrame, *names: str) -> DataFrame:
    """The frame without columns of these names, in any case."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])
