"""Token ids in shard files that hold a wavelet matrix each.

Documents are encoded where they are read, dealt out by range of their id and written as
shards of bounded size in ascending order; an index row tells path, place and size of each.
"""

from __future__ import annotations

import json
import os
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.bpe import chunked, pattern_classes, slices, with_column, without
from tidemark.llm.prefix import running_sums
from tidemark.llm.store import Folder, open_input
from tidemark.llm.wavelet import Shard, pack
from tidemark.llm.words import CODES, WordIds, bare_words, kept, split_ids
from tidemark.session import cut, fresh_path

# The pattern of the lower-case tokenizer, as its file spells it.
LOWER_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
WORD_END = "</w>"


@dataclass
class Library:
    """A tokenizers file as text, and what lets texts be encoded word by word.

    ``safe`` tells code points that the normaliser maps one by one to ``lower``; without
    tables, whole texts go to the library.
    """

    spec: str
    kinds: np.ndarray | None
    lower: np.ndarray | None
    safe: np.ndarray | None
    ends: np.ndarray | None
    special: list[str]


def load(path: str) -> Library:
    """Reads a tokenizers file on the driver; unused truncation and padding are dropped."""
    import unicodedata

    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    spec["truncation"] = spec["padding"] = None
    special = [t["content"] for t in spec["added_tokens"]]
    text = json.dumps(spec)
    split = (spec["pre_tokenizer"] or {}).get("pretokenizers", [{}])
    steps = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
    by_word = (
        split[0].get("pattern", {}).get("Regex") == LOWER_PATTERN
        and split[0].get("invert")
        and split[0].get("behavior") == "Removed"
        and steps == ["NFC", "Replace", "Lowercase"]
        and spec["model"].get("end_of_word_suffix") == WORD_END
    )
    if not by_word:
        return Library(text, None, None, None, None, special)
    tokenizer = Tokenizer.from_str(text)
    valid = [c for c in range(1, CODES) if not 0xD800 <= c < 0xE000 and not chr(c).isspace()]
    mapped = tokenizer.normalizer.normalize_str("\x01".join(map(chr, valid))).split("\x01")
    lower = np.arange(CODES, dtype=np.uint32)
    safe = np.zeros(CODES, bool)
    for code, to in zip(valid[1:], mapped[2:]):  # the first is the separator itself
        joins = unicodedata.category(chr(code))[0] == "M" or 0x1100 <= code < 0x1200 or 0xD7B0 <= code < 0xD800
        if len(to) == 1 and not joins:
            lower[code], safe[code] = ord(to), True
    safe[[9, 10, 11, 12, 13, 32]] = True
    tokens = tokenizer.get_vocab()
    ends = np.zeros(max(tokens.values()) + 1, bool)
    ends[[i for t, i in tokens.items() if t.endswith(WORD_END)]] = True
    return Library(text, pattern_classes(), lower, safe, ends, special)


class LibraryEncoder:
    """Ids as the library's ``encode(text, add_special_tokens=False)`` gives them.

    The library encodes each new word once, many words to a call. Texts with characters
    that its normaliser does not map one by one (marks, some letters) and with strings of
    added tokens go to the library whole.
    """

    def __init__(self, library: Library):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = library
        self.tokenizer = Tokenizer.from_str(library.spec)
        self.table = WordIds(self._words)

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        known = self.library
        if known.kinds is None:
            return self._whole(texts)
        plain = [not any(s in t for s in known.special) for t in texts]
        by_word = iter(split_ids([t for t, p in zip(texts, plain) if p], known.kinds, bare_words, self.table, known.lower, known.safe))
        out = [next(by_word) if p else None for p in plain]
        whole = iter(self._whole([t for t, ids in zip(texts, out) if ids is None]))
        return [next(whole) if ids is None else ids for ids in out]

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        out: list[np.ndarray] = []
        for some in chunked(texts, 200_000):
            out += [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(some, add_special_tokens=False)]
        return out

    def _words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        lines = [" ".join(words[k : k + 500]) for k in range(0, len(words), 500)]
        ids = np.concatenate(self._whole(lines))
        ends = np.flatnonzero(self.library.ends[ids]) + 1
        if len(ends) != len(words) or ends[-1] != len(ids):
            raise ValueError("a word of the tokenizer does not end in a word-end token")
        return ids, np.diff(np.append(0, ends))


def encode(
    docs: DataFrame, library: Library, end_id: int | None = None, text: str = "text", ids: str = "ids", count: str = "n_tokens", width: int = 4
) -> DataFrame:
    """Adds the ids of the whole text (binary: little-endian unsigned, ``width`` 2 or 4 bytes),
    ``end_id`` after them, and their number. A null text is empty. Columns of these names
    are replaced. An id that needs more bytes is an error.
    """
    docs = without(docs, ids, count)
    shared = docs.sparkSession.sparkContext.broadcast(library)
    at = docs.columns.index(text)
    tail = np.array([] if end_id is None else [end_id], np.uint32)

    def run(batches):
        encoder = kept(shared.value, LibraryEncoder)
        for batch in slices(batches, at):
            got = [np.concatenate([a, tail]) for a in encoder([t or "" for t in batch.column(at).to_pylist()])]
            if any(len(a) and int(a.max()) >> 8 * width for a in got):
                raise ValueError(f"an id does not fit into {width} bytes")
            yield with_column(
                batch,
                [ids, count],
                [pa.array([a.astype(f"<u{width}", copy=False).tobytes() for a in got], pa.binary()), pa.array([len(a) for a in got], pa.int64())],
            )

    schema = T.StructType([*docs.schema, T.StructField(ids, T.BinaryType()), T.StructField(count, T.LongType())])
    return docs.mapInArrow(run, schema)


INDEX = "path string, part int, seq int, n_docs long, n_tokens long"


def write_shards(
    encoded: DataFrame, key: str = "doc_id", ids: str = "ids", count: str = "n_tokens", shard_tokens: int = 1 << 21, width: int = 4
) -> DataFrame:
    """Writes shards in ascending key order and returns their index, with ``start``: the ids
    before the shard. ``width`` is that of the encoded ids.

    Null keys come first; rows with equal keys are ordered by their ids' checksum. A shard
    is closed when it holds ``shard_tokens`` ids, so it holds at most that and one document.
    Files lie in the shared folder; only those that the index names count.
    """
    spark = encoded.sparkSession
    placed = cut(
        encoded.select(F.col(key).cast("long").alias("key"), F.col(ids).alias("ids"), F.col(count).alias("n"), F.crc32(F.col(ids)).alias("crc")).withColumn(
            "row", F.monotonically_increasing_id()
        )
    )
    total = placed.agg(F.sum("n")).first()[0] or 0
    order = [F.col(c).asc() for c in ("key", "crc", "n", "row")]
    parts = int(max(spark.sparkContext.defaultParallelism, -(-total // shard_tokens)))
    root = fresh_path(spark, "shards")

    def write(batches):
        folder = Folder(root, ".wm")
        part, seq = TaskContext.get().partitionId(), 0
        keys: list[int | None] = []
        arrays: list[np.ndarray] = []
        held = 0

        def close():
            nonlocal keys, arrays, held, seq
            path, out = folder.next()
            with out:
                out.write(pack(np.concatenate(arrays), keys, [len(a) for a in arrays]))
            row = {"path": [path], "part": [part], "seq": [seq], "n_docs": [len(keys)], "n_tokens": [held]}
            keys, arrays, held, seq = [], [], 0, seq + 1
            return pa.RecordBatch.from_pydict(row, pa.schema([("path", pa.string()), ("part", pa.int32()), ("seq", pa.int32()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())]))

        for batch in batches:
            for k, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                arrays.append(np.frombuffer(data.as_buffer() or b"", f"<u{width}"))
                keys.append(k)
                held += len(arrays[-1])
                if held >= shard_tokens:
                    yield close()
        if keys:
            yield close()

    rows = placed.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("key", "ids")
    index = cut(rows.mapInArrow(write, INDEX))
    summed = running_sums(index, [F.col("part").asc(), F.col("seq").asc()], {"n_tokens": "_upto"})
    return summed.withColumn("start", F.col("_upto") - F.col("n_tokens")).drop("_upto")


def read_shards(index: DataFrame, key: str = "doc_id") -> DataFrame:
    """The documents in the shards of an index: key, start, n_tokens, ids; a shard to a task."""
    at = [index.columns.index(c) for c in ("path", "start")]

    def read(batches):
        for batch in batches:
            for path, start in zip(batch.column(at[0]).to_pylist(), batch.column(at[1]).to_pylist()):
                shard = Shard(open_input(path))
                ids, lengths = shard.all().astype("<u4"), shard.lengths
                ends = np.cumsum(lengths)
                first = start + ends - lengths
                for some in chunked(list(range(len(lengths))), 500_000, lambda k, n=lengths: int(n[k]) + 1):
                    a, b = some[0], some[-1] + 1
                    data = [ids[e - n : e].tobytes() for e, n in zip(ends[a:b].tolist(), lengths[a:b].tolist())]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(shard.keys[a:b], pa.int64()), pa.array(first[a:b]), pa.array(lengths[a:b]), pa.array(data, pa.binary())],
                        names=[key, "start", "n_tokens", "ids"],
                    )

    spread = index.repartition(max(1, index.count() // 2), "part", "seq")
    return spread.mapInArrow(read, f"`{key}` long, start long, n_tokens long, ids binary")
