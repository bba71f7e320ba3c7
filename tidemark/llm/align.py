"""Token alignment of two tokenizers over the same texts, by whitespace anchors.

Both tokenizers read a whole text. Byte offsets where a token of both ends are shared ends;
those before a token that both mark with a leading space are anchors, and cut the text into
windows of token ids. What a window's alignment looks like depends on its ids alone, so it
is worked out once and kept by them.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.bpe import Encoder, Vocabulary, chunked, slices
from tidemark.llm.words import CODES, WordIds, gather, kept, split_ids
from tidemark.session import cut

SPACE = "▁"  # Fixed value: how a piece spells a space.
MARK = 0xFFFFFFFF  # Between the ids of A and B; no id.


@dataclass
class Pieces:
    """A SentencePiece model file and the bytes that each of its ids stands for.

    ``by_word`` tells that no piece reaches beyond the blanks before a word and the word:
    then words can be encoded one by one, and each only once.
    """

    model: bytes
    by_word: bool
    token_bytes: np.ndarray
    token_starts: np.ndarray
    token_lengths: np.ndarray


def load_pieces(path: str) -> Pieces:
    """Reads a SentencePiece model on the driver."""
    import sentencepiece

    with open(path, "rb") as f:
        model = f.read()
    reader = sentencepiece.SentencePieceProcessor(model_proto=model)
    names = [reader.id_to_piece(i) for i in range(reader.vocab_size())]
    table = [bytes([int(p[3:5], 16)]) if reader.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(names)]
    lengths = np.array([len(t) for t in table], np.int64)
    inside = any(SPACE in p.lstrip(SPACE) for p in names)
    return Pieces(
        model, _plain_bpe(model) and SPACE in names and not inside, np.frombuffer(b"".join(table), np.uint8), np.cumsum(lengths) - lengths, lengths
    )


def _plain_bpe(model: bytes) -> bool:
    """Whether the model merges characters as they are, with one space put first."""
    try:
        from sentencepiece import sentencepiece_model_pb2
    except ImportError:
        return False
    spec = sentencepiece_model_pb2.ModelProto.FromString(model)
    norm = spec.normalizer_spec
    own = any(p.type == p.USER_DEFINED for p in spec.pieces)
    return (
        spec.trainer_spec.model_type == spec.trainer_spec.BPE
        and not spec.trainer_spec.treat_whitespace_as_suffix
        and not norm.precompiled_charsmap
        and norm.add_dummy_prefix
        and norm.escape_whitespaces
        and not norm.remove_extra_whitespaces
        and not own
    )


def _blank_led(codes: np.ndarray, kinds: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words with all the blanks before them, or the blanks at a text's end; nothing is left out."""
    new = np.zeros(len(codes), bool)
    new[1:] = (kinds[1:] == 1) & (kinds[:-1] == 0)
    new[bounds[:-1][bounds[:-1] < len(codes)]] = True
    starts = np.flatnonzero(new)
    return starts, np.append(starts[1:], len(codes))


class PieceEncoder:
    """Ids as the library's ``encode(text)`` gives them, for texts after one space."""

    def __init__(self, pieces: Pieces):
        import sentencepiece

        self.by_word = pieces.by_word
        self.reader = sentencepiece.SentencePieceProcessor(model_proto=pieces.model)
        self.table = WordIds(self._words)
        self.blank = np.zeros(CODES, np.uint8)
        self.blank[32] = 1

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        """``texts`` begin with the space that the library would put there."""
        if self.by_word:
            # A blank spelled out in a text is one for the library too; such texts go whole.
            plain = [SPACE not in t for t in texts]
            words = iter(split_ids([t for t, p in zip(texts, plain) if p], self.blank, _blank_led, self.table))
            whole = iter(self._whole([t for t, p in zip(texts, plain) if not p]))
            return [next(words) if p else next(whole) for p in plain]
        return self._whole(texts)

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        out: list[np.ndarray] = []
        for some in chunked(texts, 500_000):
            out += [np.array(ids, np.uint32) for ids in self.reader.encode([t[1:] for t in some], num_threads=1)]
        return out

    def _words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = self.reader.encode([w[1:] for w in words], num_threads=1)
        # The library gives an empty text nothing, but one blank at a text's end is a piece.
        alone = [self.reader.piece_to_id(SPACE)]
        ids = [alone if w == " " else x for w, x in zip(words, ids)]
        lengths = np.array([len(x) for x in ids], np.int64)
        return np.fromiter(chain.from_iterable(ids), np.uint32, int(lengths.sum())), lengths


def _spaced(table: Vocabulary | Pieces) -> np.ndarray:
    """Whether the bytes of each id begin with a space."""
    first = np.append(table.token_bytes, 0)[np.minimum(table.token_starts, len(table.token_bytes))]
    return (table.token_lengths > 0) & (first == 32)


def _with_marks(many: int, marks: str | list[str]) -> np.ndarray:
    """Every id as text with each of the marks behind it."""
    return np.array([[f"{i}{m}" for i in range(many)] for m in marks], object)


def _joined(arrays: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """All ids one after another, and the n + 1 bounds of the arrays."""
    bounds = np.append(0, np.cumsum([len(a) for a in arrays], dtype=np.int64)).astype(np.int64)
    return (np.concatenate(arrays) if arrays else np.empty(0)).astype(np.int64), bounds


class Aligner:
    """Aligns lists of texts; keeps the alignments of the windows it has met.

    At most about ``most`` windows of up to ``longest`` tokens are kept, and it starts anew
    beyond that; longer ones are worked out each time. Neither changes a result.
    """

    def __init__(self, vocab: Vocabulary, pieces: Pieces, most: int = 300_000, longest: int = 48):
        self.vocab, self.pieces = vocab, pieces
        self.first = Encoder(vocab, special=False)
        self.second = PieceEncoder(pieces)
        self.most, self.longest = most, longest
        self.wide = len(pieces.token_lengths)
        self.space_a, self.space_b = _spaced(vocab), _spaced(pieces)
        # Ids within a group, at the end of a group, and at the end of a window.
        self.spelled_a = _with_marks(len(vocab.token_lengths), ",|")
        self.spelled_b = _with_marks(self.wide, [",", ";", ""])
        self._clear()

    def _clear(self) -> None:
        self.slots: dict[bytes, int] = {}
        self.shown: list[str] = []
        self.groups = np.empty(0, np.int64)
        self.starts = np.empty(0, np.int64)
        self.lengths = np.empty(0, np.int64)
        self.links = np.empty(1 << 16, np.int64)
        self.used = 0

    def _encode(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """The ids of both tokenizers; none for texts that are empty or that the joined bytes
        of either do not give back, with the space before them.
        """
        none = np.empty(0, np.uint32)
        spaced = [" " + t for t in texts]
        one, two = self.first(spaced), self.second(spaced)
        for k, text in enumerate(spaced):
            want = text.encode("utf-8", "surrogatepass")
            if len(text) == 1 or self._spelled(self.vocab, one[k]) != want or self._spelled(self.pieces, two[k]) != want:
                one[k] = two[k] = none
        return one, two

    @staticmethod
    def _spelled(table: Vocabulary | Pieces, ids: np.ndarray) -> bytes:
        return gather(table.token_bytes, table.token_starts[ids], table.token_lengths[ids]).tobytes()

    def __call__(self, texts: list[str]) -> dict[str, list | np.ndarray]:
        """n_a, n_b, n_groups, n_links and shown of each text, and all links in order as ``links``:
        id a times the number of ids b, plus id b.
        """
        one, two = self._encode(texts)
        a, a_bounds = _joined(one)
        b, b_bounds = _joined(two)
        a_ends, b_ends = np.cumsum(self.vocab.token_lengths[a]), np.cumsum(self.pieces.token_lengths[b])
        # Texts are verified, so both tokenizers have the same bytes up to each text's end.
        at = np.minimum(np.searchsorted(b_ends, a_ends), max(0, len(b_ends) - 1))
        shared = b_ends[at] == a_ends if len(b) else np.zeros(len(a), bool)
        i = np.flatnonzero(shared) + 1
        j = at[shared] + 1
        last = np.zeros(len(a) + 1, bool)
        last[a_bounds] = True
        anchor = last[i]
        inner = np.flatnonzero(~anchor)
        anchor[inner] = self.space_a[a[i[inner]]] & self.space_b[b[j[inner]]]
        i, j = np.append(0, i[anchor]), np.append(0, j[anchor])
        windows = np.searchsorted(i, a_bounds)  # bounds of the texts in windows
        slots = self._slots(a, b, i, j)
        counts = self.lengths[slots]
        links = gather(self.links, self.starts[slots], counts)
        add_up = lambda x: np.diff(np.append(0, np.cumsum(x))[windows])
        shown = [self.shown[s] for s in slots.tolist()]
        cuts = windows.tolist()
        return {
            "n_a": np.diff(a_bounds),
            "n_b": np.diff(b_bounds),
            "n_groups": add_up(self.groups[slots]),
            "n_links": add_up(counts),
            "shown": [";".join(shown[x:y]) for x, y in zip(cuts[:-1], cuts[1:])],
            "links": links,
        }

    def _slots(self, a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """The kept alignment of each window, from token bounds i and j."""
        n = len(i) - 1
        if len(self.shown) > self.most:
            self._clear()
        if not n:
            return np.empty(0, np.int64)
        # The ids of a window in one stretch: those of A, a mark, those of B.
        window = np.arange(n)
        both = np.full(len(a) + len(b) + n, MARK, np.uint32)
        both[np.arange(len(a)) + np.repeat(j[:-1] + window, np.diff(i))] = a
        both[np.arange(len(b)) + np.repeat(i[1:] + window + 1, np.diff(j))] = b
        offsets = np.append(0, i[1:] + j[1:] + window + 1) * 4
        coded = pa.Array.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(both)]).dictionary_encode()
        which, keys = coded.indices.to_numpy(), coded.dictionary.to_pylist()
        known = self.slots.get
        slots = np.array([known(k, -1) for k in keys], np.int64)
        new = np.flatnonzero(slots < 0)
        if len(new):
            first = np.empty(len(keys), np.int64)
            first[which[::-1]] = window[::-1]
            before = len(self.shown)
            self._align(a, b, i, j, first[new])
            slots[new] = before + np.arange(len(new))
            long = 4 * (self.longest + 1)
            self.slots.update((keys[k], s) for k, s in zip(new.tolist(), slots[new].tolist()) if len(keys[k]) <= long)
        return slots[which]

    def _align(self, a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray, chosen: np.ndarray) -> None:
        """Aligns the chosen windows and keeps the results."""
        n_a, n_b = (i[1:] - i[:-1])[chosen], (j[1:] - j[:-1])[chosen]
        a, b = gather(a, i[chosen], n_a), gather(b, j[chosen], n_b)
        # Both run over the same bytes: their ends merged, each with the tokens that end before.
        ends = np.concatenate([np.cumsum(self.vocab.token_lengths[a]), np.cumsum(self.pieces.token_lengths[b])])
        order = np.argsort(ends, kind="stable")
        ends, is_a = ends[order], order < len(a)
        first = np.append(True, ends[1:] != ends[:-1])
        of_a = (np.cumsum(is_a) - is_a)[first]
        of_b = (np.cumsum(~is_a) - ~is_a)[first]
        # Between neighbouring ends of either lies one part of one token of each: a link.
        links = a[of_a] * self.wide + b[of_b]
        both = np.append(~first[1:], False)[first]
        last_a = of_a[both]
        last = np.searchsorted(last_a, np.cumsum(n_a) - 1)  # the last group of each window
        lengths = np.diff(np.append(0, np.flatnonzero(both)[last] + 1))
        groups = np.diff(np.append(0, last + 1))
        self._show(a, b, last_a, of_b[both], last, n_a + n_b)
        self.groups = np.append(self.groups, groups)
        self.starts = np.append(self.starts, self.used + np.cumsum(lengths) - lengths)
        self.lengths = np.append(self.lengths, lengths)
        while self.used + len(links) > len(self.links):
            self.links = np.concatenate([self.links, np.empty_like(self.links)])
        self.links[self.used : self.used + len(links)] = links
        self.used += len(links)

    def _show(self, a: np.ndarray, b: np.ndarray, last_a: np.ndarray, last_b: np.ndarray, last: np.ndarray, sizes: np.ndarray) -> None:
        """Spells the groups of windows, from the last token of each group and the last group of
        each window: every id with the mark behind it, in order.
        """
        spelled = np.empty(len(a) + len(b), object)
        mark = np.zeros(len(a), np.int64)
        mark[last_a] = 1
        count = np.diff(np.append(-1, last_a)), np.diff(np.append(-1, last_b))
        before = np.repeat(np.cumsum(count[1]) - count[1], count[0])
        spelled[np.arange(len(a)) + before] = self.spelled_a[mark, a]
        mark = np.zeros(len(b), np.int64)
        mark[last_b] = 1
        mark[last_b[last]] = 2
        upto = np.repeat(np.cumsum(count[0]), count[1])
        spelled[np.arange(len(b)) + upto] = self.spelled_b[mark, b]
        tokens = spelled.tolist()
        cuts = np.append(0, np.cumsum(sizes)).tolist()
        self.shown += ["".join(tokens[x:y]) for x, y in zip(cuts[:-1], cuts[1:])]


def align(docs: DataFrame, vocab: Vocabulary, pieces: Pieces, key: str = "doc_id", text: str = "text", groups: bool = True) -> DataFrame:
    """(key, n_a, n_b, n_groups, n_links, groups, pairs, times) of each document.

    ``vocab`` (A) encodes a space and the text, ``pieces`` (B) the text, both without special
    tokens. ``groups`` spells the token groups between shared ends, `a1,a2|b1;a3|b2`, or is its
    SHA-256 in hex if ``groups`` is false; ``pairs`` has the distinct linked ids as
    a * (number of B ids) + b, ``times`` how often each is linked. Null and empty texts,
    and texts that the joined bytes of A or B do not give back, have no tokens: zeros, an
    empty text and empty lists. Repeated rows stay; other columns are left out.
    """
    source = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast((vocab, pieces))

    def run(batches):
        import hashlib

        aligner = kept(shared.value, lambda both: Aligner(*both))
        for batch in slices(batches, 1, 1_500_000):
            got = aligner([t or "" for t in batch.column(1).to_pylist()])
            owner = np.repeat(np.arange(batch.num_rows), got["n_links"])
            most = len(aligner.vocab.token_lengths) * aligner.wide
            code, times = np.unique(owner * most + got["links"], return_counts=True)
            offsets = pa.array(np.searchsorted(code, np.arange(batch.num_rows + 1) * most).astype(np.int32))
            shown = got["shown"] if groups else [hashlib.sha256(s.encode()).hexdigest() if s else "" for s in got["shown"]]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    *[pa.array(got[c].astype(np.int64)) for c in ("n_a", "n_b", "n_groups", "n_links")],
                    pa.array(shown, pa.string()),
                    pa.ListArray.from_arrays(offsets, pa.array(code % most)),
                    pa.ListArray.from_arrays(offsets, pa.array(times.astype(np.int32))),
                ],
                names=["key", "n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "times"],
            )

    fields = T.StructType.fromDDL("n_a long, n_b long, n_groups long, n_links long, groups string, pairs array<long>, times array<int>")
    return source.mapInArrow(run, T.StructType([source.schema["key"], *fields])).withColumnRenamed("key", key)


def pair_counts(aligned: DataFrame, wide: int) -> DataFrame:
    """(pair, count, best): in how many documents a pair is linked, and whether no pair of the
    same A id is linked in more. ``wide`` is the number of B ids.
    """
    counts = cut(aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("count")))
    first = F.expr(f"pair DIV {wide}")
    highest = counts.groupBy(first.alias("a")).agg(F.max("count").alias("most"))
    with_a = counts.withColumn("a", first).join(highest, "a")
    return with_a.select("pair", "count", (F.col("count") == F.col("most")).alias("best"))


def score(docs: DataFrame, vocab: Vocabulary, pieces: Pieces, key: str = "doc_id", text: str = "text", held: int = 1 << 20) -> DataFrame:
    """align() with n_best (links whose pair count is the highest of their A id in the corpus)
    and count_sum (pair counts over all links); ``groups`` as SHA-256.

    Pair counts cover all documents. The most frequent pairs, at most ``held`` of them, are
    broadcast as sorted arrays; the links of the others, of which none is frequent, meet
    their counts in a join.
    """
    aligned = cut(align(docs, vocab, pieces, key, text, groups=False).withColumn("_row", F.monotonically_increasing_id()))
    counts = cut(pair_counts(aligned, len(pieces.token_lengths)))
    size = F.length(F.bin("count"))
    above = 0
    least = 0
    for bits, n in sorted(((r[0], r[1]) for r in counts.groupBy(size.alias("bits")).agg(F.count(F.lit(1))).collect()), reverse=True):
        above += n
        if above > held:
            least = 1 << bits
            break
    table = counts.filter(F.col("count") >= least).orderBy("pair").toArrow()
    shared = docs.sparkSession.sparkContext.broadcast(
        (table["pair"].to_numpy(), table["count"].to_numpy(), table["best"].to_numpy(zero_copy_only=False) if table.num_rows else np.empty(0, bool))
    )

    def run(batches):
        keys, values, best = shared.value
        for batch in batches:
            pairs = batch.column(1).flatten().to_numpy()
            times = batch.column(2).flatten().to_numpy().astype(np.int64)
            owner = np.repeat(np.arange(batch.num_rows), batch.column(1).value_lengths().to_numpy())
            at = np.minimum(np.searchsorted(keys, pairs), max(0, len(keys) - 1))
            known = keys[at] == pairs if len(keys) else np.zeros(len(pairs), bool)
            add = np.zeros((2, batch.num_rows), np.int64)
            np.add.at(add[0], owner[known], times[known] * best[at[known]])
            np.add.at(add[1], owner[known], times[known] * values[at[known]])
            rest = np.flatnonzero(~known)
            offsets = pa.array(np.searchsorted(owner[rest], np.arange(batch.num_rows + 1)).astype(np.int32))
            links = pa.StructArray.from_arrays([pa.array(pairs[rest]), pa.array(times[rest])], names=["pair", "times"])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(add[0]), pa.array(add[1]), pa.ListArray.from_arrays(offsets, links)],
                names=["_row", "n_best", "count_sum", "rest"],
            )

    schema = "_row long, n_best long, count_sum long, rest array<struct<pair:long,times:long>>"
    summed = cut(aligned.select("_row", "pairs", "times").mapInArrow(run, schema))
    rest = summed.select("_row", F.explode("rest").alias("r")).select("_row", "r.*").join(counts.filter(F.col("count") < least), "pair")
    added = rest.groupBy("_row").agg(
        F.sum(F.col("times") * F.col("best").cast("long")).alias("more_best"), F.sum(F.col("times") * F.col("count")).alias("more_sum")
    )
    out = aligned.join(summed.drop("rest"), "_row").join(added, "_row", "left")
    return out.select(
        key,
        "n_a",
        "n_b",
        "n_groups",
        "n_links",
        (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).alias("count_sum"),
        F.col("groups").alias("groups_sha256"),
    )
