"""Alignment against all pairs of overlapping byte ranges, from the libraries' own ids."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidemark.llm import align, bpe
from tidemark.llm.queries import op12_alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = ["the", " and", "  ", "\n", "\t", "é", "你好", "<|endoftext|>", "<s>", "<0x41>", "▁", "😀", "Ġ", "it's", " 2024", "\x00", "ab" * 9]


@pytest.fixture(scope="module")
def vocab():
    return bpe.load(A)


@pytest.fixture(scope="module")
def pieces():
    return align.load_pieces(B)


@pytest.fixture(scope="module")
def library():
    one, two = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    one.encode_special_tokens = True
    byte_of = {c: k for k, c in enumerate(bpe.byte_symbols())}

    def ids(text):
        """Ids with their bytes by both; none where they do not give the text back."""
        a = one.encode(" " + text, add_special_tokens=False).ids
        b = two.encode(text)
        a = [(i, bytes(byte_of[c] for c in one.id_to_token(i))) for i in a]
        b = [(i, bytes([int(two.id_to_piece(i)[3:5], 16)]) if two.is_byte(i) else two.id_to_piece(i).replace("▁", " ").encode()) for i in b]
        want = (" " + text).encode()
        same = text and want == b"".join(x for _, x in a) == b"".join(x for _, x in b)
        return (a, b) if same else ([], [])

    return ids


def ranges(tokens):
    out, at = [], 0
    for i, data in tokens:
        out.append((i, at, at + len(data)))
        at += len(data)
    return out


def brute(library, text):
    """(n_a, n_b, groups as text, links) of one text, by comparing all pairs of ranges."""
    a, b = (ranges(x) for x in library(text or ""))
    links = [(i, j) for i, s, e in a for j, t, f in b if max(s, t) < min(e, f)]
    shared = sorted({e for _, _, e in a} & {f for _, _, f in b})
    shown, low = [], 0
    for high in shared:
        part = ["".join(",".join(str(i) for i, s, e in x if low <= s and e <= high)) for x in (a, b)]
        shown.append("|".join(part))
        low = high
    return len(a), len(b), ";".join(shown), links


def check(aligner, library, texts):
    got = aligner(texts)
    wide = aligner.wide
    ends = np.cumsum(got["n_links"])
    for k, text in enumerate(texts):
        n_a, n_b, shown, links = brute(library, text)
        mine = got["links"][ends[k] - got["n_links"][k] : ends[k]]
        assert (got["n_a"][k], got["n_b"][k], got["shown"][k]) == (n_a, n_b, shown)
        assert got["n_groups"][k] == (shown.count(";") + 1 if shown else 0)
        assert Counter(divmod(int(x), wide) for x in mine) == Counter(links)


@pytest.fixture(scope="module")
def aligner(vocab, pieces):
    return align.Aligner(vocab, pieces)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.lists(st.sampled_from(ODD), max_size=12).map("".join), st.text(max_size=30)), max_size=6))
def test_equals_all_pairs(aligner, library, texts):
    check(aligner, library, texts)


def test_windows_are_kept_and_forgotten(vocab, pieces, library):
    few = align.Aligner(vocab, pieces, most=4, longest=2)
    texts = [f"some words{k} and the other {'x' * k}" for k in range(12)]
    for _ in range(2):
        for t in texts:
            check(few, library, [t, "", t])
    many = align.Aligner(vocab, pieces)
    many(texts)
    before = len(many.shown)
    many(texts)
    assert len(many.shown) == before and before < sum(len(t.split()) for t in texts)


def test_a_long_text_without_blanks(aligner, library):
    check(aligner, library, ["你好世界" * 200, "a" * 999])


def expected(library, rows):
    found = [(key, *brute(library, text)) for key, text in rows]
    count = Counter(pair for *_, links in found for pair in set(links))
    most = defaultdict(int)
    for (i, _), n in count.items():
        most[i] = max(most[i], n)
    out = []
    for key, n_a, n_b, shown, links in found:
        digest = hashlib.sha256(shown.encode()).hexdigest() if shown else ""
        n_best = sum(count[p] == most[p[0]] for p in links)
        out.append((key, n_a, n_b, shown.count(";") + 1 if shown else 0, len(links), n_best, sum(count[p] for p in links), digest))
    return sorted(out, key=str)


@pytest.mark.parametrize("held", [1 << 20, 20, 0])
def test_rows_nulls_and_other_columns(spark, vocab, pieces, library, held):
    rows = [(1, "the cat and the dog"), (1, "the cat and the dog"), (2, None), (None, ""), (3, "The dogs' tokenisation ▁"),
            (4, "  the\n\ncat<s>"), (5, "the " * 3000), (None, "tokenisation of the dog")]
    docs = spark.createDataFrame([(k, t, 1, "x") for k, t in rows], "doc_id long, text string, pairs int, _ROW string")
    got = align.score(docs, vocab, pieces, held=held)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted([tuple(r) for r in got.collect()], key=str) == expected(library, rows)
    assert align.score(docs.limit(0), vocab, pieces, held=held).count() == 0


def test_groups_as_text(spark, vocab, pieces, library):
    docs = spark.createDataFrame([(1, "unbelievable tokenisation")], "doc_id long, text string")
    assert align.align(docs, vocab, pieces).first()["groups"] == brute(library, "unbelievable tokenisation")[2]


def test_query_equals_brute_force(spark, sf, library):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    short = [r for r in rows if len(r[1] or "") < 4000]
    got = {r.doc_id: tuple(r) for r in op12_alignment(spark, sf).collect()}
    assert len(got) == len(rows)
    for key, text in short[:60]:
        n_a, n_b, shown, links = brute(library, text)
        assert got[key][1:5] == (n_a, n_b, shown.count(";") + 1 if shown else 0, len(links))
        assert got[key][7] == (hashlib.sha256(shown.encode()).hexdigest() if shown else "")


def test_counts_over_the_corpus(spark, sf, vocab, pieces, library):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    rows = sorted(rows, key=lambda r: len(r[1] or ""))[:50]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for held in (1 << 20, 200):
        assert sorted([tuple(r) for r in align.score(docs, vocab, pieces, held=held).collect()], key=str) == expected(library, rows)
