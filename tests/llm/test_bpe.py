"""BPE against the tokenizers library, and its column operators."""

import hashlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import bpe
from tidemark.llm.queries import op10_bpe
from tidemark.llm.words import codepoints, pieces, word_hashes

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["'", "s", "t", "re", "ve", "ll", " ", "  ", "\n", "\t", "a", "Z", "12", "!", "é", "é", "你好", " ", "\x1c",
       "\u0085", "<|endoftext|>", "<|", "\r\n", "😀", "aaaa", "'S", "٣", "½", "​"]


@pytest.fixture(scope="module")
def vocab():
    return bpe.load(PATH)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def expected(library, texts):
    return [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.lists(st.sampled_from(ODD), max_size=30).map("".join), st.text(max_size=30)), max_size=8))
def test_encode_and_decode_equal_the_library(vocab, library, texts):
    got = bpe.Encoder(vocab)(texts)
    assert [a.tolist() for a in got] == expected(library, texts)
    assert bpe.decode_ids(vocab, got) == [library.decode(i, skip_special_tokens=False) for i in expected(library, texts)]


def test_long_texts_are_cut_without_a_trace(vocab, library, monkeypatch):
    text = " ".join(f"word{k} it's  <|endoftext|>\n\n don't {'x' * (k % 40)}" for k in range(400))
    monkeypatch.setattr("tidemark.llm.words.pieces.__defaults__", (64,))
    assert len(list(pieces([text]))) > 100
    assert bpe.Encoder(vocab)([text, "", text])[2].tolist() == expected(library, [text])[0]


def test_one_word_of_many_letters(vocab, library):
    text = "ab" * 20_000 + "é" * 500
    assert bpe.Encoder(vocab)([text])[0].tolist() == expected(library, [text])[0]


def thue_morse(n):
    """A word and its complement, on which polynomial hashes modulo 2**64 agree."""
    bits = [bin(k).count("1") % 2 for k in range(n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


def test_words_with_one_key_are_told_apart(vocab, library):
    one, other = thue_morse(2048)
    codes, bounds = codepoints([one, other])
    keys = word_hashes(codes, bounds[:-1], bounds[1:])
    assert keys[0] == keys[1]
    texts = [one, other, f"x {other} {one} y"]
    for chosen in (texts, texts[::-1], texts[1:]):
        encoder = bpe.Encoder(vocab)
        for _ in range(2):
            assert [a.tolist() for a in encoder(chosen)] == expected(library, chosen)


def test_a_full_word_table_starts_anew(vocab, library):
    encoder = bpe.Encoder(vocab)
    encoder.table.most = 5
    texts = [f"some{k} other{k} words{k} and{k} more" for k in range(20)]
    for _ in range(2):
        for t in texts:
            assert encoder([t])[0].tolist() == expected(library, [t])[0]
    assert len(encoder.table.keys) <= 6


def test_special_strings_as_ordinary_text(vocab, library):
    text = "a <|endoftext|> b"
    library.encode_special_tokens = True
    want = expected(library, [text])[0]
    library.encode_special_tokens = False
    assert bpe.Encoder(vocab, special=False)([text])[0].tolist() == want
    assert 50256 not in want


def test_bytes_that_are_not_utf8(vocab):
    half = bpe.Encoder(vocab)(["é"])[0]
    whole = bpe.decode_ids(vocab, [half])[0]
    assert whole == "é"
    assert bpe.decode_ids(vocab, [vocab.first[[0xC3]].astype(np.uint32)]) == ["�"]


def test_columns(spark, vocab, library):
    rows = [(1, "it's", "x", 9), (1, "it's", "x", 9), (2, None, None, None), (None, "", "y", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, IDS string, n_tokens int")
    out = bpe.decode(bpe.encode(docs, vocab), vocab)
    at_once = bpe.encode(docs, vocab, decoded="decoded")
    assert at_once.columns == out.columns and sorted(at_once.collect(), key=str) == sorted(out.collect(), key=str)
    assert out.columns == ["doc_id", "text", "ids", "n_tokens", "decoded"]
    got = sorted([(r.doc_id, bytes(r.ids), r.n_tokens, r.decoded) for r in out.collect()], key=str)
    ids = np.array(expected(library, ["it's"])[0], "<u4").tobytes()
    assert got == sorted([(1, ids, 2, "it's")] * 2 + [(2, b"", 0, ""), (None, b"", 0, "")], key=str)
    assert bpe.encode(docs.limit(0), vocab).count() == 0


def test_query_equals_the_library(spark, sf, library):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    want = {}
    for r in docs:
        ids = expected(library, [r.text or ""])[0]
        raw = np.array(ids, "<u4").tobytes()
        text = library.decode(ids, skip_special_tokens=False)
        want[r.doc_id] = (len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in op10_bpe(spark, sf).collect()}
    assert got == want


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError):
        bpe.load(public_tokenizers.path("word_bpe_49k.json"))


def test_nothing_is_shuffled(spark, sf, vocab):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    plan = bpe.decode(bpe.encode(docs, vocab), vocab).select(F.sha2("ids", 256))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
