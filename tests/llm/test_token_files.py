"""Wavelet shards and flat token files against plain arrays and the tokenizers library."""

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidemark.llm import separators, tokenids, wavelet
from tidemark.llm.queries import op4_token_id_files, op5_token_counts

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = ["'", "s", "re", "LL", " ", "\n", "a", "Z", "12", "!", "é", "é", "́", "你好", "<|endoftext|>", "😀", "aaaa",
       "İ", "Σ", "가", "\x00", "\x01", "Å"]


@pytest.fixture(scope="module")
def library():
    return tokenids.load(PATH)


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def expected(tokenizer, texts):
    return [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.lists(st.sampled_from(ODD), max_size=30).map("".join), st.text(max_size=30)), max_size=8))
def test_encoding_equals_the_library(library, tokenizer, texts):
    got = tokenids.LibraryEncoder(library)(texts)
    assert [a.tolist() for a in got] == expected(tokenizer, texts)


def test_words_with_one_key_are_told_apart(library, tokenizer):
    bits = [bin(k).count("1") % 2 for k in range(2048)]
    one, other = "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)
    encoder = tokenids.LibraryEncoder(library)
    for texts in ([one, other], [other], [f"z {one}", f"z {other} é́"]):
        assert [a.tolist() for a in encoder(texts)] == expected(tokenizer, texts)


def test_any_tokenizer_file_is_encoded_whole():
    other = tokenids.load(public_tokenizers.path("byte_bpe_50k.json"))
    assert other.kinds is None
    want = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert tokenids.LibraryEncoder(other)(["it's  so"])[0].tolist() == expected(want, ["it's  so"])[0]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 70_000), min_size=1, max_size=300), st.data())
def test_wavelet_access_count_locate(ids, data):
    array = np.array(ids, np.uint32)
    shard = wavelet.Shard(pa.BufferReader(wavelet.pack(array, [5], [len(ids)])))
    assert shard.all().tolist() == ids
    i = data.draw(st.integers(0, len(ids) - 1))
    lo, hi = sorted(data.draw(st.tuples(st.integers(0, len(ids)), st.integers(0, len(ids)))))
    token = ids[i]
    where = np.flatnonzero(array == token)
    assert shard.access(i) == token
    assert shard.count(token) == len(where)
    assert shard.count(token, lo, hi) == int((array[lo:hi] == token).sum())
    assert [shard.locate(token, k) for k in range(len(where))] == where.tolist()
    assert shard.count(1 << 20) == 0
    with pytest.raises(IndexError):
        shard.locate(token, len(where))


def test_wavelet_over_many_blocks():
    array = np.random.default_rng(1).integers(0, 5, 3 * wavelet.BLOCK + 17).astype(np.uint32)
    shard = wavelet.Shard(pa.BufferReader(wavelet.pack(array, [None, 3], [7, len(array) - 7])), most_blocks=2)
    where = np.flatnonzero(array == 3)
    assert shard.keys == [None, 3] and shard.lengths.tolist() == [7, len(array) - 7]
    for k in (0, 1, len(where) // 2, len(where) - 1):
        assert shard.locate(3, k) == where[k] and shard.access(int(where[k])) == 3
    assert (shard.all() == array).all()


def test_an_empty_shard():
    shard = wavelet.Shard(pa.BufferReader(wavelet.pack(np.empty(0, np.uint32), [4], [0])))
    assert shard.n == 0 and shard.all().tolist() == [] and shard.count(0) == 0 and shard.keys == [4]


@pytest.mark.parametrize("width", [2, 4])
def test_shards_keep_order_nulls_and_repeated_rows(spark, library, tokenizer, width):
    rows = [(3, "c d e", 1), (1, "a b", 1), (None, "n", 1), (2, None, 1), (2, "", 1), (1, "a b", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start int")
    encoded = tokenids.encode(docs, library, 1, width=width)
    index = tokenids.write_shards(encoded, shard_tokens=4, width=width)
    got = sorted((r.start, r.doc_id, r.n_tokens, bytes(r.ids)) for r in tokenids.read_shards(index).collect())
    assert [g[1] for g in got] == [None, 1, 1, 2, 2, 3]
    texts = ["n", "a b", "a b", "", "", "c d e"]
    want = [np.array([*i, 1], "<u4").tobytes() for i in expected(tokenizer, texts)]
    assert [g[3] for g in got] == want
    assert [g[0] for g in got] == np.cumsum([0, *(g[2] for g in got)])[:-1].tolist()
    assert all(r.n_tokens <= 4 + 4 for r in index.collect())
    empty = tokenids.write_shards(encoded.limit(0), width=width)
    assert tokenids.read_shards(empty).count() == 0


def test_query_of_shards(spark, sf, tokenizer):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    start, want = 0, {}
    for r in docs:
        ids = np.array([*expected(tokenizer, [r.text or ""])[0], 1], "<u4")
        want[r.doc_id] = (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert {r.doc_id: tuple(r[1:]) for r in op4_token_id_files(spark, sf).collect()} == want


def flat_file(tmp_path, name, ids, width=2, extra=b""):
    path = str(tmp_path / name)
    with open(path, "wb") as f:
        f.write(np.array(ids, separators.KINDS[width]).tobytes() + extra)
    return path


@pytest.mark.parametrize("block", [2, 6, 8, 1 << 20])
def test_documents_span_blocks(spark, tmp_path, block):
    files = {
        flat_file(tmp_path, "a", [1, 2, 0, 3, 4, 5, 6, 7, 8, 9, 0, 0, 1, 0]): [(0, 2, True), (1, 7, True), (2, 0, True), (3, 1, True)],
        flat_file(tmp_path, "b", [5, 0, 6, 6, 6], extra=b"\x07"): [(0, 1, True), (1, 3, False)],
        flat_file(tmp_path, "c", []): [],
        flat_file(tmp_path, "d", [1, 2, 3, 4, 5]): [(0, 5, False)],
    }
    frame = spark.createDataFrame([(p, 1) for p in [*files, *files]], "path string, block int")
    got = {}
    for r in separators.count_tokens(frame, 0, 2, block).collect():
        got.setdefault(r.path, []).append((r.place, r.n_tokens, r.ended))
    assert {p: sorted(v) for p, v in got.items()} == {p: v for p, v in files.items() if v}


def test_flat_files_round_trip(spark):
    raw = lambda *ids: np.array(ids, "<u4").tobytes()
    rows = [(1, raw(7, 8)), (2, raw()), (3, None), (None, raw(70_000)), (1, raw(7, 8))]
    frame = spark.createDataFrame(rows, "doc_id long, ids binary").repartition(2)
    written = separators.write_flat(frame, 99, width=4)
    counts = separators.count_tokens(written, 99, width=4, block_bytes=4)
    got = sorted((str(r.doc_id), r.n_tokens) for r in written.join(counts, ["path", "place"]).collect())
    assert got == sorted([("1", 2), ("1", 2), ("2", 0), ("3", 0), ("None", 1)])
    with pytest.raises(Exception, match="does not fit"):
        separators.write_flat(frame, 99, width=2)
    assert separators.write_flat(frame.limit(0), 99).count() == 0


def test_query_of_separators(spark, sf):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    want = {r.doc_id: len(expected(tokenizer, [r.text or ""])[0]) for r in docs}
    assert {r.doc_id: r.n_tokens for r in op5_token_counts(spark, sf).collect()} == want
