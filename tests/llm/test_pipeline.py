"""The pipeline stage by stage, and all of it, against plain Python."""

import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from tidemark.llm import mixing

from test_near_copies import grams, jaccard, linked

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def test_registered():
    assert entry.queries()["pipeline"] is corpus_pipeline.run
    assert "pipeline" not in entry.oracle_sql()
    assert {n for n in entry.queries() if n.startswith("op") and n[2].isdigit()} == set(
        "op1_ngram_jaccard_join op2_embedding_near_dedup op3_url_filters op4_token_id_files op5_token_counts "
        "op6_mixing op7_warc op8_language_id op9_nearest_neighbours op10_bpe op11_decontamination op12_alignment op13_collocations".split()
    )


def test_language_stage_keeps_clean_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    junk = spark.createDataFrame([(-1, "12 34 -- !!", "en", "src0", 11), (-2, None, "en", "src0", 0), (-3, "", None, None, 0)], COLUMNS)
    out = corpus_pipeline.by_language(spark, docs.unionByName(junk), sf)
    assert out.columns == docs.columns
    kept = {r.doc_id for r in out.collect()}
    assert kept == {r.doc_id for r in docs.collect()}


@pytest.mark.parametrize("languages", [2, 10])
def test_language_stage_does_not_depend_on_the_number_of_languages(spark, sf, languages):
    """A short text that fits all languages and a text in all of them stay; ``und`` goes."""
    rng = random.Random(6)
    words = [["".join(rng.choice("abcdefghijklmnopqrstuvwxyz"[2 * k : 2 * k + 6]) for _ in range(5)) for _ in range(60)] for k in range(languages)]
    rows = [(100 * k + n, " ".join(rng.choices(words[k], k=40)) + " taxi", f"l{k}", "s", 0) for k in range(languages) for n in range(20)]
    rows += [(-1, "taxi", None, "s", 4), (-2, " ".join(w for some in words for w in some), None, "s", 0), (-3, "12 34", None, "s", 5)]
    out = corpus_pipeline.by_language(spark, spark.createDataFrame(rows, COLUMNS), sf)
    assert {r.doc_id for r in out.collect()} == {r[0] for r in rows} - {-3}


def test_one_document_of_each_group_stays(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    _, roots = linked([grams(t) for _, t in rows], jaccard)
    out = corpus_pipeline.one_of_each(spark, docs, sf)
    assert out.columns == docs.columns
    assert sorted(r.doc_id for r in out.collect()) == sorted({rows[r][0] for r in roots})


def test_mixture_repeats_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = corpus_pipeline.mixed(spark, docs, sf)
    assert out.columns == docs.columns
    want = {r.doc_id: r.copies for r in mixing.plan_mix(docs).collect() if r.copies}
    got = {}
    for r in out.collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + 1
    assert got == want and set(want.values()) == {1, 2}


def test_tokens_of_all_rows(spark, sf):
    rows = [(1, "it's so", "en", "a", 7), (1, "it's so", "en", "a", 7), (None, None, None, None, None)]
    got = corpus_pipeline.as_tokens(spark, spark.createDataFrame(rows, COLUMNS), sf).collect()
    ids = Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.VOCABULARY)).encode("it's so", add_special_tokens=False).ids
    assert sorted((r.doc_id or 0, np.frombuffer(bytes(r.ids), "<u4").tolist(), r.exact) for r in got) == [(0, [], True), (1, ids, True), (1, ids, True)]


def test_whole_pipeline(spark, sf):
    out = corpus_pipeline.run(spark, sf).collect()
    rows = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect())
    _, roots = linked([grams(t) for _, t in rows], jaccard)
    kept = {rows[r][0] for r in roots}
    assert {r.doc_id for r in out} <= kept and len({r.doc_id for r in out}) > 0.6 * len(kept)
    text = dict(rows)
    tokenizer = Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.VOCABULARY))
    for r in random.Random(1).sample(out, 30):
        assert r.exact and r.n_tokens == len(tokenizer.encode(text[r.doc_id], add_special_tokens=False).ids)


@pytest.mark.parametrize("stage", [f for _, f in corpus_pipeline.STAGES])
def test_stages_take_empty_tables(spark, sf, stage):
    assert stage(spark, spark.createDataFrame([], COLUMNS), sf).count() == 0
