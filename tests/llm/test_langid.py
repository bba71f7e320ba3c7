"""Language identification: held-out accuracy, mixtures, undefined texts."""

import zlib

import numpy as np
import pytest

from tidemark.llm import langid
from tidemark.llm.queries import op8_language_id


@pytest.fixture(scope="module")
def model(spark, sf):
    return langid.fit(spark.read.parquet(f"{sf}/documents.parquet"))


def test_held_out_accuracy(spark, sf):
    labels = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = op8_language_id(spark, sf).collect()
    assert sorted(r.doc_id for r in got) == sorted(labels)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert all(0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.lang_pred == labels[r.doc_id] for r in held) >= 0.95 * len(held)


def test_predictions_use_the_text_alone(spark, sf, model):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(50)
    plain = {r.text: (r.lang_pred, r.score) for r in langid.identify(docs.select("text"), model).collect()}
    other = langid.identify(docs.selectExpr("text", "-doc_id AS doc_id", "'zz' AS lang", "'q' AS SCORE"), model)
    assert other.columns == ["text", "doc_id", "lang", "lang_pred", "score", "languages"]
    assert {r.text: (r.lang_pred, r.score) for r in other.collect()} == plain


def test_two_languages_in_one_text(spark, sf, model):
    docs = spark.read.parquet(f"{sf}/documents.parquet").filter("length(text) BETWEEN 1500 AND 4000").collect()
    texts = {x: next(d.text for d in docs if d.lang == x) for x in ("en", "fr")}
    both = texts["en"][:1500] + " " + texts["fr"][:1500]
    frame = spark.createDataFrame([(both,), (texts["fr"],)], "text string")
    got = {r.text: r.languages for r in langid.identify(frame, model).collect()}
    assert {p.lang for p in got[both]} == {"en", "fr"}
    assert all(0.3 < p.share < 0.7 for p in got[both])
    assert [p.lang for p in got[texts["fr"]]] == ["fr"]


def test_undefined_texts(spark, model):
    rows = [(None,), ("",), ("123 !?",), ("́",), ("x",), ("你好",), ("the " * 200_000,)]
    got = langid.identify(spark.createDataFrame(rows, "text string"), model).collect()
    by = {r.text: r for r in got}
    for t in (None, "", "123 !?", "́"):
        assert by[t].lang_pred == "und" and by[t].score == 0 and by[t].languages == []
    for t in ("x", "你好"):
        assert by[t].lang_pred in model.languages and 0 <= by[t].score <= 1
    assert by["the " * 200_000].lang_pred == "en"


def test_no_labels(spark):
    docs = spark.createDataFrame([(1, "some text", None), (None, None, "en")], "doc_id long, text string, lang string")
    model = langid.fit(docs)
    assert model.languages == []
    assert {r.lang_pred for r in langid.identify(docs, model).collect()} == {"und"}
    assert langid.identify(docs.limit(0), model).count() == 0


def test_too_many_labels(spark):
    docs = spark.range(20).selectExpr("id AS doc_id", "'some words' AS text", "CAST(id AS string) AS lang")
    with pytest.raises(ValueError):
        langid.fit(docs, most_languages=10)


def test_sample_is_bounded(spark):
    docs = spark.range(5000).selectExpr("id AS doc_id", "concat('word ', id) AS text", "if(id % 10 = 0, 'a', 'b') AS lang")
    chosen = langid.sampled(docs, "lang", 300, [("a", 500), ("b", 4500)], docs.doc_id)
    counts = dict(chosen.groupBy("lang").count().collect())
    assert 240 < counts["a"] < 360 and 240 < counts["b"] < 360


def test_em_finds_the_proportions():
    """EM against the true mixture of two known distributions."""
    rng = np.random.default_rng(2)
    p = rng.dirichlet(np.full(langid.BUCKETS, 0.05), 3).T + 1e-9
    drawn = [rng.choice(langid.BUCKETS, n, p=p[:, k] / p[:, k].sum()) for k, n in ((0, 3000), (2, 1000))]
    bucket = np.concatenate(drawn)
    shares, single = langid.mixtures(np.log(p).astype(np.float32), np.zeros(4000, np.int64), bucket, 2, 5.0, 30)
    assert shares[0] == pytest.approx([0.75, 0, 0.25], abs=0.03)
    assert shares[1].tolist() == [0, 0, 0]
    assert single[0].argmax() == 0
