"""From raw documents to token ids: language, near duplicates, mixture, BPE."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, langid, mixing, ngrams
from tidemark.session import fresh_path

VOCABULARY = "byte_bpe_50k.json"


def by_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that have a language; only ``und`` goes: no text, or none with a letter.

    The model learns from the labelled documents of its input. The score does not decide:
    it falls with the number of languages that fit a text, also for short clean texts and
    texts in many languages.
    """
    model = langid.fit(docs)
    found = langid.identify(docs, model, lang="_lang", score="_score", parts="_parts")
    return found.filter(F.col("_lang") != langid.NO_LANGUAGE).select(*[F.col(f"`{c}`") for c in docs.columns])


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each near-duplicate class (five words, similarity 0.8)."""
    return ngrams.without_duplicates(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources in their target shares; a document taken twice is two rows."""
    return mixing.mix(docs)


def as_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each row, checked by decoding: doc_id, source, n_tokens, ids, exact."""
    vocab = bpe.load(public_tokenizers.path(VOCABULARY))
    texts = docs.select("doc_id", "source", F.coalesce("text", F.lit("")).alias("text"))
    coded = bpe.encode(texts, vocab, decoded="decoded")
    return coded.select("doc_id", "source", "n_tokens", "ids", (F.col("decoded") == F.col("text")).alias("exact"))


STAGES = [("language ID", by_language), ("n-gram Jaccard join", one_of_each), ("mixing", mixed), ("BPE", as_tokens)]

# Learned proportions, MinHash and merges are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        done = stage(spark, docs, sf_dir)
        if k == len(STAGES) - 1:
            return done
        path = fresh_path(spark, "stage")
        done.write.parquet(path)
        docs = spark.read.parquet(path)
    raise ValueError("no stages")
