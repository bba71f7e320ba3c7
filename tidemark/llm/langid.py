"""Language identification as inference of a mixture of languages.

A document is a bag of hashed letter trigrams drawn from a mixture of language models.
Expectation-maximisation estimates the proportions; languages enter in the order of
their proportions as long as the likelihood grows by more than a penalty.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.bpe import slices, with_column, without
from tidemark.llm.words import LETTER, MARK, codepoints, pieces, simple_lower, unicode_classes

BUCKETS = 1 << 15
NO_LANGUAGE = "und"


@dataclass
class Model:
    """Learned language names in code point order, and log P(trigram bucket | language)."""

    languages: list[str]
    log_p: np.ndarray


def trigrams(parts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Part and bucket of each letter trigram, and which parts hold a letter.

    Lower case; each run of other characters is one blank, and parts begin and end with one.
    """
    codes, bounds = codepoints([f" {p} " for p in parts])
    kinds = unicode_classes()[codes]
    letter = (kinds == LETTER) | (kinds == MARK)
    has = np.zeros(len(parts), bool)
    part = np.repeat(np.arange(len(parts)), np.diff(bounds))
    has[part[kinds == LETTER]] = True
    keep = letter.copy()
    keep[0] = True
    keep[1:] |= letter[:-1] | (part[1:] != part[:-1])
    symbols = np.where(letter, simple_lower()[codes], 32)[keep].astype(np.uint64)
    part = part[keep]
    a, b, c = symbols[:-2], symbols[1:-1], symbols[2:]
    whole = (part[2:] == part[:-2]) & (b != 32)
    h = (a[whole] * np.uint64(0x1F123BB5) + b[whole]) * np.uint64(0x9E3779B97F4A7C15) + c[whole]
    h *= np.uint64(0xD6E8FEB86659FD93)
    return part[2:][whole], (h >> np.uint64(49)).astype(np.int64), has


def sampled(docs: DataFrame, lang: str, rows: int, languages: list[tuple[str, int]], key: Column) -> DataFrame:
    """About ``rows`` rows of each language, chosen by a hash of the key."""
    share = F.lit(1.0)
    for name, n in languages:
        share = F.when(F.col(lang) == name, F.lit(min(1.0, rows / n))).otherwise(share)
    return docs.filter(F.pmod(F.xxhash64(key), F.lit(1 << 30)) < share * (1 << 30))


def fit(
    docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", rows: int = 2000, most_languages: int = 1000, smooth: float = 0.5
) -> Model:
    """Learn trigram frequencies from rows with a text and a language.

    Learns from a sample of about ``rows`` documents a language (all, where there are
    fewer), whole texts. The model has ``BUCKETS`` numbers a language and is all that
    reaches the driver; more than ``most_languages`` names are an error. Without a
    labelled row the model has no language.
    """
    labelled = docs.filter(F.col(text).isNotNull() & F.col(lang).isNotNull())
    counts = labelled.groupBy(lang).count().limit(most_languages + 1).collect()
    if len(counts) > most_languages:
        raise ValueError(f"more than {most_languages} languages")
    languages = sorted((r[0], r[1]) for r in counts)
    chosen = sampled(labelled, lang, rows, languages, F.col(key)).select(F.col(text).alias("t"), F.col(lang).alias("l"))

    def count(batches):
        found: dict[str, np.ndarray] = {}
        for batch in slices(batches, 0):
            names = batch.column(1).to_pylist()
            for parts, owner in pieces(batch.column(0).to_pylist()):
                part, bucket, _ = trigrams(parts)
                which, unique = pd.factorize(np.array([names[k] for k in owner], object))
                for w, name in enumerate(unique):
                    add = np.bincount(bucket[which[part] == w], minlength=BUCKETS)
                    found[name] = found.get(name, 0) + add
        for name, n in found.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_pydict({"l": [name] * len(at), "bucket": at.astype(np.int32), "n": n[at]})

    table = chosen.mapInArrow(count, "l string, bucket int, n long").groupBy("l", "bucket").agg(F.sum("n").alias("n")).toArrow()
    names = sorted(set(table["l"].to_pylist()))
    n = np.zeros((BUCKETS, len(names)))
    row = pd.Index(names).get_indexer(table["l"].to_pandas()) if names else np.empty(0, int)
    n[table["bucket"].to_numpy(), row] = table["n"].to_numpy()
    p = (n + smooth) / (n.sum(axis=0) + smooth * BUCKETS)
    return Model(names, np.log(p).astype(np.float32))


def mixtures(
    log_p: np.ndarray, doc: np.ndarray, bucket: np.ndarray, docs: int, penalty: float, rounds: int
) -> tuple[np.ndarray, np.ndarray]:
    """Proportions over the chosen language set of each document, and the single-language
    log likelihoods. Ties go to the first language.
    """
    size = log_p.shape[1]
    which, unique = pd.factorize(doc * BUCKETS + bucket)
    n = np.bincount(which, minlength=len(unique)).astype(np.float32)
    owner = unique // BUCKETS
    rows = log_p[unique % BUCKETS]
    single = np.zeros((docs, size))
    shares = np.zeros((docs, size))
    some, heads = np.unique(owner, return_index=True)
    if not len(some):
        return shares, single
    single[some] = np.add.reduceat(rows * n[:, None], heads)
    total = np.add.reduceat(n, heads)
    slot = np.repeat(np.arange(len(some)), np.diff(np.append(heads, len(owner))))
    # Each row counts relative to its best language, so that no probability underflows.
    top = rows.max(axis=1)
    p = np.exp(rows - top[:, None])
    base = np.add.reduceat(n * top, heads)

    def estimate(chosen: np.ndarray, start: np.ndarray):
        """EM over the documents ``chosen`` from the proportions ``start``."""
        mine = np.zeros(len(some), bool)
        mine[chosen] = True
        r = np.flatnonzero(mine[slot])
        new = np.cumsum(mine) - 1
        s = new[slot[r]]
        pr, nr = p[r], n[r]
        at = np.flatnonzero(np.append(True, s[1:] != s[:-1]))
        pi = start
        for _ in range(rounds):
            w = pr * pi[s]
            w *= (nr / w.sum(axis=1))[:, None]
            pi = (np.add.reduceat(w, at) / total[chosen][:, None]).astype(np.float32)
        like = np.add.reduceat(nr * np.log((pr * pi[s]).sum(axis=1)), at) + base[chosen]
        return pi, like

    everyone = np.arange(len(some))
    mixed, _ = estimate(everyone, np.full((len(some), size), 1 / size, np.float32))
    rank = np.argsort(-mixed, axis=1, kind="stable")
    best = single[some].argmax(axis=1)
    out = np.zeros((len(some), size))
    out[everyone, best] = 1
    reached = single[some].max(axis=1)
    price = penalty * np.log1p(total)
    active = everyone
    for k in range(2, size + 1):
        start = np.full((len(active), size), 0, np.float32)
        np.put_along_axis(start, rank[active, :k], np.float32(1 / k), axis=1)
        pi, like = estimate(active, start)
        better = like - reached[active] > price[active]
        active = active[better]
        if not len(active):
            break
        out[active], reached[active] = pi[better], like[better]
    shares[some] = out
    return shares, single


def identify(
    docs: DataFrame, model: Model, text: str = "text", lang: str = "lang_pred", score: str = "score", parts: str = "languages", penalty: float = 5.0, rounds: int = 10
) -> DataFrame:
    """Adds the main language, its score from 0 to 1, and the languages with their shares.

    The score is the language's share of the text; where one language is chosen, its
    probability against each other language alone. A null text, one without a letter, and
    any text under a model without languages are ``und`` with score 0 and no shares. Whole
    texts are read; nothing is shuffled. Columns of these names are replaced.
    """
    docs = without(docs, lang, score, parts)
    at = docs.columns.index(text)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        known = shared.value
        size = len(known.languages)
        for batch in slices(batches, at):
            texts = [t or "" for t in batch.column(at).to_pylist()]
            answers = []
            for some in _by_size(texts):
                answers += _answer(known, some, size, penalty, rounds)
            kind = pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())]))
            yield with_column(
                batch,
                [lang, score, parts],
                [pa.array([a[0] for a in answers], pa.string()), pa.array([a[1] for a in answers], pa.float64()), pa.array([a[2] for a in answers], kind)],
            )

    share = T.StructType([T.StructField("lang", T.StringType()), T.StructField("share", T.DoubleType())])
    schema = T.StructType(
        [*docs.schema, T.StructField(lang, T.StringType()), T.StructField(score, T.DoubleType()), T.StructField(parts, T.ArrayType(share))]
    )
    return docs.mapInArrow(run, schema)


def _by_size(texts: list[str], size: int = 600_000):
    out: list[str] = []
    total = 0
    for t in texts:
        out.append(t)
        total += len(t)
        if total >= size:
            yield out
            out, total = [], 0
    if out:
        yield out


def _answer(model: Model, texts: list[str], size: int, penalty: float, rounds: int) -> list[tuple]:
    docs, grams, has = [], [], np.zeros(len(texts), bool)
    for parts, owner in pieces(texts):
        part, bucket, letters = trigrams(parts)
        owner = np.array(owner)
        docs.append(owner[part])
        grams.append(bucket)
        np.logical_or.at(has, owner, letters)
    if not size or not has.any():
        return [(NO_LANGUAGE, 0.0, [])] * len(texts)
    shares, single = mixtures(model.log_p, np.concatenate(docs), np.concatenate(grams), len(texts), penalty, rounds)
    out = []
    for k in range(len(texts)):
        if not has[k]:
            out.append((NO_LANGUAGE, 0.0, []))
            continue
        mine = shares[k] if shares[k].any() else np.eye(size)[0]
        best = int(mine.argmax())
        order = [int(i) for i in np.argsort(-mine, kind="stable") if mine[i] > 0]
        sure = float(mine[best])
        if len(order) == 1:
            odds = np.exp((single[k] - single[k][best]) / 3)  # a letter is in three trigrams
            sure = float(1 / odds.sum())
        out.append((model.languages[best], min(1.0, sure), [{"lang": model.languages[i], "share": float(mine[i])} for i in order]))
    return out
