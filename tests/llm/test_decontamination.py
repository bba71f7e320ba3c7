"""Decontamination against a scan of every window of every item over every document."""

import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import bytewords, decontaminate
from tidemark.llm.queries import op11_decontamination

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS, ITEMS = "doc_id long, text string, item_id int, n_words string, row int", "item_id string, text string, words int"


def words(text):
    return WORD.findall((text or "").translate(AZ))


def expected(docs, items, window=10):
    """(key, n_words, n_hit, items) of each document, by brute force."""
    windows = set()
    for key, text in items:
        w = words(text)
        n = min(window, len(w))
        windows |= {(str(key) if key is not None else "", tuple(w[p : p + n])) for p in range(len(w) - n + 1) if n}
    out = []
    for key, text in docs:
        w = words(text)
        hit, held = set(), set()
        for item, phrase in windows:
            for p in range(len(w) - len(phrase) + 1):
                if tuple(w[p : p + len(phrase)]) == phrase:
                    hit |= set(range(p, p + len(phrase)))
                    held.add(item)
        out.append((key, len(w), len(hit), sorted(held, key=str.encode)))
    return sorted(out, key=str)


def judged(spark, docs, items, **how):
    left = spark.createDataFrame([(k, t, 7, "x", 3) for k, t in docs], DOCS)
    right = spark.createDataFrame([(None if k is None else str(k), t, 5) for k, t in items], ITEMS)
    got = decontaminate.judge(left, right, **how)
    assert got.columns == ["doc_id", "n_words", "n_hit", "n_items", "items"]
    rows = got.collect()
    assert all(r.n_items == len(r["items"]) for r in rows)
    return sorted([(r.doc_id, r.n_words, r.n_hit, r["items"]) for r in rows], key=str)


LONG = " ".join(f"w{k % 97}" for k in range(40))
CASES = [
    [(1, "The QUICK brown-fox"), (1, "The QUICK brown-fox"), (2, None), (None, ""), (3, "quick, brown fox"), (4, "brown quick")],
    [(5, f"x {LONG} y {LONG.upper()}"), (6, LONG[:-4]), (7, " ".join(LONG.split()[:9])), (8, "ÉCOLE école éCOLE 你好 the the the the")],
    [(9, "a " * 30), (10, "a a a"), (None, "  the the  "), (11, "\x00\x01 a\x00b")],
]
ITEMS_ROWS = [
    [(1, "quick brown"), (2, "quick brown fox"), (10, "Quick"), (None, "brown"), (3, None), (4, "?!"), (1, "fox")],
    [(1, LONG), (2, LONG), ("b", " ".join(LONG.split()[5:16])), (3, "école 你好"), (4, "the the the"), (5, "absent words here")],
    [(1, "a a a a"), (2, "a " * 12), (3, "the the"), (4, "b")],
]


@pytest.mark.parametrize("shingle", [1, 4])
@pytest.mark.parametrize("docs, items", list(zip(CASES, ITEMS_ROWS)))
def test_equals_brute_force(spark, docs, items, shingle):
    assert judged(spark, docs, items, shingle=shingle) == expected(docs, items)


def test_random_texts_over_few_words(spark):
    rng = np.random.default_rng(5)
    text = lambda most: " ".join(rng.choice(["a", "b", "C", "d1"], rng.integers(0, most)))
    docs = [(k, text(80)) for k in range(40)]
    items = [(k, text(9)) for k in range(15)]
    for window in (3, 6):
        assert judged(spark, docs, items, window=window, shingle=2) == expected(docs, items, window)


def test_empty_tables(spark):
    assert judged(spark, [], [(1, "a b")]) == []
    assert judged(spark, [(1, "a b")], []) == [(1, 2, 0, [])]
    assert judged(spark, [(1, None)], [(1, "?")]) == [(1, 0, 0, [])]


def test_very_long_words_and_texts(spark):
    giant = "x" * 300_000
    docs = [(1, f"{giant} one two three {giant}"), (2, "one two three " * 20_000)]
    assert judged(spark, docs, [(1, "one two three"), (2, f"{giant} one")]) == [
        (1, 5, 4, ["1", "2"]),
        (2, 60_000, 60_000, ["1"]),
    ]


def test_places_and_bounds(spark):
    docs = spark.createDataFrame([(1, "b c a b c d")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b c"), (2, "c d e")], "item_id long, text string")
    _, hits, holders = decontaminate.find_windows(docs, items, window=3)
    assert [(r.start, r.n) for r in hits.collect()] == [(2, 3)]
    assert {r.item for r in hits.join(holders, "window").collect()} == {"1"}


def test_filters_miss_no_key_and_stay_small(spark, monkeypatch):
    keys = np.random.default_rng(2).integers(-(1 << 63), 1 << 63, 5000)
    table = spark.createDataFrame([(int(k),) for k in keys], "key long")
    built = bytewords.filter_of(table, "key")
    assert built.has(keys).all()
    others = np.random.default_rng(3).integers(-(1 << 63), 1 << 63, 5000)
    assert built.has(others).mean() < 0.05
    monkeypatch.setattr(bytewords, "MOST_BITS", 16)
    full = bytewords.filter_of(table, "key")
    assert len(full.words) == 1 << 10 and full.has(keys).all()


def test_a_full_filter_changes_nothing(spark, monkeypatch):
    monkeypatch.setattr(bytewords, "LEAST_BITS", 6)
    monkeypatch.setattr(bytewords, "MOST_BITS", 6)
    assert judged(spark, CASES[1], ITEMS_ROWS[1]) == expected(CASES[1], ITEMS_ROWS[1])


def test_query_equals_brute_force(spark, sf):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    want = [(k, n, h, len(i), hashlib.sha256(",".join(i).encode()).hexdigest(), h > 0) for k, n, h, i in expected(docs, items)]
    got = [tuple(r) for r in op11_decontamination(spark, sf).collect()]
    assert sorted(got) == sorted(want)
    assert any(r[5] for r in want)


def test_only_prefix_places_are_joined(spark, sf):
    """Candidates are few: the rarest shingle of a window, not all of its shingles."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").select(F.col("doc_id").alias("key"), "text")
    items = spark.read.parquet(f"{sf}/benchmark.parquet")
    found = decontaminate.item_windows(items, "item_id", "text", 10, 4)
    every = bytewords.filter_of(found.select(F.explode("shingles").alias("s")).distinct(), "s")
    places = lambda known: decontaminate._candidates(docs, [4], known, 10, 40).select(F.sum(F.size("near"))).first()[0]
    _, hits, _ = decontaminate.find_windows(docs.withColumnRenamed("key", "doc_id"), items)
    first = bytewords.filter_of(found.select(F.element_at("shingles", 1).alias("s")).distinct(), "s")
    assert hits.count() <= places(every) * 7
    assert places(first) <= places(every)
