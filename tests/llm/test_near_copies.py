"""N-gram join and vector dedup against all pairs, and their shared parts."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import links, ngrams, vectordups
from tidemark.llm.queries import op1_ngram_jaccard_join, op2_embedding_near_dedup


def grams(text):
    words = re.findall(r"[^\W_]+", (text or "").lower())
    n = min(5, len(words))
    return {tuple(words[k : k + n]) for k in range(len(words) - n + 1)} if n else set()


def linked(items, alike):
    """Number of links and smallest linked key of each item, by all pairs."""
    links_of, root = [0] * len(items), list(range(len(items)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(items)):
        for j in range(i):
            if alike(items[i], items[j]):
                links_of[i] += 1
                links_of[j] += 1
                root[max(find(i), find(j))] = min(find(i), find(j))
    return links_of, [find(i) for i in range(len(items))]


def jaccard(a, b):
    both = len(a & b)
    return both > 0 and both >= 0.8 * (len(a) + len(b) - both)


def test_query_equals_all_pairs(spark, sf):
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect())
    n_links, roots = linked([grams(t) for _, t in docs], jaccard)
    got = {r.doc_id: (r.n_links, r.class_id, r.kept) for r in op1_ngram_jaccard_join(spark, sf).collect()}
    assert got == {d: (n, docs[r][0], docs[r][0] == d) for (d, _), n, r in zip(docs, n_links, roots)}
    assert any(n_links)


def near_texts(rnd, base, many):
    """Copies of a text with one word changed, near to the base but not all to each other."""
    out = []
    for _ in range(many):
        words = list(base)
        words[rnd.randrange(len(words))] = f"new{rnd.randrange(10_000)}"
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize("block", [4, 2048])
def test_a_large_group_in_blocks(spark, block):
    rnd = random.Random(4)
    base = [f"word{rnd.randrange(500)}" for _ in range(60)]
    texts = [*near_texts(rnd, base, 60), " ".join(base), " ".join(base).upper(), *(" ".join(rnd.choices("abcdefgh", k=40)) for _ in range(20))]
    docs = [(k, t) for k, t in enumerate(texts)]
    n_links, roots = linked([grams(t) for t in texts], jaccard)
    out = ngrams.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), block=block, block_grams=500)
    got = {r.doc_id: (r.n_links, r.class_id) for r in out.collect()}
    assert got == {k: (n, r) for k, (n, r) in enumerate(zip(n_links, roots))}
    assert max(n_links) > 40


def test_few_words_nulls_and_repeated_rows(spark):
    rows = [(1, "one two", "x"), (2, "One, two!", "x"), (3, None, "x"), (4, "", "x"), (5, "...", "x"), (6, "one two", "y"),
            (6, "one two", "y"), (None, "one two", "z"), (None, "alone here", "z"), (7, "three", "x"), (None, None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, CLASS_ID string")
    got = sorted(((r.doc_id, r.n_links, r.class_id, r.kept) for r in ngrams.near_duplicates(docs).collect()), key=str)
    group = [(1, 4, 1, True), (2, 4, 1, False), (6, 4, 1, False), (6, 4, 1, False), (None, 4, 1, False)]
    alone = [(3, 0, 3, True), (4, 0, 4, True), (5, 0, 5, True), (7, 0, 7, True), (None, 0, None, True), (None, 0, None, True)]
    assert got == sorted(group + alone, key=str)
    left = ngrams.without_duplicates(docs)
    assert left.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in left.collect()), key=str) == sorted(
        [(1, "one two"), (3, None), (4, ""), (5, "..."), (7, "three"), (None, "alone here"), (None, None)], key=str
    )
    assert ngrams.near_duplicates(docs.limit(0)).count() == 0


def test_recall_of_bands():
    bands = ngrams.bands_for(0.8, 8, 0.999)
    assert 1 - (1 - 0.8**8) ** bands >= 0.999 > 1 - (1 - 0.8**8) ** (bands - 1)
    rnd = np.random.default_rng(3)
    sets, others = [], []
    for _ in range(300):  # pairs at a similarity of exactly 0.8
        pool = rnd.integers(0, 1 << 63, 90).astype(np.uint64)
        sets.append(np.unique(pool[:81]))
        others.append(np.unique(pool[9:]))
    a, b = (ngrams.signatures(s, bands, 8) for s in (sets, others))
    assert ((a == b).any(axis=1)).mean() >= 0.99


def test_signatures_do_not_depend_on_the_batch():
    sets = [np.unique(np.random.default_rng(k).integers(0, 1 << 63, 50 + 40 * k).astype(np.uint64)) for k in range(20)]
    one = ngrams.signatures(sets, 4, 3, chunk=100)
    assert (one == ngrams.signatures(sets, 4, 3)).all()
    assert (one[7] == ngrams.signatures([sets[7]], 4, 3)[0]).all()


def test_gram_sets_tell_apart_words_with_one_key():
    bits = [bin(k).count("1") % 2 for k in range(2048)]
    one, other = "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)
    a, b, c = ngrams.gram_sets([f"{one} x y z v w", f"{other} x y z v w", f"{one} x y z v w"], 5)
    assert a.tolist() == c.tolist() != b.tolist()


def test_gram_sets_of_long_texts(monkeypatch):
    text = " ".join(f"w{k % 97} Été{k}" for k in range(3000))
    whole = ngrams.gram_sets([text, "a b"], 5)
    monkeypatch.setattr("tidemark.llm.words.pieces.__defaults__", (50,))
    cut = ngrams.gram_sets([text, "a b"], 5)
    assert all((a == b).all() for a, b in zip(whole, cut))
    assert len(whole[0]) == len(grams(text)) and len(whole[1]) == 1


def test_components_of_awkward_shapes(spark):
    path = [(k, k + 1) for k in range(100)]
    star = [(1000, 1000 + k) for k in range(1, 200)]
    ring = [(2000 + k, 2000 + (k + 1) % 50) for k in range(50)]
    edges = spark.createDataFrame(path + star + ring + [(5, 5), (3000, 3001), (3001, 3000)], "a long, b long")
    got = {}
    for r in links.components(edges).collect():
        got.setdefault(r.label, set()).add(r.id)
    assert sorted(map(sorted, got.values())) == [list(range(101)), list(range(1000, 1200)), list(range(2000, 2050)), [3000, 3001]]
    assert links.components(edges.limit(0)).count() == 0


def test_spanning_roots():
    rng = np.random.default_rng(1)
    for n, m in ((6, 9), (1, 4), (12, 3)):
        linked = rng.random((n, m)) < 0.2
        roots = links.spanning(linked, False)
        for i, j in zip(*np.nonzero(linked)):
            assert roots[i] == roots[n + j]
        assert all(roots[k] == k or roots[roots[k]] == roots[k] for k in range(n + m))


def cosine(a, b):
    if a is None or b is None:
        return False
    (la, x), (lb, y) = a, b
    return la == lb and len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.98


def prepared(label, vector):
    v = None if not vector or None in vector else np.array(vector, np.float64)
    return None if label is None or v is None or not np.isfinite(v).all() or not v.any() else (label, v)


@pytest.mark.parametrize("block", [8, 128])
def test_vectors_equal_all_pairs(spark, block):
    rng = np.random.default_rng(7)
    base = rng.standard_normal((6, 16))
    rows = [(k, [float(x) for x in base[k % 6] + 0.1 * rng.standard_normal(16)], int(k % 3 == 0)) for k in range(120)]
    rows += [(200 + k, rows[0][1], 1) for k in range(30)] + [(240, rows[0][1], 0), (241, rows[0][1], None)]
    rows += [(242, [2 * x for x in rows[0][1]], 1), (243, None, 1), (244, [0.0] * 16, 1), (245, [float("nan")] * 16, 1),
             (246, [], 1), (247, [None, 1.0], 1), (248, rows[0][1][:8], 1), (249, [float("inf")] * 16, 1)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    n_links, roots = linked([prepared(label, v) for _, v, label in rows], cosine)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in vectordups.near_duplicates(frame, block=block).collect()}
    assert got == {rows[k][0]: (n, rows[r][0], r == k) for k, (n, r) in enumerate(zip(n_links, roots))}
    assert vectordups.near_duplicates(frame.limit(0)).count() == 0


def test_vectors_without_keys(spark):
    rows = [(None, [1.0, 0.0], 1), (5, [1.0, 0.0], 1), (5, [1.0, 0.01], 1), (None, [0.0, 1.0], 1)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in vectordups.near_duplicates(frame).collect()), key=str)
    assert got == sorted([(None, 2, 5, False), (5, 2, 5, True), (5, 2, 5, True), (None, 0, None, False)], key=str)


def test_query_of_vectors(spark, sf):
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").orderBy("vec_id").collect()
    n_links, roots = linked([prepared(r.label, r.embedding) for r in rows], cosine)
    got = {r.vec_id: (r.n_links, r.component_id) for r in op2_embedding_near_dedup(spark, sf).collect()}
    assert got == {r.vec_id: (n, rows[k].vec_id) for r, n, k in zip(rows, n_links, roots)}


def test_tables_reach_their_recall():
    tables = vectordups.tables_for(0.98, 20, 0.9999)
    rng = np.random.default_rng(5)
    a = rng.standard_normal((400, 32))
    a /= np.linalg.norm(a, axis=1)[:, None]
    b = rng.standard_normal((400, 32))
    b -= (a * b).sum(axis=1)[:, None] * a
    b = 0.98 * a + np.sqrt(1 - 0.98**2) * b / np.linalg.norm(b, axis=1)[:, None]
    planes = vectordups.hyperplanes(32, tables, 20)
    same = ((a @ planes > 0) == (b @ planes > 0)).reshape(400, tables, 20).all(axis=2)
    assert same.any(axis=1).mean() >= 0.995


def test_no_all_pairs_join(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    members = docs.select(F.lit(1).alias("grp"), F.col("doc_id").alias("id"))
    sizes = members.groupBy("grp").agg(F.count("*").alias("n"), F.lit(1).alias("w"))
    tasks = links.block_pairs(members, sizes, 50)
    assert tasks.count() == 200 * 4
    assert "CartesianProduct" not in tasks._jdf.queryExecution().executedPlan().toString()


def test_one_of_each_class_keeps_columns_of_any_name(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(2, text, 7, 8), (1, text + " end", 5, 6), (3, None, 1, 2), (None, "", 3, 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, uid int, doc int")
    kept = ngrams.without_duplicates(docs)
    assert kept.columns == docs.columns
    assert {tuple(r) for r in kept.collect()} == {rows[1], rows[2], rows[3]}


def test_labels_of_any_type_keep_vectors_apart(spark):
    rows = [(1, [1.0, 0.0], "a"), (2, [1.0, 0.01], "a"), (3, [1.0, 0.0], "b"), (4, [1.0, 0.0, 0.0], "a"), (5, [1.0, 0.01], "b")]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")
    for label in ("label", "struct(label, 1 AS x)", "array(label)"):
        out = vectordups.near_duplicates(frame.selectExpr("vec_id", "embedding", f"{label} AS label"))
        assert {r.vec_id: (r.n_links, r.component_id) for r in out.collect()} == {1: (1, 1), 2: (1, 1), 3: (1, 3), 4: (0, 4), 5: (1, 3)}


def chain(many, size=100, step=9):
    """Texts of which each is like the next only: a window that slides over one long row of words."""
    words = [f"w{k}" for k in range(many * step + size)]
    return [" ".join(words[k * step : k * step + size]) for k in range(many)]


def compared(tasks):
    """Pairs of rows that the tasks compare."""
    held = {}
    for r in tasks.collect():
        sides = held.setdefault((r.grp, r.i, r.j), [0, 0])
        sides[r.second] += 1
    return sum(a * (a - 1) // 2 if k[1] == k[2] else a * b for k, (a, b) in held.items())


def test_a_chain_is_compared_within_its_buckets(spark):
    texts = chain(600)
    bands = ngrams.bands_for(0.8, 8, 0.999)
    docs = spark.createDataFrame(list(enumerate(texts)), "key long, text string").withColumn("uid", ngrams.uid_of("key", "text"))
    classes = ngrams.fingerprints(docs.select("key", "uid", "text"), 5, bands, 8).select(F.col("key").alias("id"), "grams", "bands")
    few, _ = ngrams.comparison_tasks(classes, 4, 1 << 21)
    assert few.filter("tab = -1").count() < few.count()
    assert compared(few) < 600 * 599 // 2 // 4
    n_links, roots = linked([grams(t) for t in texts], jaccard)
    assert max(n_links) == 2
    for block in (4, 512):
        got = {r.doc_id: (r.n_links, r.class_id) for r in ngrams.near_duplicates(docs.selectExpr("key AS doc_id", "text"), block=block).collect()}
        assert got == {k: (n, r) for k, (n, r) in enumerate(zip(n_links, roots))}


def test_near_copies_meet_once(spark):
    rnd = random.Random(9)
    base = [f"word{k}" for k in range(400)]
    docs = spark.createDataFrame(list(enumerate(near_texts(rnd, base, 40))), "key long, text string").withColumn("uid", ngrams.uid_of("key", "text"))
    classes = ngrams.fingerprints(docs.select("key", "uid", "text"), 5, 38, 8).select(F.col("key").alias("id"), "grams", "bands")
    tasks, _ = ngrams.comparison_tasks(classes, 8, 1 << 21)
    assert compared(tasks) == 40 * 39 // 2


def test_documents_are_told_apart_by_key_and_text(spark):
    rows = [(1, "2:x"), (12, ":x"), (None, "1"), (1, None), (1, ""), (None, None), (None, ""), (1, "null"), (1, "2:x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert docs.select(ngrams.uid_of("doc_id", "text").alias("u")).distinct().count() == len(set(rows))


def test_texts_are_read_again_without_a_shuffle(spark):
    rows = [(f"{k}".encode(), f"some words of text number {k}") for k in range(400)] * 2 + [(b"null", None)]
    docs = spark.createDataFrame(rows, "uid binary, text string")
    asked = [(k, f"{k}".encode()) for k in range(0, 400, 50)] + [(900, b"null")]
    needed = spark.createDataFrame(asked, "id long, uid binary")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        found = ngrams.sets_of(docs, needed, 5)
        plan = found._jdf.queryExecution().executedPlan().toString()
        got = {r.id: bytes(r.set) for r in found.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "Exchange" not in plan[plan.index("MapInArrow") :]
    texts = dict(rows)
    assert got == {k: ngrams.gram_sets([texts[u] or ""], 5)[0].tobytes() for k, u in asked}
    few = ngrams.filter_of(needed.select(F.xxhash64("uid").alias("hash")), "hash")
    assert ngrams.with_sets(docs, 5, few).count() < 100
