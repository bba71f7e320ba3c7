"""Record matching, near copies and clusters against brute force on small data."""

import re

import numpy as np
from pyspark.sql import functions as F

from tidemark.operators import dedup as D
from tidemark.session import cut


def test_one_edit_and_soundex(spark):
    row = spark.createDataFrame([("John Smith", "Jon Smith")], "a string, b string")
    assert row.select(F.levenshtein("a", "b")).first()[0] == 1
    a, b = row.select(D.one_edit(F.col("a")), D.one_edit(F.col("b"))).first()
    assert set(a) & set(b)
    assert row.select(F.soundex(F.lit("John")) == F.soundex(F.lit("Jon"))).first()[0]


def edit(a, b):
    prev = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            now.append(min(prev[j] + 1, now[-1] + 1, prev[j - 1] + (x != y)))
        prev = now
    return prev[-1]


def test_every_pair_one_edit_apart_is_connected(spark):
    names = ["anna", "anne", "ana", "bob", "bobb", "rob", "zed", "hannah", "x"]
    df = spark.createDataFrame(list(enumerate(names)), "id long, name string")
    links = D.match_records(df, "id", [D.Rule("n", D.one_edit(F.col("name")), 1.0)], 1.0)
    cluster = {r.node: r.cluster for r in D.clusters(links, "record", "leader").collect()}
    for i, a in enumerate(names):
        for j in range(i):
            if edit(a, names[j]) <= 1:
                assert cluster[i] == cluster[j], (a, names[j])
    assert 6 not in cluster and 7 not in cluster


def test_linked_texts_are_at_most_one_edit_apart(spark):
    names = ["Brand#12", "Brand#21", "Brand#13", "Brand#1", "rand#12", "", "a", "b", "ab", "ba", None]
    df = spark.createDataFrame(list(enumerate(names)), "id long, name string")
    links = D.match_records(df, "id", [D.Rule("n", D.one_edit(F.col("name")), 1.0)], 1.0).collect()
    assert links and all(edit(names[r.record], names[r.leader]) <= 1 for r in links)
    cluster = {}
    for r in links:
        cluster.setdefault(r.record, set()).add(r.leader)
    for i, a in enumerate(names[:-1]):
        for j in range(i):
            if edit(a, names[j]) <= 1:
                forms = df.filter(F.col("id").isin(i, j)).select(D.one_edit(F.col("name")).alias("f")).collect()
                assert set(forms[0].f) & set(forms[1].f)


def test_weights_need_enough_rules(spark):
    rows = [
        (1, "John Smith", "j@x.com", "555-1"), (2, "Jon Smith", "j@x.com", "555-1"),
        (3, "J. Smith", "j@x.com", "555-9"), (4, "Ann Lee", None, "555-1"), (5, "Ann Lee", None, None),
    ]
    df = spark.createDataFrame(rows, "id long, name string, email string, phone string")
    rules = [
        D.Rule("name", D.one_edit(D.squeezed(F.col("name"))), 0.5),
        D.Rule("email", F.lower("email"), 0.5),
        D.Rule("phone", F.regexp_replace("phone", r"\D", ""), 0.3),
    ]
    got = {(r.leader, r.record, r.rules) for r in D.match_records(df, "id", rules, 0.8).collect()}
    assert got == {(1, 2, "name+email"), (1, 2, "name+phone"), (1, 2, "email+phone")}
    loose = D.match_records(df, "id", rules, 0.5)
    cluster = {r.node: r.cluster for r in D.clusters(loose, "record", "leader").collect()}
    assert cluster == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4}


def test_long_chain_closes(spark):
    links = spark.range(200).select("id", (F.col("id") + 1).alias("next"))
    out = D.clusters(links, "id", "next")
    assert out.count() == 201 and out.select("cluster").distinct().collect()[0][0] == 0


def shingle_set(text, n=3):
    words = [w for w in re.split(r"[\W_]+", text.lower()) if w]
    return {tuple(words[i : i + n]) for i in range(max(len(words) - n + 1, 1))} if words else set()


def test_near_copies_against_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    rows = docs.collect()
    sets = {r.doc_id: shingle_set(r.text) for r in rows}
    got = D.near_copies(docs, "doc_id", "text", threshold=0.7).collect()
    for r in got:
        a, b = sets[r.doc], sets[r.leader]
        true = len(a & b) / len(a | b) if a | b else 1.0
        assert abs(true - r.similarity) < 1e-9 and true >= 0.7
    linked = {r.doc for r in got} | {r.leader for r in got}
    ids = sorted(sets)
    close = {
        (a, b) for i, a in enumerate(ids) for b in ids[:i]
        if sets[a] and sets[a] | sets[b] and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.85
    }
    assert close and all(a in linked and b in linked for a, b in close)


def test_hot_bucket_resolves(spark):
    """One bucket with copies and with texts unlike its leader."""
    base = " ".join(f"w{i}" for i in range(60))
    other = " ".join(f"v{i}" for i in range(60))
    rows = [(i, base) for i in range(50)] + [(100, base + " tail"), (200, other), (201, other + " end")]
    df = spark.createDataFrame(rows, "id long, text string")
    links = D.near_copies(df, "id", "text", bands=20, rows=4)
    cluster = {r.node: r.cluster for r in D.clusters(links, "doc", "leader").collect()}
    assert {cluster[i] for i in range(50)} == {0} and cluster[100] == 0
    assert cluster[200] == cluster[201] == 200


def components_of(sets, threshold):
    """Clusters of two or more by all pairs: {node: smallest node}."""
    label = {i: i for i in sets}
    close = [
        (a, b) for a in sets for b in sets
        if a < b and sets[a] and sets[b] and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= threshold
    ]
    for _ in sets:
        for a, b in close:
            label[a] = label[b] = min(label[a], label[b])
    return {i: label[i] for pair in close for i in pair}


def found_clusters(df, **how):
    links = D.near_copies(df, "id", "text", **how)
    return {r.node: r.cluster for r in D.clusters(links, "doc", "leader").collect()}


def test_texts_unlike_their_leader_keep_their_links(spark):
    """1-2 and 2-3 are close, 1-3 is not, and all share both buckets."""
    words = [f"w{i}" for i in range(100)]
    texts = {1: words, 2: words[:-3] + ["x", "y", "z"], 3: ["a", "b", "c"] + words[3:-3] + ["x", "y", "z"]}
    rows = [(k, " ".join(v)) for k, v in texts.items()]
    df = spark.createDataFrame(rows, "id long, text string")
    sets = {k: shingle_set(t) for k, t in rows}
    assert len(sets[1] & sets[3]) / len(sets[1] | sets[3]) < 0.93 <= len(sets[2] & sets[3]) / len(sets[2] | sets[3])
    got = {(r.leader, r.doc) for r in D.near_copies(df, "id", "text", threshold=0.93, bands=200, rows=1).collect()}
    assert got == {(1, 2), (2, 3)}


def test_blocks_of_a_hot_bucket_give_all_components(spark):
    """A shared passage puts all texts in the same buckets; small blocks split each bucket."""
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(10 * k + v, f"{passage} " + " ".join(f"k{k}n{i}" for i in range(30)) + f" tail{v}") for k in range(12) for v in range(3)]
    rows += [(900, ""), (901, None), (902, "two words"), (903, "Two WORDS!"), (904, None), (905, "")]
    df = spark.createDataFrame(rows, "id long, text string")
    want = components_of({k: shingle_set(t or "") for k, t in rows}, 0.9) | {900: 900, 905: 900}
    assert len(set(want.values())) == 14
    assert found_clusters(df, threshold=0.9, bands=40, rows=1, block=4) == want
    assert found_clusters(df, threshold=0.9, bands=40, rows=1, block_grams=200) == want


def test_passes_do_not_grow_with_a_bucket(spark, monkeypatch):
    written = []
    monkeypatch.setattr(D, "cut", lambda df: written.append(1) or cut(df))
    passage = " ".join(f"p{i}" for i in range(60))
    counts = []
    for n in (20, 40):
        rows = [(k, f"{passage} " + " ".join(f"k{k}n{i}" for i in range(30))) for k in range(n)]
        written.clear()
        D.near_copies(spark.createDataFrame(rows, "id long, text string"), "id", "text", bands=2, rows=1).collect()
        counts.append(len(written))
    assert counts[0] == counts[1]


def test_near_copies_of_nothing(spark):
    assert found_clusters(spark.createDataFrame([], "id long, text string")) == {}


def test_exact_copies_keep_nulls_apart(spark):
    df = spark.createDataFrame([(1, "a", None), (2, "a", None), (3, "a", ""), (4, "ab", "c"), (5, "a", "bc")], "id long, x string, y string")
    assert [(r.survivor, r.copies) for r in D.exact_copies(df, "id", ["x", "y"]).collect()] == [(1, 2)]
    assert sorted(r.id for r in D.drop_exact_copies(df, "id", ["x", "y"]).collect()) == [1, 3, 4, 5]


def test_minima_of_many_sets_equal_plain_ones():
    rng = np.random.default_rng(5)
    prime = int(D._PRIME)
    a, b = rng.integers(1, prime, 12, dtype=np.uint64), rng.integers(0, prime, 12, dtype=np.uint64)
    sets = [rng.integers(-(1 << 63), (1 << 63) - 1, n) for n in (1, 7, 40, 100, 3)]
    sets.append(np.array([0, -1, prime, prime - 1, 1 << 62]))
    want = [[min((int(p) * (int(x) % (1 << 64) % prime) + int(q)) % prime for x in s) for p, q in zip(a, b)] for s in sets]
    for chunk in (16, 64, 1 << 15):
        assert [list(map(int, low)) for low in D._minima(sets, a, b, chunk)] == want
