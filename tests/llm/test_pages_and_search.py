"""URL filters, WARC archives and nearest neighbours against plain Python."""

import hashlib
import random

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st

import __spark_entry__ as entry
from oracle import compare, connect
from tidemark.llm import ann, urlfilter, warc
from tidemark.llm.queries import op9_nearest_neighbours

RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"),
         ("a.b.net", "", "allow"), ("example.net", "/en/x", "block"), ("", "", "block"), ("org", "/fr/", "block")]


@pytest.mark.parametrize("name", ["op3_url_filters", "op7_warc"])
def test_equals_sql(spark, sf, name):
    assert compare(entry.queries()[name](spark, sf), connect(sf), entry.oracle_sql()[name]) is None


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
    path = rest[end:]
    return host, path[: min((path.find(c) for c in "?#" if c in path), default=len(path))]


def judged(url, rules):
    host, path = parts(url)
    fits = [(len(h + p), len(h), h + p) for h, p, _ in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if not fits:
        return host, path, None, "allow"
    rule = max(fits)[2]
    verdicts = {v for h, p, v in rules if h + p == rule}
    return host, path, rule, "block" if "block" in verdicts else "allow"


def test_rules_by_hand(spark):
    rnd = random.Random(2)
    hosts = ["net", "example.net", "EXAMPLE.net", "my.example.net", "notexample.net", "a.b.net", "x.a.b.net", "org", "x.org.", "", "É.org", "u@example.com:80"]
    paths = ["", "/", "/en/", "/en/xyz", "/en", "/fr/1?q=/", "#/fr/", "?a://b", "/de//x\ny", "/" + "seg/" * 3000]
    urls = [f"{s}://{h}{p}" for s in ("http", "a://b", "") for h in hosts for p in paths] + [None, "", "net/", "no scheme", "://"]
    rows = [(k if k % 9 else None, u, "old", "old") for k, u in enumerate(urls + rnd.choices(urls, k=20))]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, VERDICT string")
    for rules in (RULES[:4], RULES[:6], RULES):
        table = spark.createDataFrame([*rules, (None, "/", "block"), ("net", None, "block")], "host string, path string, verdict string")
        out = urlfilter.judge(pages, table)
        assert out.columns == ["page_id", "url", "host", "path", "rule", "verdict"]
        got = sorted(((r.page_id, r.url, r.host, r.path, r.rule, r.verdict) for r in out.collect()), key=str)
        want = sorted(((k, u, *judged(u, rules)) for k, u, *_ in rows), key=str)
        assert got == want
    none = urlfilter.judge(pages, table.limit(0), default="block").collect()
    assert {(r.rule, r.verdict) for r in none} == {(None, "block")} and len(none) == len(rows)
    assert urlfilter.judge(pages.limit(0), table).count() == 0


def test_archives_hold_all_payloads(spark):
    big = "é" * 200_000
    rows = [(1, "http://a/", "x" * 100, 1), (0, "http://b/\r\nX: y", "x" * 100, 1), (2, None, "x" * 99, 1), (3, "", "x" * 99, 1), (4, "u", None, 1),
            (5, "u", "", 1), (6, "u", big, 1), (7, "u", big, 1), (None, "u", big, 1), (None, "n", "z" * 200, 1), (None, "n", "z" * 200, 1),
            (8, "u", "a\r\n\r\nWARC/1.1\r\n" * 20, 1), (9, "r", "y" * 150, 1), (9, "r", "y" * 150, 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, digest int").repartition(3)
    index = warc.write(warc.with_types(pages), file_bytes=400)
    got = warc.read(index).collect()
    want = []
    for page, url, html, _ in rows:
        raw = (html or "").encode()
        same = [p for p, _, h, _ in rows if (h or "").encode() == raw and p is not None]
        first = min(same) if len(raw) >= 100 and same else None
        kind = "revisit" if first is not None and page != first else "response"
        want.append((page, url, kind, first if kind == "revisit" else None, raw if kind == "response" else None, len(raw), hashlib.sha256(raw).hexdigest()))
    assert sorted(got, key=str) == sorted(want, key=str) or sorted(
        [(r.page_id, r.url, r.record_type, r.refers_to, None if r.payload is None else bytes(r.payload), r.payload_bytes, r.payload_digest) for r in got], key=str
    ) == sorted(want, key=str)
    assert index.select("path").distinct().count() > 3
    one = warc.read(index.filter("page_id = 6")).collect()
    assert [bytes(r.payload) for r in one] == [big.encode()]
    assert warc.read(warc.write(warc.with_types(pages.limit(0)))).count() == 0


@given(st.lists(st.integers(1, 50), min_size=1, max_size=30), st.integers(0, 40), st.integers(1, 120), st.randoms())
def test_ranges_cover_each_record_once(lengths, gap, most, rnd):
    lengths = np.array(lengths)
    offsets = np.cumsum(lengths) - lengths
    kept = np.array(sorted(rnd.sample(range(len(lengths)), rnd.randint(1, len(lengths)))))
    found = warc.ranges(offsets[kept], lengths[kept], gap, most)
    assert [k for a, b in found for k in range(a, b)] == list(range(len(kept)))
    for a, b in found:
        o, n = offsets[kept][a:b], lengths[kept][a:b]
        assert b == a + 1 or o[-1] + n[-1] - o[0] <= most
        assert all(o[1:] - (o + n)[:-1] <= gap)


def best(rows, queries, k):
    out = {}
    for q, v in queries:
        found = {}
        for c, w in rows:
            if c != q and len(w) == len(v):
                found[c] = max(found.get(c, -np.inf), float(v @ w))
        out[q] = [(c, s) for s, c in sorted(((-s, c) for c, s in found.items()))][:k]
    return out


def test_recall_of_the_query(spark, sf):
    table = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    ids = np.array([r.vec_id for r in table])
    x = np.array([r.embedding for r in table], np.float64)
    got = {}
    for r in op9_nearest_neighbours(spark, sf).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    hits = 0
    assert set(got) == set(ids[ids % 20 == 0].tolist())
    for q, found in got.items():
        found.sort()
        assert [f[0] for f in found] == list(range(1, 21))
        exact = x @ x[ids == q][0]
        exact[ids == q] = -np.inf
        assert all(s == pytest.approx(exact[ids == v][0], abs=1e-12) for _, v, s in found)
        assert [(-s, v) for _, v, s in found] == sorted((-s, v) for _, v, s in found)
        hits += len({v for _, v, _ in found} & set(ids[np.argsort(-exact)[:20]].tolist()))
    assert hits >= 0.9 * 20 * len(got)


@pytest.mark.parametrize("part_rows", [3, 2048])
def test_few_candidates_are_all_returned(spark, part_rows):
    rng = np.random.default_rng(3)
    rows = [(k, [float(x) for x in rng.standard_normal(8) * (k + 1)]) for k in range(12)]
    rows += [(20, None), (40, [0.0] * 8), (60, [float("nan")] * 8), (80, [1.0, 2.0]), (100, rows[3][1]), (101, rows[3][1]), (None, rows[0][1]), (100, rows[3][1])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "0 AS score")
    usable = [(k, np.array(v)) for k, v in rows if k is not None and v is not None and np.isfinite(v).all() and np.any(v)]
    want = best(usable, [(k, v) for k, v in usable if k % 20 == 0], 20)
    got = {}
    for r in ann.nearest(frame, lambda key: key % 20 == 0, part_rows=part_rows).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert {q: [v for _, v, _ in sorted(f)] for q, f in got.items()} == {q: [v for v, _ in f] for q, f in want.items() if f}
    assert ann.nearest(frame.limit(0), lambda key: key % 20 == 0).count() == 0


def test_near_copies_are_found_first(spark):
    rng = np.random.default_rng(9)
    x = rng.standard_normal((600, 32))
    x[300:] = x[:300] * 1.01 + 0.01 * rng.standard_normal((300, 32))
    frame = spark.createDataFrame([(k, [float(c) for c in v]) for k, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {r.query_id: r.vec_id for r in ann.nearest(frame, lambda key: key < 300, k=1, tables=6, probes=16).collect()}
    exact = x[:300] @ x.T
    exact[np.arange(300), np.arange(300)] = -np.inf
    assert np.mean([got.get(k) == exact[k].argmax() for k in range(300)]) > 0.95


@pytest.mark.parametrize("spread", [None, 0.25, 1.0])
def test_recall_does_not_need_equal_lengths(spark, spread):
    """One vector five times longer than the rest, and log-normal lengths."""
    rng = np.random.default_rng(4)
    x = rng.standard_normal((2000, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    if spread is None:
        x[7] *= 5
    else:
        x *= np.exp(spread * rng.standard_normal((2000, 1)))
    frame = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {}
    for r in ann.nearest(frame, lambda key: key % 20 == 0).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    exact = x[::20] @ x.T
    exact[np.arange(100), np.arange(0, 2000, 20)] = -np.inf
    found = [len(got[20 * k] & set(np.argsort(-exact[k])[:20].tolist())) / 20 for k in range(100)]
    assert np.mean(found) >= 0.94 and min(found) > 0.6


def test_no_task_holds_all_queries_of_a_bucket(spark, monkeypatch):
    x = np.random.default_rng(8).standard_normal((400, 16))
    frame = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<double>")
    seen, scored = [], ann.scored
    monkeypatch.setattr(ann, "scored", lambda tasks, k: (seen.append(tasks), scored(tasks, k))[1])
    found = lambda **how: sorted((r.query_id, r["rank"], r.vec_id) for r in ann.nearest(frame, lambda key: key >= 0, k=5, **how).collect())
    small = found(part_rows=32)
    key = [c for c in seen[0].columns if c not in ("asks", "id", "vector")]
    held = seen[0].groupBy(*key, "asks").count().collect()
    assert small == found()
    assert max(r["count"] for r in held if r.asks) <= 64 and max(r["count"] for r in held if not r.asks) <= 64


def test_hadamard_keeps_lengths_and_axes():
    x = np.random.default_rng(1).standard_normal((5, 16))
    y = ann.hadamard(x)
    assert np.allclose((x * x).sum(axis=1), (y * y).sum(axis=1)) and np.allclose(ann.hadamard(y), x)
    assert ann.axes(np.array([[0.1, -3.0, 2.0, 0.0]]), 3).tolist() == [[3, 4, 0]]
