"""Mixing against a plain queue in Python."""

import math
import re

import pytest
from pyspark.sql import functions as F

from tidemark.llm import mixing
from tidemark.llm.prefix import running_sums
from tidemark.llm.queries import op6_mixing

SCHEMA = "doc_id long, text string, source string, size int"


def targets(sizes, cycle=(5, 2, 1), budget=1.5, repeats=2):
    """Shares by weight; what is above a cap is shared again until none is above."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: cycle[k % len(cycle)] for k, s in enumerate(names)}
    left, open_, out = budget * sum(sizes.values()), set(names), {}
    while open_:
        unit = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if unit * weight[s] > repeats * sizes[s]}
        if not full:
            out.update({s: unit * weight[s] for s in open_})
            break
        for s in full:
            out[s] = float(repeats * sizes[s])
            left -= out[s]
        open_ -= full
    return out


def check(docs, plan):
    size = {}
    for r in docs:
        size[r.source] = size.get(r.source, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
    want = targets(size)
    taken, longest = dict.fromkeys(size, 0), dict.fromkeys(size, 0)
    for r in plan:
        assert r.size == len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) if hasattr(r, "text") else True
        assert r.source_size == size[r.source]
        assert r.target == pytest.approx(want[r.source])
        assert r.taken in {0, r.size, 2 * r.size}
        taken[r.source] += r.taken
        longest[r.source] = max(longest[r.source], r.size)
    assert sum(taken.values()) <= 1.5 * sum(size.values())
    for s in size:
        assert abs(taken[s] - want[s]) <= 2 * longest[s] + 1, s


def test_query(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    plan = op6_mixing(spark, sf).collect()
    assert sorted(r.doc_id for r in plan) == sorted(d.doc_id for d in docs)
    size = {d.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", d.text or "")) for d in docs}
    assert all(r["size"] == size[r.doc_id] for r in plan)
    source = {d.doc_id: d.source for d in docs}
    assert all(r.source == source[r.doc_id] for r in plan)
    total = {}
    for d in docs:
        total[d.source] = total.get(d.source, 0) + size[d.doc_id]
    want, taken, longest = targets(total), {}, {}
    for r in plan:
        assert r.target == pytest.approx(want[r.source]) and r.taken in {0, r["size"], 2 * r["size"]}
        taken[r.source] = taken.get(r.source, 0) + r.taken
        longest[r.source] = max(longest.get(r.source, 0), r["size"])
    for s in total:
        assert abs(taken[s] - want[s]) <= longest[s]
    again = {r.doc_id: r.taken for r in op6_mixing(spark, sf).collect()}
    assert again == {r.doc_id: r.taken for r in plan}


def test_queue_by_hand(spark):
    """Finish times in plain Python, with the operator's own shuffle."""
    rows = [(k, "w " * (k % 7 + 1), "ab"[k % 3 == 0], 0) for k in range(60)]
    docs = spark.createDataFrame(rows, SCHEMA)
    order = {r.doc_id: r.h for r in docs.select("doc_id", F.xxhash64(F.lit(17), "doc_id").alias("h")).collect()}
    size = {k: k % 7 + 1 for k, *_ in rows}
    source = {r[0]: r[2] for r in rows}
    total = {s: sum(size[k] for k in size if source[k] == s) for s in "ab"}
    target = targets(total)
    queue = []
    for s in "ab":
        upto = 0
        for turn in (0, 1):
            for k in sorted((k for k in size if source[k] == s), key=order.get):
                upto += size[k]
                queue.append((upto / target[s], s, k))
    want, used = dict.fromkeys(size, 0), 0
    for _, _, k in sorted(queue):
        used += size[k]
        if used > int(1.5 * sum(size.values())):
            break
        want[k] += size[k]
    assert {r.doc_id: r.taken for r in mixing.plan_mix(docs).collect()} == want


def test_nulls_ties_repeats_and_empty(spark):
    rows = [(1, "a b c", "x", 5), (1, "a b c", "x", 5), (None, "a", None, 5), (None, "a", None, 5), (2, None, "x", 5), (3, "  ", "y", 5), (4, "long " * 50_000, "x", 5)]
    docs = spark.createDataFrame(rows, SCHEMA)
    plan = mixing.plan_mix(docs).collect()
    assert len(plan) == len(rows)
    assert {r.source for r in plan} == {"x", "y", None}
    assert all(r.taken == 0 for r in plan if r["size"] == 0)
    assert {r.target for r in plan if r.source == "y"} == {0.0}
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    assert mixed.count() == sum(r.copies for r in plan)
    assert mixing.plan_mix(docs.limit(0)).count() == 0 and mixing.mix(docs.limit(0)).count() == 0


def test_a_null_text_is_no_null_source(spark):
    """Documents that differ only in which column is null are told apart."""
    rows = [(None, "a", None, 1), (None, None, "a", 2)]
    mixed = mixing.mix(spark.createDataFrame(rows, SCHEMA)).collect()
    assert mixed and {tuple(r) for r in mixed} == {(None, "a", None, 1)}


def test_rows_that_differ_in_other_columns_are_all_taken(spark):
    """Equal key, source and text; each row has its own copies, and the same ones each time."""
    rows = [(1, "a b", "x", k, {"k": k % 2}, (None, k // 2) if k % 2 else (k // 2, None)) for k in range(20)]
    rows += [(1, "a b", "x", 50, {"k": 0}, (None, 7)), (1, "a b", "x", 50, {"k": 0}, (7, None)), (1, "a b", "x", 50, None, (7, None))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, size int, more map<string,int>, pair struct<a:int,b:int>")
    got = [sorted(map(str, mixing.mix(docs.repartition(n)).collect())) for n in (1, 5)]
    assert len(got[0]) == 34 and got[0] == got[1]
    assert {got[0].count(r) for r in got[0]} == {1, 2} and set(got[0]) == set(map(str, docs.collect()))


def test_clashing_names(spark):
    docs = spark.createDataFrame([(1, "a b", "x", 7, 8, 9), (2, "c d", "x", 7, 8, 9)], "doc_id long, text string, source string, uid int, copies int, doc int")
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    assert {tuple(r) for r in mixed.collect()} <= {tuple(r) for r in docs.collect()} and mixed.count() >= 2


def test_only_texts_without_words(spark):
    docs = spark.createDataFrame([(1, None, "x", 0), (2, " ", "y", 0)], SCHEMA)
    assert [(r.taken, r.target) for r in mixing.plan_mix(docs).collect()] == [(0, 0.0)] * 2


def test_running_sums(spark):
    rows = [(k * 7919 % 101, k % 3 or None) for k in range(500)]
    frame = spark.createDataFrame(rows, "k long, v long")
    got = running_sums(frame.repartition(5), [F.col("k").asc()], {"v": "upto"}).collect()
    last = {}
    for r in got:
        last[r.k] = max(last.get(r.k, 0), r.upto)
    total = 0
    for k in sorted(last):
        total += sum(v or 0 for key, v in rows if key == k)
        assert last[k] == total
    assert math.isclose(total, sum(v or 0 for _, v in rows))


def test_rows_are_told_apart_by_every_column(spark):
    rows = [("a", "b", [None]), ("ab", "", [None]), ("a", "b", []), ("a", "b", None), (None, "b", []), ("", "b", []), ("-", "b", []),
            ("1:a", "", []), ("a", "1:b", []), ("a", "b", ["null"])]
    docs = spark.createDataFrame(rows + rows[:2], "text string, lang string, tags array<string>")
    assert docs.select(mixing.uid_of(docs).alias("u")).distinct().count() == len(rows)
    typed = spark.sql("""SELECT x, CAST(x AS DOUBLE) AS y, DATE '2024-01-01' AS d, X'FF00' AS b, CAST(x AS TIMESTAMP) AS t,
        TIMESTAMP_NTZ '2024-01-01 00:00:00' AS z, CAST(x AS DECIMAL(9, 2)) AS m, x > 1 AS q FROM VALUES (1), (2), (NULL) AS v(x)""")
    assert typed.select(mixing.uid_of(typed).alias("u")).distinct().count() == 3
