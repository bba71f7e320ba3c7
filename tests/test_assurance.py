"""Checksum trees, part filters, packed series and SQL tokens against plain recomputation."""

import random
from collections import Counter
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.functions import sqltext as S
from tidemark.operators import checksums as C
from tidemark.operators import packed as P
from tidemark.operators import partfilters as B
from tidemark.session import cut, fresh_path


def both_ways(a, b):
    return Counter([(*r, "first") for r in (Counter(a) - Counter(b)).elements()] + [(*r, "second") for r in (Counter(b) - Counter(a)).elements()])


def test_tree_differences_equal_counted_rows(spark):
    rnd = random.Random(2)
    a = [(rnd.choice([None, *range(60)]), rnd.choice(["x", "y", None]), rnd.choice([0.5, None])) for _ in range(900)]
    b = [r for r in a if rnd.random() > 0.02] + [(7, "x", None), (None, None, None), (3, None, 0.5)] * 2
    frames = [spark.createDataFrame(rows, "k int, s string, v double") for rows in (a, b)]
    got = C.tree_differences(frames[0], frames[1].select("v", "k", "s"), ["k"], bits=8, step=4)
    assert Counter(tuple(r) for r in got.collect()) == both_ways(a, b)
    assert C.tree_differences(frames[0], frames[0].repartition(3, "v"), ["k"], bits=8).count() == 0
    empty = frames[0].limit(0)
    assert C.tree_differences(frames[0], empty, ["k"], bits=8).count() == len(a)
    assert C.tree_differences(empty, empty, ["k"], bits=8).count() == 0


def test_a_null_that_moves_is_a_difference(spark):
    a = spark.createDataFrame([(1, "x", None)], "k int, a string, b string")
    b = spark.createDataFrame([(1, None, "x")], "k int, a string, b string")
    assert C.tree_differences(a, b, ["k"], bits=4).count() == 2


def test_only_rows_of_differing_leaves_move(spark, sf):
    a = spark.read.parquet(f"{sf}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_quantity")
    one = a.agg(F.min("l_orderkey")).first()[0]
    b = a.withColumn("l_quantity", F.col("l_quantity") + (F.col("l_orderkey") == one).cast("int"))
    trees = [cut(C.checksum_tree(t, ["l_orderkey"], 12)) for t in (a, b)]
    nodes = C.differing_nodes(*trees, 12).orderBy("depth").collect()
    assert [r.depth for r in nodes] == [0, 4, 8, 12]  # one path from the root to the leaf
    leaves = C.differing_nodes(*trees, 12).filter("depth = 12").select("node")
    moved = C.suspects(a, ["l_orderkey"], leaves, 12).count()
    assert a.filter(F.col("l_orderkey") == one).count() <= moved < a.count() / 50
    text = C.suspects(a, ["l_orderkey"], cut(leaves), 12)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in text


def test_lookup_finds_all_and_skips_most(spark):
    rnd = random.Random(5)
    rows = [(rnd.randrange(10**9), rnd.choice([None, *range(40)]), k) for k in range(8000)] + [(None, 1, -1), (5, None, -2), (5, 3, -3)]
    frame = spark.createDataFrame(rows, "v long, d int, n int")
    path = fresh_path(spark, "parts")
    B.write_parts(frame, path, F.col("d"), "v")
    wanted = {rows[10][0], rows[4000][0], 5, -1}
    asked = spark.createDataFrame([(w,) for w in wanted] + [(5,), (None,)], "v long")
    found = B.lookup(spark, path, asked, "v")
    assert sorted(r.n for r in found.collect()) == sorted(n for v, _, n in rows if v in wanted)
    assert "dynamicpruning" in found._jdf.queryExecution().executedPlan().toString()
    filters = spark.read.parquet(f"{path}/filters")
    report = B.skipped(filters, asked, "v").first()
    holding = {d for v, d, _ in rows if v in wanted}
    assert report.parts == 41 and len(holding) <= report.candidates <= len(holding) + 6
    assert report.skipped_share == pytest.approx((41 - report.candidates) / 41)
    # No false negative: every value is found in its part.
    pairs = B.parts_with(filters, frame, "v").collect()
    assert {(p.part, p.value) for p in pairs} >= {(str(d) if d is not None else "none", v) for v, d, _ in rows if v is not None}
    assert len(pairs) < len(rows) + 0.02 * 41 * len(rows)
    assert B.lookup(spark, path, asked.limit(0), "v").count() == 0


@pytest.mark.parametrize("width", [0, 1, 7, 33, 64])
def test_pack_gives_numbers_back(width):
    z = np.array([0, 1, (1 << width) - 1, (1 << width) // 3] * 5, np.uint64)
    z = np.minimum(z, np.uint64((1 << width) - 1))
    assert (P.unpack(P.pack(z), len(z)) == z).all()
    x = np.array([0, -1, 5, np.iinfo(np.int64).min, np.iinfo(np.int64).max])
    assert (P.unzigzag(P.zigzag(x)) == x).all()


def series_rows():
    rnd = random.Random(9)
    base = datetime(2024, 1, 1)
    rows = [("hot", base + timedelta(seconds=k), round(rnd.random() * 100, 2)) for k in range(3000)]
    rows += [("raw", base + timedelta(microseconds=rnd.randrange(10**12)), rnd.gauss(0, 1)) for _ in range(500)]
    odd = [None, float("nan"), -0.0, 0.0, float("inf"), 1e300, 5e-324, 0.1]
    rows += [("odd", base + timedelta(days=k % 3), v) for k, v in enumerate(odd)]
    rows += [(None, base, 1.0), (None, base, 1.0), ("void", base, None), ("old", datetime(1901, 5, 1), 2.5)]
    return rows


@pytest.mark.parametrize("kind,points", [("timestamp", 100), ("timestamp_ntz", 1024)])
def test_packed_series_come_back(spark, kind, points):
    rows = series_rows()
    frame = spark.createDataFrame([*rows, ("hot", None, 1.0)], f"s string, ts {kind}, v double")
    blocks = cut(P.packed(frame, "s", "ts", "v", points))
    show = lambda rs: Counter((a, b, None if c is None else np.float64(c).tobytes()) for a, b, c in rs)
    back = P.unpacked(blocks, "s", "ts", "v")
    assert dict(back.dtypes) == {"s": "string", "ts": kind, "v": "double"}
    assert show(tuple(r) for r in back.collect()) == show(rows)
    assert blocks.agg(F.sum("points")).first()[0] == len(rows) and blocks.agg(F.max("points")).first()[0] <= points
    lo, hi = datetime(2024, 1, 1, 0, 10), datetime(2024, 1, 1, 0, 30)
    some = P.packed_range(blocks, "s", lo, hi)
    assert show(tuple(r) for r in some.collect()) == show(r for r in rows if lo <= r[1] < hi)
    assert P.packed(frame.limit(0), "s", "ts", "v").count() == 0


def test_totals_use_the_directory(spark):
    rows = series_rows()
    blocks = cut(P.packed(spark.createDataFrame(rows, "s string, ts timestamp, v double"), "s", "ts", "v", 64))
    lo, hi = datetime(2024, 1, 1), datetime(2024, 1, 1, 0, 40)
    got = {r.s: (r.points, r.least, r.most) for r in P.range_totals(blocks, "s", lo, hi).collect()}
    want = {}
    for s, t, v in rows:
        if lo <= t < hi:
            want.setdefault(s, []).append(v)
    ends = lambda vs: [v for v in vs if v is not None and v == v]
    assert got == {s: (len(vs), min(ends(vs), default=None), max(ends(vs), default=None)) for s, vs in want.items()}
    assert P.touched(blocks, lo, hi).count() < blocks.count()
    assert "GreaterThanOrEqual(last_ts" in P.touched(blocks, lo, hi)._jdf.queryExecution().executedPlan().toString()


def test_packed_blocks_are_smaller(spark):
    n = 20000
    frame = spark.range(n).selectExpr("'a' AS s", "timestamp_seconds(id * 10) AS ts", "round(20 + sin(id / 50), 2) AS v")
    size = P.packed(frame, "s", "ts", "v").agg(F.sum(F.octet_length("times") + F.octet_length("readings"))).first()[0]
    assert size < n * 1.5  # of 16 bytes a point


CASES = [
    ("SELECT 'drop' FROM aws_costs", []),
    ("SELECT * FROM aws_costs -- delete", []),
    ("SELECT /* update; */ * FROM aws_costs;", []),
    ("SELECT * FROM aws_costs, secret", ["Unknown table: secret"]),
    ("SELECT * FROM aws_costs a JOIN secret s ON a.x = s.x", ["Unknown table: secret"]),
    ("SELECT * FROM (SELECT * FROM secret) t JOIN aws_costs USING (x, y)", ["Unknown table: secret"]),
    ("SELECT 'it''s; drop' AS \"delete\" FROM AWS_COSTS", []),
    ("WITH t AS (SELECT * FROM gcp_costs), u AS (SELECT 1) SELECT * FROM t, u", []),
    ("SELECT a IS DISTINCT FROM b, extract(day FROM ts), trim(BOTH ' ' FROM x) FROM gcp_costs ORDER BY a, b", []),
    ("SELECT * FROM LATERAL (SELECT 1 FROM gcp_costs) z WHERE a IN (1, 2)", []),
    ("SELECT * FROM (aws_costs JOIN secret ON 1 = 1)", ["Unknown table: secret"]),
    ("SELECT x FROM aws_costs UNION SELECT y FROM db.secret", ["Unknown table: db.secret"]),
    ("DELETE FROM aws_costs", ["Forbidden keyword: DELETE", S.NOT_SELECT]),
    ("SELECT 1 FROM aws_costs; SELECT 2", [S.CHAINED]),
    ("SELECT 'never ends; drop FROM aws_costs", ["Query must reference one of: aws_costs, azure_costs, gcp_costs"]),
    ("", [S.NOT_SELECT, "Query must reference one of: aws_costs, azure_costs, gcp_costs"]),
    (None, [S.NOT_SELECT, "Query must reference one of: aws_costs, azure_costs, gcp_costs"]),
]


def test_sql_rules_by_tokens(spark):
    rows = spark.createDataFrame([(k, s) for k, (s, _) in enumerate(CASES)], "k int, s string")
    got = {r.k: r.e for r in rows.select("k", S.log_errors(F.col("s")).alias("e")).collect()}
    assert got == {k: e for k, (_, e) in enumerate(CASES)}


def test_long_literals_and_comments(spark):
    long = "drop; '' " * 30_000
    rows = [(f"SELECT '{long}' FROM aws_costs /* {long} */",)]
    found = S.tokens(F.col("s"))
    r = spark.createDataFrame(rows, "s string").select(S.verbs(found).alias("v"), S.statements(found).alias("n"), S.tables(found).alias("t")).first()
    assert (r.v, r.n, r.t) == ([], 1, ["aws_costs"])
