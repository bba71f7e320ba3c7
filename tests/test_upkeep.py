"""Intervals, signed deltas and merged sketches against plain recomputation."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators import deltas as D
from tidemark.operators import intervals as I
from tidemark.operators import joins as J
from tidemark.operators import sketches as K
from tidemark.session import fresh_path
from tidemark.streaming import streams as S


def test_nodes_cover_spans_once(spark):
    spans = [(a, b) for a in range(9) for b in range(9)]
    rows = spark.createDataFrame(spans, "a long, b long").select("a", "b", I.span_nodes("a", "b", 3).alias("n")).collect()
    for r in rows:
        held = sorted(p for n in r.n for p in range(n.at << n.level, (n.at + 1) << n.level))
        assert held == list(range(r.a, r.b))
        assert len(r.n) <= 6
    for r in spark.range(8).select("id", I.point_nodes("id", 3).alias("n")).collect():
        assert [(n.level, n.at) for n in r.n] == [(level, r.id >> level) for level in range(4)]


def random_versions(seed, n=60):
    rng = random.Random(seed)
    day = lambda k: date(2024, 1, 1) + timedelta(days=k)
    out = []
    for k in range(n):
        a = rng.randrange(40)
        out.append((rng.choice(["x", "y", None]), day(a), None if rng.random() < 0.2 else day(a + rng.randrange(-2, 15)), k))
    return out


def test_versions_at_equal_a_search(spark):
    rows = random_versions(1)
    dim = spark.createDataFrame(rows, "k string, a date, b date, v int")
    days = [(i, k, date(2024, 1, 1) + timedelta(days=d)) for i, (k, d) in enumerate((k, d) for k in ("x", "y", "z") for d in range(60))]
    got = J.version_at(spark.createDataFrame(days, "id long, k string, at date"), dim, "k", "at", "a", "b", "id").collect()
    assert len(got) == len(days)
    for r in got:
        valid = [(a, v) for k, a, b, v in rows if k == r.k and a <= r.at and (b is None or b > r.at)]
        newest = {v for a, v in valid if a == max(x for x, _ in valid)} if valid else {None}
        assert r.v in newest


def test_a_key_with_very_many_nested_versions(spark):
    n = 100_000
    dim = spark.range(n).select(
        F.lit("hot").alias("k"), F.timestamp_seconds(F.col("id")).alias("a"), F.timestamp_seconds(2 * n - F.col("id")).alias("b"), F.col("id").alias("v")
    )
    points = [(0, 5), (1, n - 1), (2, n + 1), (3, 2 * n - 5), (4, 2 * n + 9)]
    facts = spark.createDataFrame(points, "id long, s long").select("id", F.lit("hot").alias("k"), F.timestamp_seconds("s").alias("at"))
    got = {r.id: r.v for r in J.version_at(facts, dim, "k", "at", "a", "b", "id").collect()}
    assert got == {0: 5, 1: n - 1, 2: n - 2, 3: 4, 4: None}


def test_open_spans(spark):
    rows = random_versions(2, 80)
    spans = spark.createDataFrame(rows + [("x", None, None, 9)], "k string, a date, b date, v long")
    days = [(k, date(2024, 1, 1) + timedelta(days=d)) for k in ("x", "y", "z") for d in range(0, 70, 3)]
    points = spark.createDataFrame(days + days[:2] + [(None, days[0][1]), ("x", None)], "k string, at date")
    got = I.open_at(points, spans, ["k"], "at", "a", "b", "v").collect()
    assert len(got) == len(days) + 4
    for r in got:
        held = [v for k, a, b, v in rows if k is not None and r.k == k and r["at"] and a <= r["at"] and (b is None or b > r["at"])]
        assert (r.n_open, r.open_sum) == (len(held), sum(held) if held else None)
    assert I.open_at(points.limit(0), spans, ["k"], "at", "a", "b").count() == 0
    whole = spark.createDataFrame([(1, 1, 5), (1, 4, 12)], "k int, a long, b long")
    at = I.open_at(spark.createDataFrame([(1, p) for p in (0, 1, 4, 5, 11, 12)], "k int, p long"), whole, ["k"], "p", "a", "b")
    assert [r.n_open for r in at.orderBy("p").collect()] == [0, 1, 2, 1, 1, 0]


def test_deltas_equal_recomputation(spark):
    rng = random.Random(6)
    rows = [(k, rng.choice("abc"), rng.choice([None, 1, 2, 5])) for k in range(200)]
    kept = D.KeptAggregate(spark, ["g"], "v", buckets=5)
    table = lambda r: spark.createDataFrame(r, "id long, g string, v long")
    kept.load(table(rows))
    for step in range(3):
        after = [r for r in rows if r[0] % 7 != step]
        after = [(k, "a" if k % 5 == step else g, v if k % 3 else 9 + step) for k, g, v in after] + [(1000 + step, "d", 3)]
        kept.apply(D.deltas(table(rows), table(after), ["g", "v"]))
        rows = after
        want = {}
        for _, g, v in rows:
            want.setdefault(g, []).append(v)
        got = {r.g: (r.n, r.total, r.distinct_values, r.least, r.most) for r in kept.result().collect()}
        for g, vs in want.items():
            known = [v for v in vs if v is not None]
            assert got[g] == (len(vs), sum(known) if known else None, len({*known}), min(known, default=None), max(known, default=None))
        assert set(got) == set(want)
    kept.apply(D.deltas(table(rows), table([r for r in rows if r[1] != "d"]), ["g", "v"]))
    assert len(kept.rewritten) == 1 and "d" not in {r.g for r in kept.result().collect()}
    kept.apply(D.deltas(table(rows), table(rows), ["g", "v"]))
    assert kept.rewritten == []


def test_change_records(spark):
    changes = spark.createDataFrame(
        [("INSERT", None, "a"), ("DELETE", "b", None), ("update", "a", "b"), ("UPDATE", "c", "c")], "action string, old_g string, g string"
    )
    got = {r.g: r.delta for r in D.change_deltas(changes, ["g"]).collect()}
    assert got == {}  # +a -b -a +b -c +c
    with pytest.raises(Exception, match="unknown action"):
        D.change_deltas(changes.withColumn("action", F.lit("MERGE")), ["g"]).collect()
    state = spark.createDataFrame([("a", 1, 1)], "g string, v long, refs long")
    with pytest.raises(Exception, match="taken back"):
        D.fold(state, spark.createDataFrame([("a", 1, -2)], "g string, v long, delta long"), ["g"], "v").collect()


def test_merged_quantiles_are_close(spark):
    rows = spark.range(60_000).select((F.col("id") % 24).alias("hour"), (F.pmod(F.xxhash64("id"), F.lit(100_000)) / 7).alias("v"))
    hours = K.quantile_sketches(rows, ["hour"], "v")
    day = K.quantiles(K.merged_sketches(hours, []), {"p50": 0.5, "p95": 0.95}).first()
    assert day["n"] == 60_000
    for name, share in (("p50", 0.5), ("p95", 0.95)):
        below = rows.filter(F.col("v") <= day[name]).count() / 60_000
        assert abs(below - share) < 0.015
    few = K.quantiles(K.quantile_sketches(spark.createDataFrame([(1, None), (1, 3.0)], "k int, v double"), ["k"], "v"), {"m": 0.5}).first()
    assert (few["n"], few["m"]) == (1, 3.0)


def test_merged_hitters(spark):
    rows = spark.range(40_000).select(
        (F.col("id") % 10).alias("hour"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("x"), F.col("id") % 5000)).alias("item")
    )
    hours = K.hitter_sketches(rows, ["hour"], "item", 500)
    top = K.heavy_hitters(K.merged_hitters(hours, [], 500), 1).first()
    assert top["item"] == "hot" and abs(top["n"] - 13_334) <= 2 * 40_000 / 500


def test_top_items_of_a_stream_stay_bounded(spark):
    """More items than counters, in several batches: the frequent ones come out, nearly counted."""
    path = fresh_path(spark, "landing")
    rare = spark.range(9000).selectExpr("timestamp_seconds(id % 3600) AS ts", "concat('rare', id % 4000) AS item")
    hot = spark.range(3000).selectExpr("timestamp_seconds(id) AS ts", "CASE WHEN id % 3 = 0 THEN 'b' ELSE 'a' END AS item")
    late = spark.createDataFrame([("c",)] * 5 + [(None,)] * 7, "item string").selectExpr("timestamp_seconds(7200) AS ts", "item")
    rare.union(hot).union(late).repartition(4).write.parquet(path)
    stream = S.landed(spark, path, "ts timestamp, item string", files_per_batch=1).withWatermark("ts", "10 hours")
    close = spark.createDataFrame([("z",)], "item string").selectExpr("timestamp_seconds(360000) AS ts", "item")
    close.write.mode("append").parquet(path)
    counters = S.drain(S.feature_counters(stream, "item"), "counters")
    got = [(r.place, r["item"], r.n) for r in S.top_items(counters, 2).orderBy("window_start", "place").collect()]
    assert [r[:2] for r in got[:2]] == [(1, "a"), (2, "b")]
    assert abs(got[0][2] - 2000) <= 60 and abs(got[1][2] - 1000) <= 60
    assert {r[1:] for r in got[2:]} == {(None, 7), ("c", 5)}
