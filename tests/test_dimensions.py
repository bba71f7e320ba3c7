from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

import fixtures as X
from tidemark.operators import changes as C
from tidemark.operators import joins as J
from tidemark.operators import quality as Q
from tidemark.operators import scd as S

D = date.fromisoformat
TRACKED = ["email", "city"]
SCHEMA = "id string, email string, city string"


@pytest.fixture
def first(spark):
    rows = [("C1", "a@x", "Rome"), ("C2", "b@x", "Oslo"), ("C3", None, "Bonn"), ("C4", "d@x", "Kiel")]
    return S.snapshot_scd2(None, spark.createDataFrame(rows, SCHEMA), ["id"], TRACKED, D("2024-01-01"))


def staged(spark):
    # unchanged, changed, from NULL, to NULL, new key
    rows = [("C1", "a@x", "Rome"), ("C2", "b@x", "Bergen"), ("C3", "c@x", "Bonn"), ("C4", None, "Kiel"), ("C5", "e@x", "Lyon")]
    return spark.createDataFrame(rows, SCHEMA)


def as_set(df):
    return sorted(((tuple(r)) for r in df.collect()), key=repr)


def test_scd2_cases_and_rerun(spark, first):
    out = S.scd2(first, staged(spark), ["id"], TRACKED, D("2024-07-01"))
    per = {r.id: r.n for r in out.groupBy("id").agg(F.count("*").alias("n")).collect()}
    assert per == {"C1": 1, "C2": 2, "C3": 2, "C4": 2, "C5": 1}
    assert S.timeline_faults(out, ["id"]).count() == 0
    now = {r.id: (r.email, r.city) for r in S.current_rows(out).collect()}
    assert now["C4"] == (None, "Kiel") and now["C3"] == ("c@x", "Bonn")
    again = S.scd2(out, staged(spark), ["id"], TRACKED, D("2024-07-01"))
    assert as_set(again) == as_set(out)
    fixed = spark.createDataFrame([("C2", "b@x", "Tromso")], SCHEMA)
    same_day = S.scd2(out, fixed, ["id"], TRACKED, D("2024-07-01"))
    assert same_day.count() == out.count()
    assert same_day.filter("id = 'C2' AND is_current").first().city == "Tromso"


def test_duplicate_staging_fails(spark, first):
    twice = staged(spark).unionByName(staged(spark).filter("id = 'C1'"))
    with pytest.raises(ValueError, match="more than once"):
        S.scd2(first, twice, ["id"], TRACKED, D("2024-07-01"))


@pytest.mark.parametrize("how", [{"mode": "window"}, {"mode": "chunked", "chunks": 3}])
def test_late_arrival(spark, how):
    dim = spark.createDataFrame(
        [("C1", "Rome", D("2024-01-01"), D("2024-07-01"), False), ("C1", "Pisa", D("2024-07-01"), None, True)],
        "id string, city string, effective_date date, expiration_date date, is_current boolean",
    )
    late = spark.createDataFrame([("C1", "Bari", D("2024-06-15"))], "id string, city string, effective_date date")
    got = S.rebuild_timeline(dim, late, ["id"], ["city"], **how).orderBy("effective_date").collect()
    assert [(r.city, str(r.effective_date), str(r.expiration_date)) for r in got] == [
        ("Rome", "2024-01-01", "2024-06-15"), ("Bari", "2024-06-15", "2024-07-01"), ("Pisa", "2024-07-01", "None"),
    ]
    same = spark.createDataFrame([("C1", "Rome", D("2024-03-01"))], "id string, city string, effective_date date")
    assert S.rebuild_timeline(dim, same, ["id"], ["city"], **how).count() == 2


def test_scd1_scd3_keys(spark, first):
    base = first.select("id", "email", "city")
    assert S.scd1(base, staged(spark), ["id"]).filter("id = 'C4'").first().email is None
    three = S.scd3(base, staged(spark), ["id"], "city")
    got = {r.id: (r.city, r.previous_city) for r in three.collect()}
    assert got["C2"] == ("Bergen", "Oslo") and got["C1"] == ("Rome", None)
    keys = S.dense_keys(base, ["id"], "k", after=10, mode="chunked", chunks=3)
    assert sorted(r.k for r in keys.collect()) == [11, 12, 13, 14]
    assert base.select(S.hash_key(["id"]).alias("k")).distinct().count() == 4


def test_closed_intervals_become_half_open(spark):
    dim = spark.createDataFrame(X.DIM_PRODUCT, "k int, product_id string, name string, material string, effective_date date, expiration_date date, is_current boolean")
    out = S.half_open(dim, "expiration_date")
    assert str(out.filter("k = 1").first().expiration_date) == "2024-01-02"
    assert out.filter("k = 2").first().expiration_date is None
    assert S.timeline_faults(out, ["product_id"]).count() == 0


@pytest.mark.parametrize("how", [{"mode": "window"}, {"mode": "chunked", "chunks": 3}])
def test_overlaps_are_found_past_the_neighbour(spark, how):
    rows = [("a", 1, "2024-01-01", None), ("a", 2, "2024-02-01", "2024-03-01"), ("a", 3, "2024-04-01", "2024-05-01"), ("b", 4, "2024-01-01", "2024-02-01"), ("b", 5, "2024-02-01", None)]
    spans = spark.createDataFrame(rows, "k string, id int, s string, e string").select("k", "id", F.to_date("s").alias("s"), F.to_date("e").alias("e"))
    got = sorted((r.earlier_id, r.later_id) for r in J.overlapping(spans, "k", "id", "s", "e", **how).collect())
    assert got == [(1, 2), (1, 3)]


@pytest.mark.parametrize("how", [{}, {"mode": "chunked", "chunks": 3}])
def test_version_lookup(spark, how):
    dim = spark.createDataFrame(
        [("a", "x", D("2024-01-01"), D("2024-02-01")), ("a", "y", D("2024-03-01"), None), ("b", "z", D("2024-01-01"), None)],
        "k string, v string, s date, e date",
    )
    facts = spark.createDataFrame([(1, "a", D("2024-01-15")), (2, "a", D("2024-02-01")), (3, "a", D("2024-03-01")), (4, "b", D("2023-01-01")), (5, "c", D("2024-01-01"))], "id long, k string, d date")
    want = [(1, "x"), (2, None), (3, "y"), (4, None), (5, None)]
    got = J.version_at(facts, dim, "k", "d", "s", "e", "id", **how)
    assert sorted((r.id, r.v) for r in got.collect()) == want


def test_nested_versions(spark):
    """An older version is valid again when a later, shorter one has ended."""
    dim = spark.createDataFrame(
        [("k", "a", D("2024-01-01"), None), ("k", "b", D("2024-03-01"), D("2024-04-01")), ("k", "c", D("2024-03-10"), D("2024-03-20"))],
        "k string, v string, s date, e date",
    )
    days = {1: "2023-12-31", 2: "2024-02-01", 3: "2024-03-05", 4: "2024-03-15", 5: "2024-03-25", 6: "2024-05-01"}
    facts = spark.createDataFrame([(i, "k", D(d)) for i, d in days.items()], "id long, k string, d date")
    got = J.version_at(facts, dim, "k", "d", "s", "e", "id")
    assert {r.id: r.v for r in got.collect()} == {1: None, 2: "a", 3: "b", 4: "c", 5: "b", 6: "a"}


def test_upsert_and_change_log(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id long, v string")
    s = spark.createDataFrame([(2, None), (4, "d")], "id long, v string")
    up = C.upsert(t, s, ["id"])
    assert as_set(up) == [(1, "a"), (2, None), (3, "c"), (4, "d")]
    with pytest.raises(ValueError):
        C.upsert(t, s.unionByName(s), ["id"])
    feed = C.change_feed(t, up.filter("id <> 1"), ["id"])
    assert as_set(feed) == sorted([(1, "a", "DELETE", False), (2, "b", "DELETE", True), (2, None, "INSERT", True), (4, "d", "INSERT", False)], key=repr)
    log = spark.createDataFrame([(1, "z", 1, "UPDATE"), (1, "y", 2, "DELETE"), (5, "n", 1, "INSERT"), (5, "m", 3, "UPDATE")], "id long, v string, seq int, act string")
    assert as_set(C.apply_changes(t, log, ["id"], "seq", "act")) == [(2, "b"), (3, "c"), (5, "m")]
    kept = C.delete_where(up, F.col("v") == "a")
    assert kept.count() == 3  # the NULL row stays
    assert as_set(C.update_where(up, F.col("v") == "a", v=F.lit("q")))[0] == (1, "q")
    assert C.add_column(t, "n", "int").schema["n"].dataType.simpleString() == "int"


def test_quarantine_and_retry(spark):
    rows = spark.createDataFrame([(1, 5), (2, -1), (3, None)], "id int, v int")
    rules = {"known": F.col("v").isNotNull(), "positive": F.col("v") > 0}
    good, bad = C.split_quality(rows, rules)
    assert [r.id for r in good.collect()] == [1]
    assert {r.id: r.reasons for r in bad.collect()} == {2: ["positive"], 3: ["known", "positive"]}
    fixed, still = C.retry(bad, lambda d: d.withColumn("v", F.abs("v")), rules)
    assert [r.id for r in fixed.collect()] == [2] and still.count() == 1


def test_quality_checks(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "id long, v string")
    b = spark.createDataFrame([(2, "y"), (1, "x")], "id long, v string")
    x, y = Q.fingerprint(a, "a").first(), Q.fingerprint(b, "a").first()
    assert x == y
    assert Q.different_rows(a, b).count() == 0
    assert Q.different_rows(a, b.filter("id = 1")).count() == 1
    drift = Q.schema_drift(spark, a.schema, b.withColumn("n", F.lit(1)).drop("v").schema)
    assert sorted((r.column_name, r.drift) for r in drift.collect()) == [("n", "added"), ("v", "missing")]
    days = spark.createDataFrame([(D("2024-01-01"),), (D("2024-01-04"),)], "d date")
    assert [r.day.day for r in Q.missing_days(days, F.col("d")).orderBy("day").collect()] == [2, 3]
    assert Q.missing_days(days.limit(0), F.col("d")).count() == 0


@pytest.mark.parametrize("ahead, stale", [(500_000, True), (0, False), (-500_000, False)])
def test_freshness_counts_parts_of_a_second(spark, ahead, stale):
    """Half a second more than the limit is too old."""
    newest = datetime(2024, 1, 31) - timedelta(microseconds=ahead)
    rows = spark.createDataFrame([(newest,)], "ts timestamp_ntz")
    assert Q.freshness(rows, "t", "ts", datetime(2024, 2, 1), 24).first().stale is stale
