import pytest
from pyspark.sql import functions as F

from tidemark.operators import joins as J
from tidemark.operators.features import psi, with_fallback
from tidemark.operators.aggregates import partition_totals, salted_totals


def same(a, b):
    assert a.count() == b.count()
    assert a.select(*b.columns).exceptAll(b).count() == 0


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows on one key, NULL keys, and exact copies."""
    fact = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 40).cast("long").alias("k"),
        F.floor(F.col("id") / 10).alias("v"),
    )
    dim = spark.range(60).select(F.col("id").alias("k"), F.concat(F.lit("d"), "id").alias("d"))
    return fact, dim


def test_skew_joins_equal_plain(skewed):
    fact, dim = skewed
    want = fact.join(dim, "k")
    same(J.salted_join(fact, dim, "k", 4), want)
    same(J.salted_join(fact, dim, "k", 4, "left"), fact.join(dim, "k", "left"))
    same(J.hybrid_join(fact, dim, "k", 0.1), want)
    same(J.hybrid_join(fact, dim, "k", 0.1, max_rows=0), want)
    assert J.hot_keys(fact, "k", 0.1).collect()[0][0] == 7


def test_salted_copies_are_not_broadcast(skewed):
    fact, dim = skewed
    for how in ("inner", "left"):
        plan = J.salted_join(fact, dim, "k", 4, how)._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_two_phase_totals(skewed):
    fact, _ = skewed
    want = fact.groupBy("k").agg(F.sum("v").alias("total"), F.count("*").alias("n"))
    same(salted_totals(fact, "k", "v", 4), want)
    same(partition_totals(fact.filter("k IS NOT NULL"), "k", "v"), want.filter("k IS NOT NULL"))


def test_checked_broadcast(spark, skewed):
    fact, dim = skewed
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for bounds, hinted in (({}, True), ({"max_rows": 5}, False), ({"max_bytes": 10}, False)):
            plan = fact.join(J.broadcast_checked(dim, **bounds), "k")._jdf.queryExecution().executedPlan().toString()
            assert ("BroadcastHashJoin" in plan) == hinted
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_null_keys_of_the_hybrid_join(skewed):
    fact, dim = skewed
    assert fact.filter("k IS NULL").count() > 0
    assert J.hybrid_join(fact, dim, "k", 0.1).filter("k IS NULL").count() == 0


def test_counts_of_join_kinds(spark):
    students = spark.createDataFrame([(i,) for i in range(5)], "id int")
    grades = spark.createDataFrame([(0,), (2,), (4,)], "id int")
    assert students.join(grades, "id").count() == 3
    assert students.join(grades, "id", "left").count() == 5
    a = spark.createDataFrame([(10,), (10,), (20,), (30,)], "v int")
    b = spark.createDataFrame([(10,), (20,), (20,), (40,), (50,)], "v int")
    assert a.unionByName(b).count() == 9 and a.union(b).distinct().count() == 5


def test_covering_never_multiplies(spark):
    accounts = spark.createDataFrame([("a1", 100), ("a2", 50), ("a2", 500), ("a3", 10)], "account string, balance int")
    moves = spark.createDataFrame([(1, "a1", "a2", 100), (2, "a2", "a3", 400), (3, "a3", "a1", 11), (4, "a9", "a1", 1), (5, "a1", "zz", 5)], "id int, src string, dst string, amount int")
    ok = J.covering(moves, accounts, "src", "account", "amount", "balance")
    assert sorted(r.id for r in ok.collect()) == [1, 2, 5]
    known = ok.join(accounts.select(F.col("account").alias("dst")), "dst", "left_semi")
    assert sorted(r.id for r in known.collect()) == [1, 2]


@pytest.mark.parametrize("how", [{"mode": "window"}, {"mode": "chunked", "chunks": 4}])
def test_as_of_has_no_look_ahead(spark, how):
    f = spark.createDataFrame([(1, "k", 10, "a"), (2, "k", 20, "b"), (3, "k", 20, "c"), (4, "m", 1, "z")], "id long, k string, t int, v string")
    lab = spark.createDataFrame([(1, "k", 5), (2, "k", 10), (3, "k", 25), (4, "q", 9), (5, "k", 20)], "id long, k string, t int")
    got = {r.id: r.last_v for r in J.as_of_join(lab, f, "k", "t", "id", ["v"], **how).collect()}
    assert got == {1: None, 2: "a", 3: "c", 4: None, 5: "c"}


def test_also_bought_matches_brute_force(spark):
    lines = spark.range(400).select((F.col("id") % 37).alias("b"), F.pmod(F.xxhash64("id"), F.lit(11)).alias("i"))
    seeds = spark.createDataFrame([(0,), (3,)], "i long")
    got = {(r.seed, r.other): r.baskets for r in J.also_bought(lines, "b", "i", seeds).collect()}
    baskets = {}
    for r in lines.distinct().collect():
        baskets.setdefault(r.b, set()).add(r.i)
    want = {}
    for items in baskets.values():
        for s in items & {0, 3}:
            for o in items - {s}:
                want[(s, o)] = want.get((s, o), 0) + 1
    assert got == want
    every = J.also_bought(lines, "b", "i", lines.select("i"))
    assert every.count() == len({(s, o) for items in baskets.values() for s in items for o in items - {s}})


def test_social_measures(spark):
    e = spark.createDataFrame([(1, 2), (3, 2), (4, 1), (5, 1), (4, 3)], "a long, b long")
    got = {r.node: (r.followers, r.second_hop, r.influence) for r in J.influence(e, "a", "b").collect()}
    assert got[2] == (2, 3, 2.3) and got[1] == (2, 0, 2.0)
    follows = e.select(F.col("a").alias("follower_id"), F.col("b").alias("followed_id"))
    posts = spark.createDataFrame([(10, 2), (11, 1)], "post_id long, author_id long").withColumn("posted_at", F.lit("2024-01-01").cast("timestamp"))
    hours = F.expr("make_dt_interval(0, h)")
    likes = spark.createDataFrame([(10, 1, 1), (10, 7, 2), (10, 8, 3), (10, 9, 30), (11, 4, 1), (11, 5, 1), (11, 6, 1)], "post_id long, user_id long, h int")
    likes = likes.withColumn("liked_at", F.lit("2024-01-01").cast("timestamp") + hours)
    out = J.viral_posts(posts, likes, follows, min_likes=2).collect()
    assert [(r.post_id, r.likes, r.strangers) for r in out] == [(10, 3, 2)]
    users = spark.createDataFrame([(1,), (2,), (9,)], "user_id long")
    act = spark.createDataFrame([(2,), (2,), (9,)], "author_id long")
    rate = {r.user_id: r.engagement_rate for r in J.engagement(users, act, act.limit(0), follows).collect()}
    assert rate == {2: 1.0, 1: 0.0, 9: None}


def test_rows_of_one_owner(spark):
    from tidemark.operators.ranking import newest_first, rows_of

    rows = spark.createDataFrame([(1, 5, "a"), (1, 9, "b"), (1, 9, "c"), (2, 1, "d")], "o int, t long, x string")
    rows = rows.withColumn("t", F.timestamp_seconds("t"))
    assert [r.x for r in rows_of(rows, "o", 1, ["x"], "t", "x").collect()] == ["b", "c", "a"]
    for how in ({"mode": "window"}, {"mode": "chunked", "chunks": 3}):
        got = {r.x: r.position for r in newest_first(rows, "o", "t", "x", **how).collect()}
        assert got == {"b": 1, "c": 2, "a": 3, "d": 1}


def test_fallback_and_drift(spark):
    users = spark.createDataFrame([(1,), (2,)], "u long")
    own = spark.createDataFrame([(1, "x")], "u long, i string")
    pop = spark.createDataFrame([("best", 9)], "i string, n int")
    got = {r.u: (r.i, r.is_fallback) for r in with_fallback(users, own, pop, "u", "i").collect()}
    assert got == {1: ("x", False), 2: ("best", True)}
    a = spark.range(100).select(F.col("id").cast("double").alias("v"))
    assert psi(a, a, "v", [25, 50, 75]).agg(F.sum("term")).first()[0] == 0
    moved = a.withColumn("v", F.col("v") + 30)
    assert psi(a, moved, "v", [25, 50, 75]).agg(F.sum("term")).first()[0] > 0.2


def test_the_timeline_is_worked_out_once(spark):
    day = lambda c: F.to_date(F.lit(c))
    dim = spark.range(20).select((F.col("id") % 4).alias("k"), F.date_add(day("2024-01-01"), F.col("id").cast("int")).alias("a"), F.lit(None).cast("date").alias("b"), F.col("id").alias("v"))
    facts = spark.range(4).select(F.col("id").alias("k"), F.col("id").alias("n"), day("2024-03-01").alias("at"))
    got = J.version_at(facts, dim, "k", "at", "a", "b", "n")
    assert "Generate" not in got._jdf.queryExecution().executedPlan().toString()
    assert {(r.k, r.v) for r in got.collect()} == {(0, 16), (1, 17), (2, 18), (3, 19)}
