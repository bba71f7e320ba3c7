import numpy as np
from pyspark.sql import functions as F

from tidemark.functions import columns as C
from tidemark.functions import text as X
from tidemark.operators import costs as K
from tidemark.operators import retrieval as R
from datetime import date


def test_sql_checks(spark):
    texts = [
        "SELECT * FROM aws_costs WHERE date >= '2026-01-01'", "DROP TABLE aws_costs", "UPDATE aws_costs SET cost = 0",
        "SELECT * FROM aws_costs; DELETE FROM aws_costs;", "select created_at from AWS_COSTS;", "SELECT 1 FROM other",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, q string")
    got = {r.i: r.e for r in df.select("i", X.sql_errors(F.col("q")).alias("e")).collect()}
    assert got[0] == [] and got[4] == []
    assert got[1] == ["Forbidden keyword: DROP", "Only SELECT queries are allowed"]
    assert "Only SELECT queries are allowed" in got[2] and "Forbidden keyword: UPDATE" in got[2]
    assert got[3] == ["Forbidden keyword: DELETE", "Multiple statements not allowed"]
    assert got[5] == ["Query must reference one of: aws_costs, azure_costs, gcp_costs"]


def test_clean_sql_and_screen(spark):
    df = spark.createDataFrame([("```sql\nSELECT  a\n FROM t;;\n```",)], "q string")
    assert df.select(X.clean_sql(F.col("q"))).first()[0] == "SELECT a FROM t;"
    q = spark.createDataFrame([("hi",), ("What is our spend?",), ("drop it",), ("a--b",), ("x" * 501,)], "q string")
    assert [r[0] for r in q.select(X.question_ok(F.col("q"))).collect()] == [False, True, False, False, False]


def test_categories_and_follow_ups(spark):
    q = spark.createDataFrame([(1, "Which table has a column for it?"), (2, "hello"), (3, "Define the policy")], "i int, q string")
    got = {r.i: r.c for r in q.select("i", X.categories(F.col("q")).alias("c")).collect()}
    assert got == {1: ["schema"], 2: list(X.CATEGORY_WORDS), 3: ["business_rules", "glossary"]}
    turns = spark.createDataFrame([(1, 0, "Show cost"), (1, 2, "and by team"), (1, 4, "The item list"), (2, 0, "that one")], "conv long, turn long, t string")
    for how in ({"mode": "window"}, {"mode": "chunked", "chunks": 3}):
        out = R.follow_ups(turns, "conv", "turn", "t", **how).collect()
        assert [(r.conv, r.turn, r.previous_text) for r in out] == [(1, 2, "Show cost")]
    assert turns.select(X.question_class(F.col("t"))).first()[0] == "cost"
    assert X.MULTI_STEP_PHRASES and q.filter(X.contains_any(F.col("q"), ["DEFINE"])).count() == 1


def test_confidence(spark):
    rows = [(1, i, "SELECT SUM(x) FROM t") for i in range(3)]
    rows += [(2, 0, "a JOIN b JOIN c JOIN d"), (2, 1, "z"), (3, 0, "SELECT a FROM (SELECT b)")]
    df = spark.createDataFrame(rows, "q long, n int, s string")
    got = {r.q: (round(r.confidence, 6), r.band) for r in R.attempt_confidence(df, "q", "n", "s").collect()}
    assert got == {1: (1.0, "high"), 2: (0.63, "low"), 3: (0.85, "medium")}
    assert spark.range(1).select(X.answer_band(F.lit(95)), X.answer_band(F.lit(70)), X.answer_band(F.lit(69.9))).first() == ("high", "medium", "low")


def test_accuracy_cache_feedback_knowledge(spark):
    want = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "k int, v string")
    got = spark.createDataFrame([(1, "a"), (2, "x")], "k int, v string")
    row = R.accuracy(got, want, "k", "v").first()
    assert (row.cases, row.correct, row.failed) == (3, 2, 1)
    assert [r.k for r in R.failures(got, want, "k", "v").collect()] == [2]
    log = spark.createDataFrame([("A ",), ("a",), ("b",)], "q string")
    s = R.cache_stats(log, C.normal_key("q")).first()
    assert (s.requests, s.hits, s.misses) == (3, 1, 2)
    fb = spark.createDataFrame([("q1", "s1", True), ("q2", "s2", False)], "question string, sql string, correct boolean")
    assert [r.text for r in R.approved_examples(fb).collect()] == ["Q: q1 | SQL: s1"]
    base = spark.createDataFrame([(["x", "y"], ["z"])], "schema array<string>, glossary array<string>")
    assert sorted((r.doc_id, r.text) for r in R.knowledge_rows(base, ["schema", "glossary"]).collect()) == [("glossary_0", "z"), ("schema_0", "x"), ("schema_1", "y")]


def test_nearest_in_blocks_matches_brute_force(spark, sf):
    vecs = spark.read.parquet(f"{sf}/embeddings.parquet")
    asked = vecs.select(F.col("vec_id").alias("question_id"), "embedding", "label")
    rows = vecs.orderBy("vec_id").collect()
    m = np.array([r.embedding for r in rows], dtype=float)
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    sims = m @ m.T
    hits = {}
    for r in R.nearest(vecs, asked, 5, block=200).collect():
        hits.setdefault(r.question_id, {})[r["rank"]] = (r.vec_id, r.similarity)
    assert len(hits) == len(rows)
    for i in range(len(rows)):
        best = np.sort(sims[i])[::-1][:5]
        assert np.allclose([hits[i][k][1] for k in range(1, 6)], best) and hits[i][1][0] == i
    labels = np.array([r.label for r in rows])
    for r in R.nearest(vecs, asked, 3, category="label").filter("rank = 3").collect():
        same = np.sort(sims[r.question_id][labels == labels[r.question_id]])[::-1]
        assert np.isclose(r.similarity, same[2])
    zero = spark.createDataFrame([(1, [0.0, 0.0]), (2, [1.0, 0.0])], "vec_id long, embedding array<float>")
    one = spark.createDataFrame([(9, [1.0, 1.0])], "question_id long, embedding array<float>")
    assert [r.vec_id for r in R.nearest(zero, one, 5).collect()] == [2]


def test_nearest_defines_odd_rows_ties_and_many_questions(spark):
    rows = [(i, [1.0, 0.0], "a") for i in range(9, 0, -1)] + [
        (20, None, "a"), (21, [], "a"), (22, [None, 1.0], "a"), (23, [float("nan"), 1.0], "a"),
        (24, [1.0, 0.0, 0.0], "a"), (None, [1.0, 0.0], "a"), (25, [0.5, 0.5], None),
    ]
    vecs = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")
    many = spark.range(5000).select(F.concat(F.lit("q"), "id").alias("question_id"), F.expr("array(2D, 0D)").alias("embedding"), F.expr("IF(id % 2 = 0, 'a', NULL)").alias("label"))
    hits = R.nearest(vecs, many, 3).groupBy("question_id").agg(F.sort_array(F.collect_list("vec_id")).alias("v"))
    assert hits.groupBy("v").count().collect() == [([1, 2, 3], 5000)]
    both = R.nearest_both(vecs, many, 3, "label").groupBy("inside").agg(F.count("*").alias("n"), F.max("vec_id").alias("v"))
    assert {(r.inside, r.n, r.v) for r in both.collect()} == {(False, 15000, 3), (True, 7500, 3)}
    text = R.nearest(vecs, many, 3)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert R.nearest(vecs.limit(0), many, 3).count() == 0 and R.nearest(vecs, many.limit(0), 3).count() == 0


def test_hybrid_and_contexts(spark):
    a = spark.createDataFrame([(1, 10, 1), (1, 11, 2)], "q long, v long, rank int")
    b = spark.createDataFrame([(1, 11, 1), (1, 12, 2), (1, 13, 3)], "q long, v long, rank int")
    out = R.hybrid(a, b, "q", "v", 3)
    assert [r.v for r in out.orderBy("position").collect()] == [10, 11, 12]
    text = out.withColumn("t", F.col("v").cast("string"))
    assert R.contexts(text, "q", "position", "t").first().context == "10\n\n11\n\n12"


def test_masks_json_and_transforms(spark):
    df = spark.createDataFrame([("hr", "123-45-6789", '{"metadata":{"browser":"ff"},"l":[{"name":"n"}]}')], "r string, s string, j string")
    mask = C.mask_for(F.col("r"), ["hr"], F.col("s"))
    assert df.select(mask).first()[0] == "123-45-6789"
    assert df.withColumn("r", F.lit("ops")).select(mask).first()[0] == "XXX-XX-6789"
    assert df.select(C.json_value("j", "$.metadata.browser"), C.json_value("j", "$.l[0].name")).first() == ("ff", "n")
    assert [r.item for r in C.json_items(df, "j", "$.l").collect()] == ['{"name":"n"}']
    assert df.select(C.json_value(F.lit("not json"), "$.a")).first()[0] is None
    pii = df.select(F.lit("mail a@b.io or 10.0.0.1, 123-45-6789").alias("t"))
    assert pii.select(X.hide_pii(F.col("t"))).first()[0] == "mail <email> or <ip>, <ssn>"
    assert pii.select(X.wraps_column(F.lit("select 1 where date(ts) = 1"), "ts"), X.wraps_column(F.lit("select f(ts) where ts > 1"), "ts")).first() == (True, False)


def test_cost_rules(spark):
    files = spark.createDataFrame([(10, 20e12), (200, 80e12)], "age int, bytes double")
    out = {r.tier: (r.monthly_cost, r.saved) for r in K.tier_costs(files, "age", "bytes").collect()}
    assert round(out["archive"][1]) == 1520 and round(out["standard"][0]) == 460
    row = spark.range(1).select(K.request_cost(F.lit(20_000_000), F.lit(1000)), K.request_cost(F.lit(4000), F.lit(1000))).first()
    assert round(row[0]) == 240_000 and round(row[1]) == 48
    t = spark.createDataFrame([("permanent", 1, 100.0), ("permanent", 7, 100.0), ("transient", 1, 100.0), ("external", 0, 100.0)], "table_type string, retention_days int, size_gb double")
    assert [r.total_gb for r in K.storage_footprint(t).collect()] == [200, 800, 100, 0]
    use = spark.createDataFrame([("w", 1, 50), ("w", 2, 30), ("w", 3, 25)], "w string, d int, c long")
    got = {r.level: r.first_period for r in K.quota_crossings(use, ["w"], "d", "c", 100).collect()}
    assert got == {75: 2, 90: 3, 100: 3}
    costs = spark.createDataFrame([("a", date(2024, 1, 1), 600.0), ("b", date(2024, 1, 2), 10.0)], "team string, date date, cost double")
    budgets = spark.createDataFrame([("a", 1000.0), ("b", 1000.0), ("c", 5.0)], "team string, budget double")
    over = {r.team: r.over_budget for r in K.budget_outlook(costs, budgets, date(2024, 1, 11), date(2024, 1, 1), date(2024, 2, 1)).collect()}
    assert over == {"a": True, "b": False, "c": False}
    daily = spark.createDataFrame([("x", date(2024, 1, d), c) for d, c in ((1, 100), (2, 131), (4, 500))], "team string, date date, cost long")
    assert [(r.date.day, round(r.rise, 2)) for r in K.daily_spikes(daily, ["team"]).collect()] == [(2, 0.31)]
    odd = K.anomalies(daily, ["team"]).orderBy("date").collect()
    assert [r.date.day for r in odd] == [2, 4]
    shares = spark.createDataFrame([("development", "Engineering", 0.5), ("development", "Data", 0.5)], "environment string, team string, share double")
    c = spark.createDataFrame([("development", "any", 100), ("production", "Web", 7)], "environment string, team string, cost int").withColumn("cost", F.col("cost").cast("decimal(18,2)"))
    split = {r.team: float(r.cost) for r in K.allocate(c, shares, "environment").collect()}
    assert split == {"Engineering": 50, "Data": 50, "Web": 7}


def test_expected_counts_null_spikes_and_scores(spark):
    from tidemark.operators import quality as Q

    rows = [(f"2024-01-0{d}", None if i < bad else 1.0) for d, bad in ((1, 1), (2, 1), (3, 4), (4, 10)) for i in range(10)]
    df = spark.createDataFrame(rows, "d string, v double").withColumn("day", F.to_date("d"))
    spikes = Q.null_spikes(df, F.col("day"), F.col("v"), 2, 0.25)
    assert [(str(r.day), r.nulls, round(r.usual_rate, 6)) for r in spikes.orderBy("day").collect()] == [("2024-01-03", 4, 0.1), ("2024-01-04", 10, 0.25)]
    scores = Q.scores_over_time(df, F.col("day"), {"set": F.col("v").isNotNull(), "any": F.lit(True)}, 0.9).orderBy("period").collect()
    assert [(r.set, r.score, r.meets_target) for r in scores] == [(1, 0.95, True), (1, 0.95, True), (4, 0.8, False), (10, 0.5, False)]
    assert Q.kept_and_removed(df, F.col("v") > 0, F.lit(25)).first()[:] == (40, 24, 16, 25, False)
    assert Q.null_spikes(df.limit(0), F.col("day"), F.col("v"), 2, 0.2).count() == 0


def test_idle_consumers_and_answer_times(spark):
    bill = spark.createDataFrame([(1, 2.0), (1, 3.0), (2, 4.0), (None, 1.0)], "u long, cost double")
    use = spark.createDataFrame([(2,), (2,), (None,)], "u long")
    assert {r[:] for r in K.idle_consumers(bill, use, "u").collect()} == {(1, 5.0, 2), (None, 1.0, 1)}
    rows = [(1, "2024-01-01 00:00:00", "q"), (1, "2024-01-01 00:00:03", "a"), (1, "2024-01-01 00:00:04", "q"), (1, "2024-01-01 00:00:05", "x"), (None, "2024-01-01 00:00:06", "q"), (None, "2024-01-01 00:00:07", "a")]
    log = spark.createDataFrame(rows, "u long, t string, k string").withColumn("ts", F.to_timestamp_ntz("t")).withColumn("i", F.monotonically_increasing_id())
    out = K.answer_times(log, "u", "ts", "i", F.col("k") == "q", F.col("k") == "a").collect()
    assert [(r.questions, r.answered, r.mean_seconds, r.longest_seconds) for r in out] == [(3, 2, 2.0, 3.0)]
    seen = K.time_per_user(log, "u", F.lit(2), "ts", F.lit("2024-01-01 00:00:06").cast("timestamp_ntz")).collect()
    assert {(r.u, r.requests, r.time_spent, r.idle) for r in seen} == {(1, 4, 8, True), (None, 2, 4, False)}
