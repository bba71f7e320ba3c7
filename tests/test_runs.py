"""Islands, rallies, retail windows: answers by hand."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

import fixtures as X
from tidemark.operators import aggregates as A
from tidemark.operators import ranking as R
from tidemark.operators import runs as N
from tidemark.operators.ordered import global_ranks

TS = datetime.fromisoformat
MODES = pytest.mark.parametrize("how", [{"mode": "window"}, {"mode": "chunked", "chunks": 4}])


@pytest.fixture(scope="module")
def servers(spark):
    return spark.createDataFrame(X.SERVERS, "server int, ts timestamp_ntz, status string, cpu int")


@MODES
def test_healthy_days(spark, how):
    days = spark.createDataFrame(X.SERVER_DAYS, "log_id int, day date, status string").withColumn("one", F.lit(1))
    runs = R.step_runs(days.filter("status = 'healthy'"), ["one"], "day", "1 DAY", **how)
    assert sorted(r.log_id for r in R.long_run_rows(runs, 4).collect()) == [4, 5, 6, 7, 8]


@MODES
def test_rally(spark, how):
    s = spark.createDataFrame(X.STOCK, "day_id int, day date, price int").withColumn("ticker", F.lit("ABC"))
    runs = R.state_runs(s, ["ticker"], ["day"], F.col("price") > 150, **how)
    got = sorted(r.day_id for r in R.long_run_rows(runs, 3).filter("_state").collect())
    assert got == [5, 6, 7, 8]


@MODES
def test_longest_uptime(servers, how):
    up = servers.filter(F.col("status").isin("healthy", "maintenance"))
    hourly = R.longest_run(R.run_summary(R.step_runs(up, ["server"], "ts", "1 HOUR", **how), "ts"), ["server"])
    got = {r.server: (r.run_start, r.points) for r in hourly.collect()}
    assert got == {1: (TS("2025-01-01 10:00"), 1), 2: (TS("2025-01-10 10:00"), 1), 3: (TS("2025-01-10 17:00"), 1), 4: (TS("2025-01-10 10:00"), 2)}
    daily = R.longest_run(R.run_summary(R.step_runs(up, ["server"], "ts", "1 DAY", **how), "ts"), ["server"])
    one = daily.filter("server = 1").first()
    assert (one.run_start, one.run_end, one.points) == (TS("2025-01-04 10:00"), TS("2025-01-09 10:00"), 6)


def test_high_cpu(servers):
    hot = servers.filter("server = 2 AND cpu > 90")
    runs = R.run_summary(R.step_runs(hot, ["server"], "ts", "1 HOUR"), "ts", F.avg("cpu").alias("avg_cpu"))
    row = runs.filter("points >= 3").collect()
    assert [(r.run_start.hour, r.run_end.hour, round(r.avg_cpu, 2)) for r in row] == [(13, 15, 95.67)]


@MODES
def test_state_reversals(servers, how):
    runs = R.state_runs(servers.filter("server = 1"), ["server"], ["ts"], F.col("status") == "down", **how)
    got = [(r.run_start.day, r.run_end.day, r.points, r.down) for r in R.run_summary(runs, "ts", F.first("_state").alias("down")).orderBy("run_start").collect()]
    assert got == [(1, 2, 2, False), (3, 3, 1, True), (4, 9, 6, False)]


def test_collective_instability(servers):
    got = R.collective_runs(servers.filter("status = 'unstable'"), "server", "ts", "1 HOUR", 2, 6).collect()
    assert [(r.run_start.hour, r.run_end.hour, r.points) for r in got] == [(11, 16, 6)]


def test_retail_windows(spark):
    days = spark.createDataFrame(X.STORE_DAYS, "store int, day date, revenue int")
    roll = A.rolling_rows(days, ["store"], "day", "revenue", 7).orderBy("store", "day").collect()
    assert [round(r.rolling_avg, 2) for r in roll] == [1000, 1100, 1033.33, 1150, 800, 950, 1066.67]
    assert R.consecutive_drops(days, ["store"], "day", "revenue", 3).count() == 0
    sales = spark.createDataFrame(X.FACT_SALES, "product_key int, customer_id int, day date, quantity int, revenue int")
    months = sales.groupBy(F.date_format("day", "yyyy-MM").alias("m")).agg(F.sum("revenue").alias("v"))
    got = [(r.m, r.growth_pct) for r in A.growth(months, [], "m", "v").orderBy("m").collect()]
    assert got == [("2023-06", None), ("2024-02", -37.5), ("2024-03", 140.0)]
    spent = sales.groupBy("customer_id").agg(F.sum("revenue").alias("v"))
    ranks = {r.customer_id: r.dense_rank for r in global_ranks(spent, "v", ["customer_id"]).collect()}
    assert ranks == {1: 1, 2: 2}
    dim = spark.createDataFrame(X.DIM_PRODUCT, "product_key int, product_id string, name string, material string, start date, end date, is_current boolean")
    now = sales.join(dim.filter("is_current"), "product_key").groupBy("name").agg(F.sum("revenue").alias("v"))
    assert {r.name: r.v for r in now.collect()} == {"Classic Crew": 25, "Slim Fit": 60}
    people = spark.createDataFrame(X.DIM_CUSTOMER, "customer_id int, customer string, region string")
    top = sales.join(dim, "product_key").join(people, "customer_id").groupBy("region", "product_id").agg(F.sum("revenue").alias("v"))
    best = {r.region: (r.product_id, r.v) for r in R.top_n_per_group(top, ["region"], [F.desc("v")], 1).collect()}
    assert best == {"North": ("TEE-01", 65), "South": ("JEAN-01", 60)}


def test_top_n_limits_before_the_shuffle(spark):
    rows = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    plan = R.top_n_per_group(rows, ["k"], [F.desc("id")], 2)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_run_length_round_trip(spark):
    points = spark.range(48).select(
        (F.col("id") % 2).alias("s"),
        F.expr("TIMESTAMP_NTZ '2024-01-01' + make_dt_interval(0, cast(id div 2 as int))").alias("ts"),
        F.floor(F.col("id") / 12).alias("value"),
    )
    runs = N.encode(points, ["s"], ["ts"], F.col("value"))
    assert runs.count() == 8
    back = N.decode(runs, ["s"], "1 HOUR").select("s", "ts", "value")
    assert back.exceptAll(points).count() == 0 and points.exceptAll(back).count() == 0
    cut = N.in_range(runs, TS("2024-01-01 03:00"), TS("2024-01-01 07:00"))
    assert cut.count() == 4 and cut.agg(F.max("clip_end")).first()[0] == TS("2024-01-01 07:00")


def test_median_matches_builtin(spark):
    rows = spark.range(1000).select((F.col("id") % 7).alias("k"), (F.col("id") * 37 % 101).alias("v"))
    want = {r.k: r.m for r in rows.groupBy("k").agg(F.median("v").alias("m")).collect()}
    for how in ({"mode": "window"}, {"mode": "chunked", "chunks": 5}):
        assert {r.k: r.median for r in A.exact_median(rows, ["k"], "v", **how).collect()} == want


def test_slope_and_share(spark):
    rows = spark.createDataFrame([("a", 1, 3), ("a", 2, 2), ("a", 3, 1), ("b", 1, 1), ("b", 2, 5)], "k string, i long, v long")
    rows = rows.withColumn("v", F.col("v").cast("decimal(18,2)"))
    assert {r.k: r.slope for r in A.trend_slope(rows, ["k"], "i", "v").collect()} == {"a": -1.0, "b": 4.0}
    spend = spark.range(20).select(F.lit("p").alias("p"), "id", F.col("id").cast("decimal(18,2)").alias("v"))
    got = sorted(r.id for r in A.top_share(spend, ["p"], "id", "v", 0.1).collect())
    assert got == [18, 19]
