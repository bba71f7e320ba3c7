"""Ranks, running values and runs over the mapped tables.

Inputs with one row per key and day, hour or month are bounded by the calendar, so
they use the plain window; raw rows go through the measured ordered scan.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.functions.columns import year_month
from tidemark.operators import aggregates as A
from tidemark.operators import ranking as R
from tidemark.operators.ordered import global_ranks
from tidemark.plans.frames import (
    AS_OF,
    COSTS,
    CUSTOMERS,
    ORDERS,
    SALES,
    STORE_DAYS,
    costs,
    customers,
    events,
    orders,
    sales,
    store_days,
)
from tidemark.plans.registry import query, table


@query(
    "customer_spend",
    f"""WITH {ORDERS} SELECT order_id, CAST(SUM(amount) OVER (PARTITION BY customer_id) AS DOUBLE) AS total_spend,
    strftime(MIN(order_date) OVER (PARTITION BY customer_id), '%Y-%m-%d') AS first_order FROM ord""",
)
def customer_spend(spark, sf):
    """Customer totals on every order, by pre-aggregation and a join back."""
    o = orders(spark, sf).select("order_id", "customer_id", "amount", "order_date")
    totals = A.with_group_totals(
        o, ["customer_id"], total_spend=F.sum("amount"), first_order=F.min("order_date").cast("date")
    )
    return totals.select("order_id", "total_spend", "first_order")


@query(
    "days_since_first",
    """SELECT o_custkey, date_diff('day', MIN(CAST(o_orderdate AS DATE)), DATE '1998-08-01') AS days FROM orders GROUP BY 1""",
)
def days_since_first(spark, sf):
    first = F.min(F.col("o_orderdate").cast("date"))
    return table(spark, sf, "orders").groupBy("o_custkey").agg(F.datediff(F.lit(AS_OF), first).alias("days"))


@query(
    "rolling7",
    f"""WITH {STORE_DAYS} SELECT store, strftime(day, '%Y-%m-%d') AS day,
    CAST(SUM(revenue) OVER w AS DOUBLE) / COUNT(revenue) OVER w AS rolling_avg FROM store_days
    WINDOW w AS (PARTITION BY store ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""",
)
def rolling7(spark, sf):
    """Mean of the last seven rows of a store; windows run over one row per day."""
    return A.rolling_rows(store_days(spark, sf), ["store"], "day", "revenue", 7).select("store", "day", "rolling_avg")


@query(
    "rolling7_days",
    f"""WITH {STORE_DAYS} SELECT store, strftime(day, '%Y-%m-%d') AS day,
    CAST(SUM(revenue) OVER w AS DOUBLE) / COUNT(revenue) OVER w AS rolling_avg FROM store_days
    WINDOW w AS (PARTITION BY store ORDER BY day RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW)""",
)
def rolling7_days(spark, sf):
    return A.rolling_days(store_days(spark, sf), ["store"], "day", "revenue", 7).select("store", "day", "rolling_avg")


MONTHS = f"""{ORDERS}, m AS (SELECT strftime(order_date, '%Y-%m') AS month, SUM(amount) AS revenue FROM ord GROUP BY 1)"""


def _months(spark, sf):
    return orders(spark, sf).groupBy(year_month("order_date").alias("month")).agg(F.sum("amount").alias("revenue"))


@query(
    "mom_growth",
    f"""WITH {MONTHS}, p AS (SELECT *, lag(revenue) OVER (ORDER BY month) AS prev FROM m)
    SELECT month, CAST(revenue AS DOUBLE) AS revenue, CAST(prev AS DOUBLE) AS previous,
    CAST(revenue - prev AS DOUBLE) * 100 / NULLIF(CAST(prev AS DOUBLE), 0) AS growth_pct FROM p""",
)
def mom_growth(spark, sf):
    """The window without a key runs over one row per month."""
    return A.growth(_months(spark, sf), [], "month", "revenue").select("month", "revenue", "previous", "growth_pct")


@query(
    "mom_growth_by_region",
    f"""WITH {CUSTOMERS}, {ORDERS}, m AS (SELECT region, strftime(order_date, '%Y-%m') AS month, SUM(amount) AS revenue
    FROM ord JOIN cust USING (customer_id) GROUP BY 1, 2),
    p AS (SELECT *, lag(revenue) OVER (PARTITION BY region ORDER BY month) AS prev FROM m)
    SELECT region, month, CAST(revenue - prev AS DOUBLE) * 100 / NULLIF(CAST(prev AS DOUBLE), 0) AS growth_pct FROM p""",
)
def mom_growth_by_region(spark, sf):
    per = orders(spark, sf).groupBy("customer_id", year_month("order_date").alias("month")).agg(F.sum("amount").alias("r"))
    monthly = (
        per.join(customers(spark, sf).select("customer_id", "region"), "customer_id")
        .groupBy("region", "month").agg(F.sum("r").alias("revenue"))
    )
    return A.growth(monthly, ["region"], "month", "revenue").select("region", "month", "growth_pct")


@query(
    "running_total",
    f"""WITH {MONTHS} SELECT month, CAST(SUM(revenue) OVER (ORDER BY month) AS DOUBLE) AS running_total FROM m""",
)
def running_total(spark, sf):
    return A.running_total(_months(spark, sf), [], "month", "revenue").select("month", "running_total")


@query(
    "product_running_total",
    f"""WITH {SALES}, d AS (SELECT product, CAST(sale_date AS DATE) AS day, SUM(revenue) AS r FROM sales GROUP BY 1, 2)
    SELECT product, strftime(day, '%Y-%m-%d') AS day, CAST(SUM(r) OVER (PARTITION BY product ORDER BY day) AS DOUBLE) AS running_total FROM d""",
)
def product_running_total(spark, sf):
    daily = sales(spark, sf).groupBy("product", F.col("sale_date").cast("date").alias("day")).agg(F.sum("revenue").alias("r"))
    return A.running_total(daily, ["product"], "day", "r").select("product", "day", "running_total")


@query(
    "rank_in_segment",
    """SELECT c_custkey, rank() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal DESC) AS rank,
    dense_rank() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal DESC) AS dense_rank FROM customer""",
)
def rank_in_segment(spark, sf):
    """Full ranking inside large groups by the ordered scan."""
    people = table(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    ranked = R.rank_in_group(people, ["c_mktsegment"], "c_acctbal", ["c_custkey"])
    return ranked.select("c_custkey", "rank", "dense_rank")


@query(
    "customer_rankings",
    f"""WITH {CUSTOMERS}, s AS (SELECT o_custkey AS customer_id, SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS spent FROM orders GROUP BY 1),
    r AS (SELECT country, customer_id, spent, dense_rank() OVER (PARTITION BY country ORDER BY spent DESC) AS rank,
    row_number() OVER (PARTITION BY country ORDER BY spent DESC, customer_id) AS row_num FROM s JOIN cust USING (customer_id))
    SELECT country, customer_id, CAST(spent AS DOUBLE) AS spent, rank, row_num FROM r WHERE row_num <= 2""",
)
def customer_rankings(spark, sf):
    """The two best customers of a country with dense rank and row number."""
    spent = orders(spark, sf).groupBy("customer_id").agg(F.sum("amount").alias("spent"))
    home = spent.join(customers(spark, sf).select("customer_id", "country"), "customer_id")
    best = R.top_n_per_group(home, ["country"], [F.desc("spent"), F.asc("customer_id")], 2, "row_num")
    # Dense rank among the first rows equals the dense rank in the whole group.
    w = Window.partitionBy("country").orderBy(F.desc("spent"))
    return best.withColumn("rank", F.dense_rank().over(w)).select("country", "customer_id", "spent", "rank", "row_num")


@query(
    "top2_per_region",
    f"""WITH {SALES}, {CUSTOMERS}, s AS (SELECT region, product, SUM(revenue) AS r FROM sales
    JOIN orders ON order_id = o_orderkey JOIN cust ON o_custkey = customer_id GROUP BY 1, 2),
    n AS (SELECT *, row_number() OVER (PARTITION BY region ORDER BY r DESC, product) AS rn FROM s)
    SELECT region, product, CAST(r AS DOUBLE) AS revenue, rn FROM n WHERE rn <= 2""",
)
def top2_per_region(spark, sf):
    """Orders get their region before the line items come, which move by order only once."""
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"))
    regions = o.join(customers(spark, sf).select("customer_id", "region"), "customer_id").select("order_id", "region")
    per = (
        sales(spark, sf).select("order_id", "product", "revenue").join(regions, "order_id")
        .groupBy("region", "product").agg(F.sum("revenue").alias("revenue"))
    )
    return R.top_n_per_group(per, ["region"], [F.desc("revenue"), F.asc("product")], 2)


@query(
    "clv_rank",
    f"""WITH {ORDERS}, s AS (SELECT customer_id, SUM(amount) AS v FROM ord GROUP BY 1)
    SELECT customer_id, CAST(v AS DOUBLE) AS lifetime_value, dense_rank() OVER (ORDER BY v DESC) AS dense_rank,
    rank() OVER (ORDER BY v DESC) AS rank, row_number() OVER (ORDER BY v DESC, customer_id) AS row_num FROM s""",
)
def clv_rank(spark, sf):
    """A rank over all customers without a single-task window."""
    spent = orders(spark, sf).groupBy("customer_id").agg(F.sum("amount").alias("lifetime_value"))
    return global_ranks(spent, "lifetime_value", ["customer_id"], mode="chunked")


@query(
    "top3_customers",
    f"""WITH {ORDERS} SELECT customer_id, CAST(SUM(amount) AS DOUBLE) AS total FROM ord GROUP BY 1 ORDER BY SUM(amount) DESC, customer_id LIMIT 3""",
)
def top3_customers(spark, sf):
    return R.top_n(
        orders(spark, sf).groupBy("customer_id").agg(F.sum("amount").alias("total")),
        [F.desc("total"), F.asc("customer_id")], 3,
    )


@query(
    "consecutive_drops",
    f"""WITH {STORE_DAYS}, f AS (SELECT store, day, CASE WHEN revenue < lag(revenue) OVER w THEN 1 ELSE 0 END AS fell FROM store_days
    WINDOW w AS (PARTITION BY store ORDER BY day)), r AS (SELECT store, SUM(fell) OVER (PARTITION BY store ORDER BY day
    ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS run FROM f) SELECT DISTINCT store FROM r WHERE run = 7""",
)
def consecutive_drops(spark, sf):
    """Stores whose revenue fell seven times in a row."""
    return R.consecutive_drops(store_days(spark, sf), ["store"], "day", "revenue", 7)


USER_DAYS = """ud AS (SELECT user_id, CAST(ts AS DATE) AS day, COUNT(*) AS n FROM events GROUP BY 1, 2)"""


def _user_days(spark, sf):
    return events(spark, sf).groupBy("user_id", F.col("ts").cast("date").alias("day")).agg(F.count("*").alias("n"))


ISLANDS = f"""{USER_DAYS}, g AS (SELECT user_id, day, day - CAST(row_number() OVER (PARTITION BY user_id ORDER BY day) AS INTEGER) AS island FROM ud),
    r AS (SELECT user_id, island, MIN(day) AS run_start, MAX(day) AS run_end, COUNT(*) AS points FROM g GROUP BY 1, 2)"""


@query(
    "islands_events",
    f"""WITH {ISLANDS} SELECT user_id, strftime(run_start, '%Y-%m-%d') AS run_start, strftime(run_end, '%Y-%m-%d') AS run_end, points
    FROM r WHERE points >= 4""",
)
def islands_events(spark, sf):
    """Runs of at least four consecutive active days."""
    runs = R.run_summary(R.step_runs(_user_days(spark, sf), ["user_id"], "day", "1 DAY", mode="window"), "day")
    return runs.filter("points >= 4").drop("island")


@query(
    "longest_streak",
    f"""WITH {ISLANDS}, n AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY points DESC, run_start) AS k FROM r)
    SELECT user_id, strftime(run_start, '%Y-%m-%d') AS run_start, strftime(run_end, '%Y-%m-%d') AS run_end, points FROM n WHERE k = 1""",
)
def longest_streak(spark, sf):
    runs = R.run_summary(R.step_runs(_user_days(spark, sf), ["user_id"], "day", "1 DAY", mode="window"), "day")
    return R.longest_run(runs, ["user_id"]).drop("island")


@query(
    "streak_rows",
    f"""WITH {ISLANDS} SELECT g.user_id, strftime(g.day, '%Y-%m-%d') AS day, r.points FROM g JOIN r USING (user_id, island) WHERE r.points >= 5""",
)
def streak_rows(spark, sf):
    """The member days of long runs."""
    rows = R.long_run_rows(R.step_runs(_user_days(spark, sf), ["user_id"], "day", "1 DAY", mode="window"), 5)
    return rows.select("user_id", "day", "points")


@query(
    "rally",
    f"""WITH {STORE_DAYS}, s AS (SELECT *, revenue > 100000 AS up FROM store_days),
    f AS (SELECT *, CASE WHEN up IS DISTINCT FROM lag(up) OVER (PARTITION BY store ORDER BY day) THEN 1 ELSE 0 END AS turn FROM s),
    g AS (SELECT *, SUM(turn) OVER (PARTITION BY store ORDER BY day) AS island FROM f),
    n AS (SELECT *, COUNT(*) OVER (PARTITION BY store, island) AS points FROM g)
    SELECT store, strftime(day, '%Y-%m-%d') AS day, CAST(revenue AS DOUBLE) AS revenue FROM n WHERE up AND points >= 3""",
)
def rally(spark, sf):
    """Rows above a level, three or more in a row by trading day order."""
    runs = R.state_runs(store_days(spark, sf), ["store"], ["day"], F.col("revenue") > 100000, mode="window")
    return R.long_run_rows(runs, 3).filter("_state").select("store", "day", "revenue")


HOURS = """h AS (SELECT user_id % 5 AS server, date_trunc('hour', ts) AS hour, COUNT(*) AS load,
    COUNT(*) FILTER (WHERE event_type = 'error') AS errors FROM events GROUP BY 1, 2)"""


def _server_hours(spark, sf):
    """Users grouped into five servers; load and errors per hour."""
    return (
        events(spark, sf)
        .groupBy((F.col("user_id") % 5).alias("server"), F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour"))
        .agg(F.count("*").alias("load"), F.count_if(F.col("event_type") == "error").alias("errors"))
    )


@query(
    "high_usage",
    f"""WITH {HOURS}, g AS (SELECT *, hour - row_number() OVER (PARTITION BY server ORDER BY hour) * INTERVAL 1 HOUR AS island
    FROM h WHERE load > 2) SELECT server, strftime(MIN(hour), '%Y-%m-%d %H:%M:%S') AS run_start,
    strftime(MAX(hour), '%Y-%m-%d %H:%M:%S') AS run_end, COUNT(*) AS points, CAST(SUM(load) AS DOUBLE) / COUNT(*) AS avg_load
    FROM g GROUP BY server, island HAVING COUNT(*) >= 3""",
)
def high_usage(spark, sf):
    """Load above a level for at least three hours running."""
    busy = _server_hours(spark, sf).filter("load > 2")
    avg = (F.sum("load").cast("double") / F.count("*")).alias("avg_load")
    runs = R.run_summary(R.step_runs(busy, ["server"], "hour", "1 HOUR", mode="window"), "hour", avg)
    return runs.filter("points >= 3").drop("island")


@query(
    "state_periods",
    f"""WITH {HOURS}, s AS (SELECT *, errors > 0 AS down FROM h),
    f AS (SELECT *, CASE WHEN down IS DISTINCT FROM lag(down) OVER (PARTITION BY server ORDER BY hour) THEN 1 ELSE 0 END AS turn FROM s),
    g AS (SELECT *, SUM(turn) OVER (PARTITION BY server ORDER BY hour) AS island FROM f)
    SELECT server, bool_and(down) AS down, strftime(MIN(hour), '%Y-%m-%d %H:%M:%S') AS run_start,
    strftime(MAX(hour), '%Y-%m-%d %H:%M:%S') AS run_end, COUNT(*) AS points FROM g GROUP BY server, island""",
)
def state_periods(spark, sf):
    """Periods of down and not-down with first and last entry."""
    runs = R.state_runs(_server_hours(spark, sf), ["server"], ["hour"], F.col("errors") > 0, mode="window")
    return R.run_summary(runs, "hour", F.first("_state").alias("down")).drop("island")


@query(
    "collective_unstable",
    f"""WITH {HOURS}, c AS (SELECT hour, COUNT(DISTINCT server) AS n FROM h WHERE load > 1 GROUP BY 1 HAVING COUNT(DISTINCT server) >= 4),
    g AS (SELECT hour, hour - row_number() OVER (ORDER BY hour) * INTERVAL 1 HOUR AS island FROM c)
    SELECT strftime(MIN(hour), '%Y-%m-%d %H:%M:%S') AS run_start, strftime(MAX(hour), '%Y-%m-%d %H:%M:%S') AS run_end, COUNT(*) AS points
    FROM g GROUP BY island HAVING COUNT(*) >= 6""",
)
def collective_unstable(spark, sf):
    """At least four servers loaded at once for at least six hours."""
    loaded = _server_hours(spark, sf).filter("load > 1")
    return R.collective_runs(loaded, "server", "hour", "1 HOUR", 4, 6, mode="window")


@query(
    "last3_increasing",
    """WITH n AS (SELECT o_custkey, o_totalprice AS v, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS k FROM orders)
    SELECT a.o_custkey FROM n a JOIN n b ON a.o_custkey = b.o_custkey AND b.k = 2 JOIN n c ON a.o_custkey = c.o_custkey AND c.k = 3
    WHERE a.k = 1 AND a.v > b.v AND b.v > c.v""",
)
def last3_increasing(spark, sf):
    o = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    return R.last_increasing(o, "o_custkey", ["o_orderdate", "o_orderkey"], "o_totalprice", 3)


@query(
    "bot_streaks",
    f"""WITH {USER_DAYS}, b AS (SELECT * FROM ud WHERE n >= 2),
    g AS (SELECT user_id, day, day - CAST(row_number() OVER (PARTITION BY user_id ORDER BY day) AS INTEGER) AS island FROM b)
    SELECT user_id, strftime(MIN(day), '%Y-%m-%d') AS run_start, COUNT(*) AS points FROM g GROUP BY user_id, island HAVING COUNT(*) >= 3""",
)
def bot_streaks(spark, sf):
    busy = _user_days(spark, sf).filter("n >= 2")
    runs = R.run_summary(R.step_runs(busy, ["user_id"], "day", "1 DAY", mode="window"), "day")
    return runs.filter("points >= 3").select("user_id", "run_start", "points")


@query(
    "qualify_latest",
    """SELECT o_custkey, o_orderkey FROM (SELECT o_custkey, o_orderkey, row_number() OVER
    (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS k FROM orders) WHERE k = 1""",
)
def qualify_latest(spark, sf):
    """A filter on a window result; the limit is applied before the shuffle too."""
    o = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    w = Window.partitionBy("o_custkey").orderBy(F.desc("o_orderdate"), F.desc("o_orderkey"))
    return R.qualify(o, {"k": F.row_number().over(w)}, F.col("k") == 1).select("o_custkey", "o_orderkey")


@query(
    "growth_by_key",
    f"""WITH {COSTS}, m AS (SELECT service, strftime(date, '%Y-%m') AS month, SUM(cost) AS c FROM costs GROUP BY 1, 2),
    g AS (SELECT service, month, c - lag(c) OVER (PARTITION BY service ORDER BY month) AS d FROM m)
    SELECT service, month, CAST(d AS DOUBLE) AS delta FROM g ORDER BY d DESC NULLS LAST, service, month LIMIT 5""",
)
def growth_by_key(spark, sf):
    monthly = costs(spark, sf).groupBy("service", year_month("date").alias("month")).agg(F.sum("cost").alias("c"))
    grown = A.growth(monthly, ["service"], "month", "c").select("service", "month", "delta")
    return grown.orderBy(F.desc_nulls_last("delta"), "service", "month").limit(5)


@query(
    "sessions",
    """WITH f AS (SELECT user_id, ts, event_id, CASE WHEN ts < lag(ts) OVER w + INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS s FROM events
    WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
    g AS (SELECT *, SUM(s) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM f)
    SELECT user_id, strftime(MIN(ts), '%Y-%m-%d %H:%M:%S') AS run_start, strftime(MAX(ts), '%Y-%m-%d %H:%M:%S') AS run_end,
    COUNT(*) AS points FROM g GROUP BY user_id, k""",
)
def sessions(spark, sf):
    """Sessions by a pause of thirty minutes, in one ordered scan."""
    return R.sessions(events(spark, sf), "user_id", "ts", "event_id", "30 MINUTES").drop("island")


@query(
    "sessions_hot",
    """WITH f AS (SELECT event_type, ts, event_id, CASE WHEN ts < lag(ts) OVER w + INTERVAL 10 MINUTE THEN 0 ELSE 1 END AS s FROM events
    WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id)),
    g AS (SELECT *, SUM(s) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS k FROM f)
    SELECT event_type, strftime(MIN(ts), '%Y-%m-%d %H:%M:%S') AS run_start, strftime(MAX(ts), '%Y-%m-%d %H:%M:%S') AS run_end,
    COUNT(*) AS points FROM g GROUP BY event_type, k""",
)
def sessions_hot(spark, sf):
    """The same with five hot keys: the chunked path splits each of them."""
    rows = R.sessions(events(spark, sf), "event_type", "ts", "event_id", "10 MINUTES", mode="chunked")
    return rows.drop("island")
