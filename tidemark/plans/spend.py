"""Cost and operations analytics over the cost mapping and event logs."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from tidemark.functions.columns import between, in_month, last_days, month_index, year_month
from tidemark.operators import costs as K
from tidemark.operators.aggregates import exact_median, trend_slope
from tidemark.plans.frames import AS_OF, COSTS, costs, events
from tidemark.plans.registry import query, table

JULY = "date >= DATE '1998-07-01' AND date < DATE '1998-08-01'"
TEAMS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def _month(day: date, back: int = 0):
    return in_month(F.col("date").cast("timestamp_ntz"), day, back)


@query(
    "spend_last_month",
    f"WITH {COSTS} SELECT team, CAST(SUM(cost) AS DOUBLE) AS total_cost, COUNT(*) AS entries FROM costs WHERE {JULY} GROUP BY 1",
)
def spend_last_month(spark, sf):
    return K.spend_by(costs(spark, sf), ["team"], between("date", date(1998, 7, 1), date(1998, 8, 1)))


@query(
    "cost_drivers",
    f"""WITH {COSTS} SELECT team, service, environment, CAST(SUM(cost) AS DOUBLE) AS total_cost FROM costs WHERE {JULY}
    GROUP BY 1, 2, 3 ORDER BY SUM(cost) DESC, 1, 2, 3 LIMIT 10""",
)
def cost_drivers(spark, sf):
    spend = K.spend_by(costs(spark, sf), ["team", "service", "environment"], between("date", date(1998, 7, 1), date(1998, 8, 1)))
    return spend.orderBy(F.desc("total_cost"), "team", "service", "environment").limit(10).drop("entries")


@query(
    "compare_env",
    f"""WITH {COSTS} SELECT service, CAST(SUM(CASE WHEN environment = 'production' THEN cost ELSE 0 END) AS DOUBLE) AS production,
    CAST(SUM(CASE WHEN environment = 'staging' THEN cost ELSE 0 END) AS DOUBLE) AS staging FROM costs GROUP BY 1""",
)
def compare_env(spark, sf):
    return K.spend_matrix(costs(spark, sf), "service", "environment", ["production", "staging"])


@query(
    "trend6",
    f"""WITH {COSTS}, m AS (SELECT service, (year(date) * 12 + month(date))::BIGINT AS i, SUM(cost) AS c FROM costs
    WHERE date >= DATE '1998-02-01' AND date < DATE '1998-08-01' GROUP BY 1, 2)
    SELECT service, COUNT(*) AS periods, ROUND(CAST(COUNT(*) * SUM(i * c) - SUM(i) * SUM(c) AS DOUBLE) / CAST(COUNT(*) * SUM(i * i) - SUM(i) * SUM(i) AS DOUBLE), 2) AS slope FROM m GROUP BY 1""",
)
def trend6(spark, sf):
    """Change per month over six monthly sums of each service, to the cent."""
    rows = costs(spark, sf).filter(between("date", date(1998, 2, 1), date(1998, 8, 1)))
    monthly = rows.groupBy("service", month_index("date").cast("long").alias("i")).agg(F.sum("cost").alias("c"))
    return trend_slope(monthly, ["service"], "i", "c").select("service", "periods", F.round("slope", 2).alias("slope"))


@query(
    "over_budget",
    f"""WITH {COSTS}, b AS (SELECT team, SUM(cost) / 12 AS budget FROM costs WHERE date >= DATE '1997-07-01' AND date < DATE '1998-07-01' GROUP BY 1),
    s AS (SELECT team, SUM(cost) AS spent FROM costs WHERE date >= DATE '1998-07-01' AND date < DATE '1998-07-20' GROUP BY 1)
    SELECT team, CAST(spent AS DOUBLE) AS spent, CAST(spent AS DOUBLE) * 31 / 19 > CAST(budget AS DOUBLE) AS over_budget FROM b JOIN s USING (team)""",
)
def over_budget(spark, sf):
    """Pace on July 20 against a budget of last year's monthly mean."""
    c = costs(spark, sf)
    budgets = (
        c.filter(between("date", date(1997, 7, 1), date(1998, 7, 1))).groupBy("team").agg((F.sum("cost") / 12).alias("budget"))
    )
    out = K.budget_outlook(c, budgets, date(1998, 7, 20), date(1998, 7, 1), date(1998, 8, 1))
    return out.select("team", "spent", "over_budget")


@query(
    "idle_spend",
    f"""WITH {COSTS} SELECT team, CAST(SUM(CASE WHEN environment = 'development' THEN cost ELSE 0 END) AS DOUBLE) / CAST(SUM(cost) AS DOUBLE) AS idle_share,
    COUNT(*) FILTER (WHERE environment = 'development' AND cost > 400000) AS large_idle FROM costs GROUP BY 1""",
)
def idle_spend(spark, sf):
    """Share of spend on resources that count as idle, and large ones among them."""
    idle = F.col("environment") == "development"
    return costs(spark, sf).groupBy("team").agg(
        F.try_divide(F.sum(F.when(idle, F.col("cost")).otherwise(0)).cast("double"), F.sum("cost").cast("double")).alias("idle_share"),
        F.count_if(idle & (F.col("cost") > 400000)).alias("large_idle"),
    )


@query(
    "yoy",
    f"""WITH {COSTS}, m AS (SELECT (year(date) * 12 + month(date))::BIGINT AS i, SUM(cost) AS c FROM costs GROUP BY 1)
    SELECT a.i, CAST(a.c AS DOUBLE) AS cost, CAST(b.c AS DOUBLE) AS last_year, CAST((a.c - b.c) * 100 AS DOUBLE) / CAST(b.c AS DOUBLE) AS yoy_pct
    FROM m a JOIN m b ON a.i = b.i + 12""",
)
def yoy(spark, sf):
    monthly = costs(spark, sf).groupBy(month_index("date").cast("long").alias("i")).agg(F.sum("cost").alias("cost"))
    return K.same_month_last_year(monthly, "i", "cost").select("i", "cost", "last_year", "yoy_pct")


@query(
    "top_growth",
    f"""WITH {COSTS}, m AS (SELECT environment, strftime(date, '%Y-%m') AS month, SUM(cost) AS c FROM costs WHERE date < DATE '2001-08-01' GROUP BY 1, 2),
    g AS (SELECT environment, month, CAST(c - lag(c) OVER w AS DOUBLE) * 100 / CAST(lag(c) OVER w AS DOUBLE) AS growth_pct FROM m
    WINDOW w AS (PARTITION BY environment ORDER BY month)) SELECT * FROM g WHERE growth_pct IS NOT NULL ORDER BY growth_pct DESC, 1, 2 LIMIT 1""",
)
def top_growth(spark, sf):
    rows = costs(spark, sf).filter(F.col("date") < F.lit(date(2001, 8, 1)))
    monthly = rows.groupBy("environment", year_month("date").alias("month")).agg(F.sum("cost").alias("c"))
    return K.fastest_growth(monthly, "environment", "month", "c").select("environment", "month", "growth_pct")


DAILY = f"{COSTS}, d AS (SELECT team, date, SUM(cost) AS cost FROM costs GROUP BY 1, 2)"


def _daily(spark, sf):
    return costs(spark, sf).groupBy("team", "date").agg(F.sum("cost").alias("cost"))


@query(
    "cost_anomalies",
    f"""WITH {DAILY}, t AS (SELECT *, CAST(SUM(cost) OVER w AS DOUBLE) / COUNT(cost) OVER w AS m FROM d
    WINDOW w AS (PARTITION BY team ORDER BY date RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING))
    SELECT team, strftime(date, '%Y-%m-%d') AS date, (CAST(cost AS DOUBLE) - m) / m AS deviation FROM t WHERE abs((CAST(cost AS DOUBLE) - m) / m) > 0.2""",
)
def cost_anomalies(spark, sf):
    """More than 20 percent off the mean of the previous seven days."""
    return K.anomalies(_daily(spark, sf), ["team"]).select("team", "date", "deviation")


@query(
    "daily_spikes",
    f"""WITH {DAILY} SELECT a.team, strftime(a.date, '%Y-%m-%d') AS date, CAST(a.cost - b.cost AS DOUBLE) / CAST(b.cost AS DOUBLE) AS rise
    FROM d a JOIN d b ON a.team = b.team AND a.date = b.date + 1 WHERE CAST(a.cost - b.cost AS DOUBLE) / CAST(b.cost AS DOUBLE) > 0.3""",
)
def daily_spikes(spark, sf):
    return K.daily_spikes(_daily(spark, sf), ["team"]).select("team", "date", "rise")


WOW = """w AS (SELECT {k}, SUM(CASE WHEN date < DATE '1998-07-25' THEN cost ELSE 0 END) AS a, SUM(CASE WHEN date >= DATE '1998-07-25' THEN cost ELSE 0 END) AS b
    FROM costs WHERE date >= DATE '1998-07-18' AND date < DATE '1998-08-01' GROUP BY 1)"""


def _weeks(spark, sf, key):
    before = between("date", date(1998, 7, 18), date(1998, 7, 25))
    after = between("date", date(1998, 7, 25), date(1998, 8, 1))
    return K.two_periods(costs(spark, sf), [key], before, after)


@query(
    "wow_drivers",
    f"""WITH {COSTS}, {WOW.format(k='service')} SELECT service, CAST(a AS DOUBLE) AS cost_before, CAST(b AS DOUBLE) AS cost_after, CAST(b - a AS DOUBLE) AS delta,
    CAST(b - a AS DOUBLE) / CAST(SUM(b - a) OVER () AS DOUBLE) AS share_of_change FROM w""",
)
def wow_drivers(spark, sf):
    return _weeks(spark, sf, "service").drop("change_pct")


@query(
    "bill_jump",
    f"""WITH {COSTS}, {WOW.format(k='team')} SELECT team, CAST(b - a AS DOUBLE) * 100 / CAST(a AS DOUBLE) AS change_pct FROM w ORDER BY b - a DESC, team LIMIT 3""",
)
def bill_jump(spark, sf):
    """The consumers behind a jump of the bill."""
    out = _weeks(spark, sf, "team").orderBy(F.desc("delta"), "team").limit(3)
    return out.select("team", F.try_divide(F.col("delta").cast("double") * 100, F.col("cost_before").cast("double")).alias("change_pct"))


@query(
    "idle_consumers",
    """SELECT o_custkey AS customer_id, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS cost, COUNT(*) AS entries FROM orders
    WHERE o_orderdate >= TIMESTAMP '1998-07-01' AND o_orderdate < TIMESTAMP '1998-08-01'
    AND o_custkey NOT IN (SELECT user_id FROM events WHERE user_id IS NOT NULL) GROUP BY 1""",
)
def idle_consumers(spark, sf):
    """Customers billed in July who used nothing."""
    july = table(spark, sf, "orders").filter(between("o_orderdate", datetime(1998, 7, 1), datetime(1998, 8, 1)))
    bill = july.select(F.col("o_custkey").alias("customer_id"), F.col("o_totalprice").cast("decimal(18,2)").alias("cost"))
    return K.idle_consumers(bill, events(spark, sf).select(F.col("user_id").alias("customer_id")), "customer_id")


@query(
    "time_per_user",
    """SELECT user_id, COUNT(*) AS requests, CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS time_spent,
    strftime(MAX(ts), '%Y-%m-%d %H:%M:%S') AS last_seen, MAX(ts) < TIMESTAMP '2024-01-29' AS idle FROM events GROUP BY 1""",
)
def time_per_user(spark, sf):
    """Events as a query log with value as the elapsed time; idle since January 29."""
    elapsed = F.col("value").cast("decimal(18,2)")
    return K.time_per_user(events(spark, sf), "user_id", elapsed, "ts", F.lit(datetime(2024, 1, 29)))


@query(
    "answer_times",
    """WITH n AS (SELECT ts, event_type, LEAD(ts) OVER w AS next_ts, LEAD(event_type) OVER w AS next_type FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
    q AS (SELECT CAST(ts AS DATE) AS day, CASE WHEN next_type IN ('click', 'purchase') THEN epoch_us(next_ts) - epoch_us(ts) END AS took FROM n WHERE event_type = 'view')
    SELECT strftime(day, '%Y-%m-%d') AS day, COUNT(*) AS questions, COUNT(took) AS answered,
    CAST(SUM(took) AS DOUBLE) / CAST(COUNT(took) AS DOUBLE) / 1e6 AS mean_seconds, CAST(MAX(took) AS DOUBLE) / 1e6 AS longest_seconds FROM q GROUP BY 1""",
)
def answer_times(spark, sf):
    """Views as questions; the user's next event answers if it is a click or a purchase."""
    kind = F.col("event_type")
    return K.answer_times(events(spark, sf), "user_id", "ts", "event_id", kind == "view", kind.isin("click", "purchase"))


@query(
    "allocated",
    f"""WITH {COSTS}, s AS (SELECT * FROM (VALUES ('development', 'Engineering', 0.5), ('development', 'Data', 0.5)) AS t(environment, to_team, share))
    SELECT COALESCE(to_team, team) AS team, CAST(SUM(cost * CAST(COALESCE(share, 1) AS DECIMAL(6,4))) AS DOUBLE) AS cost
    FROM costs LEFT JOIN s USING (environment) GROUP BY 1""",
)
def allocated(spark, sf):
    """Development cost split evenly between two teams; totals are kept."""
    shares = spark.createDataFrame(
        [("development", "Engineering", 0.5), ("development", "Data", 0.5)], "environment string, team string, share double"
    )
    per = costs(spark, sf).groupBy("environment", "team").agg(F.sum("cost").cast("decimal(28,2)").alias("cost"))
    return K.allocate(per, shares, "environment").groupBy("team").agg(F.sum("cost").alias("cost"))


@query(
    "env_ratio",
    f"""WITH {COSTS} SELECT strftime(date, '%Y') AS year, CAST(SUM(CASE WHEN environment = 'production' THEN cost ELSE 0 END) AS DOUBLE)
    / NULLIF(CAST(SUM(CASE WHEN environment = 'development' THEN cost ELSE 0 END) AS DOUBLE), 0) AS ratio FROM costs GROUP BY 1""",
)
def env_ratio(spark, sf):
    c = costs(spark, sf).withColumn("year", F.date_format("date", "yyyy"))
    both = K.spend_matrix(c, "year", "environment", ["production", "development"])
    return both.select("year", F.try_divide(F.col("production").cast("double"), F.col("development").cast("double")).alias("ratio"))


@query(
    "slow_queries",
    """SELECT event_id, value FROM events WHERE ts >= TIMESTAMP '2024-01-22' AND ts < TIMESTAMP '2024-01-29' ORDER BY value DESC, event_id LIMIT 10""",
)
def slow_queries(spark, sf):
    """Events as a query log with value as the elapsed time."""
    recent = last_days("ts", date(2024, 1, 29), 7)
    return K.slowest(events(spark, sf), "value", recent, 10, "event_id").select("event_id", "value")


@query(
    "heavy_scans",
    """SELECT event_id AS query_id, CAST(value * 1000000000 AS BIGINT) AS total_bytes_read FROM events
    WHERE event_type <> 'error' AND CAST(value * 1000000000 AS BIGINT) > 100000000000 ORDER BY 2 DESC, 1 LIMIT 20""",
)
def heavy_scans(spark, sf):
    """Events as a query log with value as gigabytes read; errors did not finish."""
    log = events(spark, sf).select(
        F.col("event_id").alias("query_id"),
        F.round(F.col("value") * 1_000_000_000).cast("long").alias("total_bytes_read"),
        F.when(F.col("event_type") == "error", "FAILED").otherwise("FINISHED").alias("state"),
    )
    return K.heavy_scans(log).drop("state")


@query(
    "quota_crossings",
    f"""WITH {COSTS}, m AS (SELECT team, strftime(date, '%Y-%m') AS month, SUM(cost) AS c FROM costs WHERE date >= DATE '1998-01-01' AND date < DATE '1999-01-01' GROUP BY 1, 2),
    q AS (SELECT (SELECT SUM(c) FROM m) / 5 AS quota),
    u AS (SELECT team, month, SUM(c) OVER (PARTITION BY team ORDER BY month) AS used FROM m)
    SELECT team, CAST(level AS BIGINT) AS level, action, MIN(month) AS first_period FROM u, (VALUES (75, 'notify'), (90, 'suspend'), (100, 'suspend immediately')) AS l(level, action)
    WHERE CAST(used AS DOUBLE) * 100 >= level * CAST((SELECT quota FROM q) AS DOUBLE) GROUP BY 1, 2, 3""",
)
def quota_crossings(spark, sf):
    """First month in which a team reaches 75, 90 and 100 percent of its year's quota."""
    year = costs(spark, sf).filter(between("date", date(1998, 1, 1), date(1999, 1, 1)))
    monthly = year.groupBy("team", year_month("date").alias("month")).agg(F.sum("cost").alias("c"))
    quota = float(monthly.agg(F.sum("c")).first()[0]) / 5
    return K.quota_crossings(monthly, ["team"], "month", "c", quota)


@query(
    "chargeback",
    """WITH u AS (SELECT c_mktsegment AS tenant, COUNT(*) AS units FROM events JOIN customer ON user_id = c_custkey GROUP BY 1)
    SELECT tenant, units, CAST(units AS DOUBLE) / CAST(SUM(units) OVER () AS DOUBLE) AS share,
    CAST(units AS DOUBLE) / CAST(SUM(units) OVER () AS DOUBLE) * 10000 AS charge FROM u""",
)
def chargeback(spark, sf):
    """A bill of 10,000 split by each tenant's share of events."""
    per = events(spark, sf).groupBy("user_id").agg(F.count("*").alias("n"))
    home = table(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("tenant"))
    return K.chargeback(per.join(home, "user_id"), "tenant", "n", 10000.0)


@query(
    "storage_tiers",
    """WITH f AS (SELECT date_diff('day', CAST(o_orderdate AS DATE), DATE '1998-08-01') AS age, CAST(o_totalprice AS DECIMAL(18,2)) AS bytes FROM orders
    WHERE o_orderdate < TIMESTAMP '1998-08-01')
    SELECT CASE WHEN age > 365 THEN 'deep archive' WHEN age > 90 THEN 'archive' WHEN age > 30 THEN 'infrequent' ELSE 'standard' END AS tier,
    CAST(SUM(bytes) AS DOUBLE) AS bytes, COUNT(*) AS files FROM f GROUP BY 1""",
)
def storage_tiers(spark, sf):
    """Orders as files: age decides the storage class."""
    files = table(spark, sf, "orders").filter(F.col("o_orderdate") < F.lit(datetime(1998, 8, 1))).select(
        F.datediff(F.lit(AS_OF), "o_orderdate").alias("age"), F.col("o_totalprice").cast("decimal(18,2)").alias("bytes")
    )
    return files.groupBy(K.storage_tier(F.col("age")).alias("tier")).agg(F.sum("bytes").alias("bytes"), F.count("*").alias("files"))


@query(
    "tier_savings",
    """WITH f AS (SELECT date_diff('day', CAST(o_orderdate AS DATE), DATE '1998-08-01') AS age, o_totalprice AS bytes FROM orders WHERE o_orderdate < TIMESTAMP '1998-08-01')
    SELECT CASE WHEN age > 365 THEN 'deep archive' WHEN age > 90 THEN 'archive' WHEN age > 30 THEN 'infrequent' ELSE 'standard' END AS tier,
    ROUND(SUM(bytes / 1e9 * CASE WHEN age > 365 THEN 0.00099 WHEN age > 90 THEN 0.004 WHEN age > 30 THEN 0.0125 ELSE 0.023 END) * 1e6, 3) AS monthly_microdollars
    FROM f GROUP BY 1""",
)
def tier_savings(spark, sf):
    files = table(spark, sf, "orders").filter(F.col("o_orderdate") < F.lit(datetime(1998, 8, 1))).select(
        F.datediff(F.lit(AS_OF), "o_orderdate").alias("age"), F.col("o_totalprice").alias("bytes")
    )
    out = K.tier_costs(files, "age", "bytes")
    return out.select("tier", F.round(F.col("monthly_cost") * 1e6, 3).alias("monthly_microdollars"))


@query(
    "request_costs",
    """SELECT o_orderpriority AS table_name, COUNT(*) AS files, ROUND(COUNT(*) * 1000.0::DOUBLE * 30 * (0.0004::DOUBLE / 1000), 6) AS monthly_cost FROM orders GROUP BY 1""",
)
def request_costs(spark, sf):
    """Orders as data files of five tables, a thousand queries a day."""
    files = table(spark, sf, "orders").groupBy(F.col("o_orderpriority").alias("table_name")).agg(F.count("*").alias("files"))
    return files.withColumn("monthly_cost", F.round(K.request_cost(F.col("files"), F.lit(1000)), 6))


@query(
    "storage_footprint",
    """SELECT p_type AS table_name, SUM(p_retailprice)::DECIMAL(18,1)::DOUBLE AS size_gb,
    CASE WHEN p_type IN ('ECONOMY', 'SMALL') THEN (SUM(p_retailprice)::DECIMAL(18,1) * 8)::DOUBLE ELSE SUM(p_retailprice)::DECIMAL(18,1)::DOUBLE END AS total_gb
    FROM part GROUP BY 1""",
)
def storage_footprint(spark, sf):
    """Part types as tables: two kept for seven days with fail-safe, the rest transient."""
    sizes = table(spark, sf, "part").groupBy(F.col("p_type").alias("table_name")).agg(
        F.sum(F.col("p_retailprice").cast("decimal(18,1)")).cast("double").alias("size_gb")
    )
    permanent = F.col("table_name").isin("ECONOMY", "SMALL")
    typed = sizes.withColumn("table_type", F.when(permanent, "permanent").otherwise("transient")).withColumn(
        "retention_days", F.when(permanent, 7.0).otherwise(1.0)
    )
    return K.storage_footprint(typed).select("table_name", "size_gb", "total_gb")


@query(
    "slower_queries",
    """WITH a AS (SELECT user_id, median(value) AS m FROM events WHERE ts < TIMESTAMP '2024-01-16' GROUP BY 1),
    b AS (SELECT user_id, median(value) AS m FROM events WHERE ts >= TIMESTAMP '2024-01-16' GROUP BY 1)
    SELECT user_id, ROUND(b.m / a.m, 6) AS factor FROM a JOIN b USING (user_id) WHERE b.m / a.m >= 1.5""",
)
def slower_queries(spark, sf):
    """Per-user medians of two halves of the log."""
    e = events(spark, sf).select("user_id", "ts", "value")
    split = F.lit(datetime(2024, 1, 16))
    a = exact_median(e.filter(F.col("ts") < split), ["user_id"], "value")
    b = exact_median(e.filter(F.col("ts") >= split), ["user_id"], "value")
    return K.regressions(a, b, "user_id", 1.5).select("user_id", F.round("factor", 6).alias("factor"))


@query(
    "latency_hist",
    "SELECT CAST(floor(value / 10) * 10 AS BIGINT) AS bucket_start, COUNT(*) AS n FROM events GROUP BY 1",
)
def latency_hist(spark, sf):
    return K.latency_histogram(events(spark, sf), "value", 10)


@query(
    "request_counters",
    """SELECT event_type, COUNT(*) AS requests, COUNT(*) FILTER (WHERE value > 100) AS slow FROM events GROUP BY 1""",
)
def request_counters(spark, sf):
    return events(spark, sf).groupBy("event_type").agg(
        F.count("*").alias("requests"), F.count_if(F.col("value") > 100).alias("slow")
    )


@query(
    "assistant_usage",
    """SELECT COUNT(DISTINCT conv_id) AS conversations, COUNT(*) FILTER (WHERE role = 'user') AS questions,
    COUNT(*) FILTER (WHERE role = 'assistant') AS answers,
    CAST(COUNT(*) FILTER (WHERE role = 'assistant') AS DOUBLE) / COUNT(*) FILTER (WHERE role = 'user') AS answered FROM conversations""",
)
def assistant_usage(spark, sf):
    per = table(spark, sf, "conversations").groupBy("conv_id").agg(
        F.count_if(F.col("role") == "user").alias("q"), F.count_if(F.col("role") == "assistant").alias("a")
    )
    return per.agg(
        F.count("*").alias("conversations"),
        F.sum("q").alias("questions"),
        F.sum("a").alias("answers"),
        F.try_divide(F.sum("a").cast("double"), F.sum("q").cast("double")).alias("answered"),
    )


@query(
    "usage_daily",
    """SELECT strftime(ts, '%Y-%m-%d') AS day, COUNT(DISTINCT user_id) AS users, COUNT(*) FILTER (WHERE event_type = 'view') AS questions,
    CAST(COUNT(*) FILTER (WHERE event_type <> 'error') AS DOUBLE) / COUNT(*) AS success_rate FROM events GROUP BY 1""",
)
def usage_daily(spark, sf):
    per = events(spark, sf).groupBy(F.col("ts").cast("date").alias("day"), "user_id").agg(
        F.count("*").alias("n"),
        F.count_if(F.col("event_type") == "view").alias("q"),
        F.count_if(F.col("event_type") != "error").alias("ok"),
    )
    return per.groupBy("day").agg(
        F.count("*").alias("users"),
        F.sum("q").alias("questions"),
        F.try_divide(F.sum("ok").cast("double"), F.sum("n").cast("double")).alias("success_rate"),
    )
