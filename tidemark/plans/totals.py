"""Aggregations over the mapped tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from tidemark.functions.columns import month_index, ratio, year_month
from tidemark.operators import aggregates as A
from tidemark.plans.frames import (
    COSTS,
    CUSTOMERS,
    ORDERS,
    SALES,
    costs,
    customers,
    events,
    orders,
    sales,
)
from tidemark.plans.joins import MONTHLY_PRIORITY, priority_dim
from tidemark.plans.registry import query, table


@query(
    "sum_by_group",
    f"""WITH {ORDERS} SELECT priority, customer_id, CAST(SUM(amount) AS DOUBLE) AS total FROM ord GROUP BY 1, 2""",
)
def sum_by_group(spark, sf):
    return orders(spark, sf).groupBy("priority", "customer_id").agg(F.sum("amount").alias("total"))


@query(
    "category_summary",
    f"""WITH {SALES} SELECT p_brand AS category, CAST(SUM(revenue) AS DOUBLE) AS total FROM sales JOIN part ON product = p_partkey GROUP BY 1""",
)
def category_summary(spark, sf):
    """Summed by product before the join, so the join sees one row per product."""
    per = sales(spark, sf).groupBy("product").agg(F.sum("revenue").alias("revenue"))
    brands = table(spark, sf, "part").select(F.col("p_partkey").alias("product"), F.col("p_brand").alias("category"))
    return per.join(brands, "product").groupBy("category").agg(F.sum("revenue").alias("total"))


@query(
    "status_summary",
    f"""WITH {ORDERS} SELECT status, CAST(SUM(amount) AS DOUBLE) AS total, COUNT(*) AS n,
    CAST(SUM(amount) AS DOUBLE) / COUNT(*) AS average FROM ord GROUP BY 1 ORDER BY total DESC""",
)
def status_summary(spark, sf):
    return (
        orders(spark, sf).groupBy("status")
        .agg(F.sum("amount").alias("total"), F.count("*").alias("n"))
        .withColumn("average", F.col("total").cast("double") / F.col("n"))
        .orderBy(F.desc("total"))
    )


@query(
    "customer_summary",
    f"""WITH {CUSTOMERS}, {ORDERS} SELECT customer_id, name, country, COUNT(*) AS total_orders,
    CAST(SUM(amount) AS DOUBLE) AS total_spent, CAST(SUM(amount) AS DOUBLE) / COUNT(*) AS avg_order_value,
    COUNT(*) FILTER (WHERE status = 'completed') AS completed_orders FROM ord JOIN cust USING (customer_id) GROUP BY 1, 2, 3""",
)
def customer_summary(spark, sf):
    per = orders(spark, sf).groupBy("customer_id").agg(
        F.count("*").alias("total_orders"),
        F.sum("amount").alias("total_spent"),
        F.count_if(F.col("status") == "completed").alias("completed_orders"),
    )
    return per.join(customers(spark, sf).select("customer_id", "name", "country"), "customer_id").withColumn(
        "avg_order_value", F.col("total_spent").cast("double") / F.col("total_orders")
    )


@query(
    "product_summary",
    f"""WITH {SALES} SELECT product, COUNT(*) AS times_ordered, CAST(SUM(quantity) AS DOUBLE) AS total_quantity,
    CAST(SUM(revenue) AS DOUBLE) AS total_revenue, CAST(SUM(revenue) AS DOUBLE) / COUNT(*) AS avg_order_value
    FROM sales JOIN orders ON order_id = o_orderkey WHERE o_orderstatus = 'F' GROUP BY 1""",
)
def product_summary(spark, sf):
    done = table(spark, sf, "orders").filter("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("order_id"))
    return (
        sales(spark, sf).join(done, "order_id", "left_semi").groupBy("product")
        .agg(
            F.count("*").alias("times_ordered"),
            F.sum("quantity").alias("total_quantity"),
            F.sum("revenue").alias("total_revenue"),
        )
        .withColumn("avg_order_value", F.col("total_revenue").cast("double") / F.col("times_ordered"))
    )


@query(
    "nation_summary",
    f"""WITH {CUSTOMERS}, {ORDERS} SELECT country, COUNT(DISTINCT customer_id) AS unique_customers, COUNT(*) AS total_orders,
    CAST(SUM(amount) AS DOUBLE) AS total_revenue, CAST(SUM(amount) AS DOUBLE) / COUNT(DISTINCT customer_id) AS avg_revenue_per_customer
    FROM ord JOIN cust USING (customer_id) GROUP BY 1 ORDER BY total_revenue DESC""",
)
def nation_summary(spark, sf):
    """Orders are reduced to one row per customer first: distinct becomes a count."""
    per = orders(spark, sf).groupBy("customer_id").agg(F.count("*").alias("n"), F.sum("amount").alias("amount"))
    return (
        per.join(customers(spark, sf).select("customer_id", "country"), "customer_id")
        .groupBy("country")
        .agg(
            F.count("*").alias("unique_customers"),
            F.sum("n").alias("total_orders"),
            F.sum("amount").alias("total_revenue"),
        )
        .withColumn("avg_revenue_per_customer", F.col("total_revenue").cast("double") / F.col("unique_customers"))
        .orderBy(F.desc("total_revenue"))
    )


@query(
    "null_counts",
    """SELECT COUNT(*) - COUNT(doc_id) AS doc_id, COUNT(*) - COUNT(lang) AS lang, COUNT(*) - COUNT(quality) AS quality,
    COUNT(*) - COUNT(toxic) AS toxic FROM documents LEFT JOIN labels USING (doc_id)""",
)
def null_counts(spark, sf):
    from tidemark.sources.files import null_counts as count_nulls

    docs = table(spark, sf, "documents").select("doc_id", "lang")
    return count_nulls(docs.join(table(spark, sf, "labels"), "doc_id", "left"))


@query("distinct_senders", "SELECT COUNT(DISTINCT o_custkey) AS senders FROM orders")
def distinct_senders(spark, sf):
    return table(spark, sf, "orders").agg(F.countDistinct("o_custkey").alias("senders"))


@query(
    "top10_accounts",
    "SELECT o_custkey, COUNT(*) AS n FROM orders GROUP BY 1 ORDER BY n DESC, o_custkey LIMIT 10",
)
def top10_accounts(spark, sf):
    return (
        table(spark, sf, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), "o_custkey").limit(10)
    )


@query(
    "having_orders",
    "SELECT o_custkey, COUNT(*) AS n FROM orders GROUP BY 1 HAVING COUNT(*) > 10",
)
def having_orders(spark, sf):
    return table(spark, sf, "orders").groupBy("o_custkey").agg(F.count("*").alias("n")).filter("n > 10")


@query(
    "ltv",
    f"""WITH {ORDERS} SELECT customer_id, COUNT(*) AS orders, CAST(SUM(amount) AS DOUBLE) AS lifetime_value FROM ord GROUP BY 1""",
)
def ltv(spark, sf):
    return orders(spark, sf).groupBy("customer_id").agg(
        F.count("*").alias("orders"), F.sum("amount").alias("lifetime_value")
    )


@query(
    "current_revenue",
    f"""WITH {ORDERS}, {MONTHLY_PRIORITY} SELECT dim.priority, CAST(SUM(amount) AS DOUBLE) AS revenue
    FROM ord JOIN dim ON ord.customer_id = dim.customer_id AND effective_date <= order_date
    WHERE expiration_date IS NULL GROUP BY 1""",
)
def current_revenue(spark, sf):
    """Revenue that falls into the current version of each customer."""
    now = priority_dim(spark, sf).filter("is_current").select("customer_id", F.col("priority").alias("now"), "effective_date")
    return (
        orders(spark, sf).join(now, "customer_id").filter("effective_date <= order_date")
        .groupBy(F.col("now").alias("priority")).agg(F.sum("amount").alias("revenue"))
    )


@query(
    "segment_ltv",
    f"""WITH {ORDERS}, s AS (SELECT customer_id, SUM(amount) AS v FROM ord GROUP BY 1)
    SELECT c_mktsegment AS segment, COUNT(*) AS customers, CAST(SUM(v) AS DOUBLE) AS total, CAST(SUM(v) AS DOUBLE) / COUNT(*) AS average
    FROM s JOIN customer ON customer_id = c_custkey GROUP BY 1""",
)
def segment_ltv(spark, sf):
    per = orders(spark, sf).groupBy("customer_id").agg(F.sum("amount").alias("v"))
    people = table(spark, sf, "customer").select(F.col("c_custkey").alias("customer_id"), F.col("c_mktsegment").alias("segment"))
    return (
        per.join(people, "customer_id").groupBy("segment")
        .agg(F.count("*").alias("customers"), F.sum("v").alias("total"))
        .withColumn("average", F.col("total").cast("double") / F.col("customers"))
    )


@query(
    "best_month",
    f"""WITH {ORDERS}, m AS (SELECT strftime(order_date, '%Y-%m') AS month, SUM(amount) AS revenue FROM ord GROUP BY 1)
    SELECT month, CAST(revenue AS DOUBLE) AS revenue FROM m ORDER BY revenue DESC, month LIMIT 1""",
)
def best_month(spark, sf):
    months = orders(spark, sf).groupBy(year_month("order_date").alias("month")).agg(F.sum("amount").alias("revenue"))
    return months.orderBy(F.desc("revenue"), "month").limit(1)


@query(
    "band_counts",
    f"""WITH {ORDERS}, s AS (SELECT customer_id, SUM(amount) AS v FROM ord GROUP BY 1)
    SELECT CASE WHEN v > 3000000 THEN 'VIP' WHEN v >= 2000000 THEN 'Regular' ELSE 'New' END AS band, COUNT(*) AS customers
    FROM s GROUP BY 1""",
)
def band_counts(spark, sf):
    from tidemark.functions.columns import value_band

    per = orders(spark, sf).groupBy("customer_id").agg(F.sum("amount").alias("v"))
    band = value_band(F.col("v"), vip=3_000_000, regular=2_000_000)
    return per.groupBy(band.alias("band")).agg(F.count("*").alias("customers"))


@query(
    "quality_pct",
    f"""WITH {ORDERS}, c AS (SELECT customer_id, COUNT(*) AS n FROM ord GROUP BY 1)
    SELECT (SELECT COUNT(*) FILTER (WHERE status = 'completed') * 100.0::DOUBLE / COUNT(*) FROM ord) AS completed_pct,
    (SELECT COUNT(*) FILTER (WHERE status = 'cancelled') * 100.0::DOUBLE / COUNT(*) FROM ord) AS cancelled_pct,
    (SELECT COUNT(*) FILTER (WHERE amount >= 400000) * 100.0::DOUBLE / COUNT(*) FROM ord) AS high_value_pct,
    (SELECT COUNT(*) FILTER (WHERE n > 10) * 100.0::DOUBLE / COUNT(*) FROM c) AS repeat_pct""",
)
def quality_pct(spark, sf):
    """One pass by customer; the order counts are summed from it."""
    per = orders(spark, sf).groupBy("customer_id").agg(
        F.count("*").alias("n"),
        F.count_if(F.col("status") == "completed").alias("done"),
        F.count_if(F.col("status") == "cancelled").alias("off"),
        F.count_if(F.col("amount") >= 400000).alias("high"),
    )

    def pct(a, b):
        return a * F.lit(100.0) / b

    return per.agg(
        pct(F.sum("done"), F.sum("n")).alias("completed_pct"),
        pct(F.sum("off"), F.sum("n")).alias("cancelled_pct"),
        pct(F.sum("high"), F.sum("n")).alias("high_value_pct"),
        pct(F.count_if(F.col("n") > 10), F.count("*")).alias("repeat_pct"),
    )


@query(
    "median_diff",
    """WITH o AS (SELECT o_orderkey, o_orderpriority AS p, strftime(o_orderdate, '%Y-%m') AS m, o_totalprice AS v FROM orders)
    SELECT o_orderkey, ROUND(v - median(v) OVER (PARTITION BY p, m), 4) AS diff FROM o""",
)
def median_diff(spark, sf):
    o = table(spark, sf, "orders").select(
        "o_orderkey", F.col("o_orderpriority").alias("p"), year_month("o_orderdate").alias("m"), F.col("o_totalprice").alias("v")
    )
    mid = A.exact_median(o, ["p", "m"], "v")
    return o.join(mid, ["p", "m"]).select("o_orderkey", F.round(F.col("v") - F.col("median"), 4).alias("diff"))


MONTHS6 = f"""{SALES}, m AS (SELECT product, (year(sale_date) * 12 + month(sale_date))::BIGINT AS i, SUM(revenue) AS v
    FROM sales WHERE sale_date >= TIMESTAMP '2001-02-01' AND sale_date < TIMESTAMP '2001-08-01' GROUP BY 1, 2)"""


@query(
    "declining_parts",
    f"""WITH {MONTHS6} SELECT product, COUNT(*) AS periods FROM m GROUP BY 1 HAVING COUNT(*) >= 3 AND
    COUNT(*) * SUM(CAST(i AS DECIMAL(18,0)) * v) - SUM(i) * SUM(v) < 0""",
)
def declining_parts(spark, sf):
    """Parts with a negative least-squares trend over six months."""
    start, end = date(2001, 2, 1), date(2001, 8, 1)
    s = sales(spark, sf).filter(
        (F.col("sale_date") >= F.lit(start).cast("timestamp_ntz")) & (F.col("sale_date") < F.lit(end).cast("timestamp_ntz"))
    )
    monthly = s.groupBy("product", month_index("sale_date").cast("long").alias("i")).agg(F.sum("revenue").alias("v"))
    slopes = A.trend_slope(monthly, ["product"], "i", "v")
    return slopes.filter("periods >= 3 AND slope < 0").select("product", "periods")


@query(
    "seasonal_parts",
    f"""WITH {SALES}, m AS (SELECT product, strftime(sale_date, '%Y-%m') AS mo, CAST(SUM(revenue) AS DOUBLE) AS v FROM sales
    WHERE sale_date >= TIMESTAMP '2000-01-01' AND sale_date < TIMESTAMP '2001-01-01' GROUP BY 1, 2)
    SELECT product, COUNT(*) AS months FROM m GROUP BY 1 HAVING COUNT(*) > 1 AND var_pop(v) > 0.5 * AVG(v)""",
)
def seasonal_parts(spark, sf):
    """Variance of the monthly sums above half their mean, in one year."""
    year = sales(spark, sf).filter(
        (F.col("sale_date") >= F.lit("2000-01-01").cast("timestamp_ntz"))
        & (F.col("sale_date") < F.lit("2001-01-01").cast("timestamp_ntz"))
    )
    monthly = year.groupBy("product", year_month("sale_date").alias("mo")).agg(F.sum("revenue").cast("double").alias("v"))
    return (
        monthly.groupBy("product")
        .agg(F.count("*").alias("months"), F.var_pop("v").alias("spread"), F.avg("v").alias("mean"))
        .filter("months > 1 AND spread > 0.5 * mean")
        .select("product", "months")
    )


@query(
    "whales",
    f"""WITH {SALES}, s AS (SELECT p_brand AS brand, o_custkey AS customer_id, SUM(revenue) AS spent FROM sales
    JOIN orders ON order_id = o_orderkey JOIN part ON product = p_partkey GROUP BY 1, 2),
    r AS (SELECT *, percent_rank() OVER (PARTITION BY brand ORDER BY spent DESC) AS pr FROM s)
    SELECT brand, customer_id, CAST(spent AS DOUBLE) AS spent FROM r WHERE pr <= 0.1""",
)
def whales(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"))
    p = table(spark, sf, "part").select(F.col("p_partkey").alias("product"), F.col("p_brand").alias("brand"))
    spend = (
        sales(spark, sf).join(p, "product").join(o, "order_id").groupBy("brand", "customer_id").agg(F.sum("revenue").alias("spent"))
    )
    return A.top_share(spend, ["brand"], "customer_id", "spent", 0.1)


@query(
    "dau",
    """SELECT strftime(ts, '%Y-%m-%d') AS day, COUNT(DISTINCT user_id) AS users, COUNT(*) AS events FROM events GROUP BY 1""",
)
def dau(spark, sf):
    per = events(spark, sf).groupBy(F.col("ts").cast("date").alias("day"), "user_id").agg(F.count("*").alias("n"))
    return per.groupBy("day").agg(F.count("*").alias("users"), F.sum("n").alias("events"))


@query(
    "mau",
    """SELECT strftime(ts, '%Y-%m') AS month, COUNT(DISTINCT user_id) AS users FROM events GROUP BY 1""",
)
def mau(spark, sf):
    return events(spark, sf).groupBy(year_month("ts").alias("month")).agg(F.countDistinct("user_id").alias("users"))


@query(
    "error_rate",
    """SELECT strftime(ts, '%Y-%m-%d') AS day, COUNT(*) AS n, COUNT(*) FILTER (WHERE event_type = 'error') AS errors,
    CAST(COUNT(*) FILTER (WHERE event_type = 'error') AS DOUBLE) / COUNT(*) AS error_rate FROM events GROUP BY 1""",
)
def error_rate(spark, sf):
    errors = F.count_if(F.col("event_type") == "error")
    return events(spark, sf).groupBy(F.col("ts").cast("date").alias("day")).agg(
        F.count("*").alias("n"), errors.alias("errors"), ratio(errors, F.count("*")).alias("error_rate")
    )


@query(
    "top_features",
    """SELECT event_type, COUNT(*) AS n, COUNT(DISTINCT user_id) AS users FROM events GROUP BY 1 ORDER BY n DESC, event_type LIMIT 5""",
)
def top_features(spark, sf):
    per = events(spark, sf).groupBy("event_type", "user_id").agg(F.count("*").alias("n"))
    return (
        per.groupBy("event_type").agg(F.sum("n").alias("n"), F.count("*").alias("users"))
        .orderBy(F.desc("n"), "event_type").limit(5)
    )


@query(
    "sketch_members",
)
def sketch_members(spark, sf):
    """Daily sketches merged to years: rows and about how many customers."""
    o = table(spark, sf, "orders").select("o_custkey", F.col("o_orderdate").cast("date").alias("d"))
    return A.merge_sketches(A.daily_sketch(o, F.col("d"), "o_custkey"), F.date_format("day", "yyyy"))


@query(
    "rollup_daily",
    """SELECT event_type, strftime(ts, '%Y-%m-%d 00:00:00') AS slot, COUNT(*) AS n,
    CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total, MIN(value) AS lowest, MAX(value) AS highest
    FROM events WHERE ts >= TIMESTAMP '2024-01-10' GROUP BY 1, 2""",
)
def rollup_daily(spark, sf):
    """Detail to hours to days, from additive partials, within the retention."""
    hourly = A.rollup_level(events(spark, sf), ["event_type"], "ts", "hour")
    daily = A.rollup_level(hourly, ["event_type"], "slot", "day")
    return A.retained(daily, "slot", date(2024, 1, 30), 20)


@query(
    "salted_agg",
    f"""WITH {ORDERS} SELECT customer_id, CAST(SUM(amount) AS DOUBLE) AS total, COUNT(*) AS n FROM ord GROUP BY 1""",
)
def salted_agg(spark, sf):
    rows = orders(spark, sf).select("order_id", "customer_id", "amount")
    return A.salted_totals(rows, "customer_id", "amount", salts=8)


@query(
    "mip_agg",
    """SELECT event_type, CAST(SUM(CAST(ROUND(value * 100) AS BIGINT)) AS BIGINT) AS total, COUNT(*) AS n FROM events GROUP BY 1""",
)
def mip_agg(spark, sf):
    cents = F.round(F.col("value") * 100).cast("long")
    return A.partition_totals(events(spark, sf).select("event_type", cents.alias("cents")), "event_type", "cents")


@query(
    "cohorts",
    """WITH a AS (SELECT DISTINCT o_custkey AS c, (year(o_orderdate) * 12 + month(o_orderdate)) AS m, strftime(o_orderdate, '%Y-%m') AS t FROM orders),
    j AS (SELECT c, MIN(m) AS m0, MIN(t) AS cohort FROM a GROUP BY 1),
    s AS (SELECT m0, cohort, COUNT(*) AS members FROM j GROUP BY 1, 2),
    l AS (SELECT j.m0, a.m - j.m0 AS o, COUNT(*) AS active FROM a JOIN j USING (c) WHERE a.m - j.m0 IN (1, 3, 6) GROUP BY 1, 2)
    SELECT cohort, o AS "offset", members, active, CAST(active AS DOUBLE) / members AS share FROM l JOIN s USING (m0)""",
)
def cohorts(spark, sf):
    return A.cohorts(table(spark, sf, "orders"), "o_custkey", "o_orderdate", [1, 3, 6])


@query(
    "cost_by_team",
    f"""WITH {COSTS}, m AS (SELECT team, strftime(date, '%Y-%m') AS mo, SUM(cost) AS c FROM costs GROUP BY 1, 2)
    SELECT team, CAST(SUM(c) AS DOUBLE) AS total, CAST(SUM(c) AS DOUBLE) / COUNT(*) AS monthly_average FROM m GROUP BY 1""",
)
def cost_by_team(spark, sf):
    monthly = costs(spark, sf).groupBy("team", year_month("date").alias("mo")).agg(F.sum("cost").alias("c"))
    return (
        monthly.groupBy("team").agg(F.sum("c").alias("total"), F.count("*").alias("n"))
        .select("team", "total", (F.col("total").cast("double") / F.col("n")).alias("monthly_average"))
    )


@query(
    "cost_breakdown",
    f"""WITH {COSTS} SELECT team, service, environment, CAST(SUM(cost) AS DOUBLE) AS total FROM costs GROUP BY 1, 2, 3""",
)
def cost_breakdown(spark, sf):
    return costs(spark, sf).groupBy("team", "service", "environment").agg(F.sum("cost").alias("total"))
