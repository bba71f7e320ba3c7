"""Joins over the mapped tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import joins as J
from tidemark.operators.scd import rebuild_timeline
from tidemark.plans.frames import (
    CUSTOMERS,
    FOLLOWS,
    ORDERS,
    SALES,
    customers,
    events,
    follows,
    orders,
    sales,
)
from tidemark.plans.registry import query, table
from tidemark.session import cut


@query(
    "orders_customer",
    f"WITH {CUSTOMERS}, {ORDERS} SELECT order_id, name, country, CAST(amount AS DOUBLE) AS amount FROM ord JOIN cust USING (customer_id)",
)
def orders_customer(spark, sf):
    return orders(spark, sf).join(customers(spark, sf), "customer_id").select("order_id", "name", "country", "amount")


@query(
    "covered_orders",
    f"""WITH {CUSTOMERS}, {ORDERS} SELECT order_id, CAST(amount AS DOUBLE) AS amount FROM ord
    WHERE EXISTS (SELECT 1 FROM cust WHERE cust.customer_id = ord.customer_id AND ord.amount <= cust.balance * 20)""",
)
def covered_orders(spark, sf):
    """Orders some account row can cover; duplicate accounts would not multiply them."""
    limits = customers(spark, sf).withColumn("credit", F.col("balance") * 20)
    rows = J.covering(orders(spark, sf), limits, "customer_id", "customer_id", "amount", "credit")
    return rows.select("order_id", "amount")


@query(
    "semi_orders",
    "SELECT o_orderkey FROM orders WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_quantity >= 45)",
)
def semi_orders(spark, sf):
    big = table(spark, sf, "lineitem").filter("l_quantity >= 45").select(F.col("l_orderkey").alias("o_orderkey"))
    return table(spark, sf, "orders").select("o_orderkey").join(big, "o_orderkey", "left_semi")


@query(
    "anti_customer",
    """SELECT c_custkey FROM customer WHERE NOT EXISTS
    (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderdate >= TIMESTAMP '2001-01-01')""",
)
def anti_customer(spark, sf):
    recent = (
        table(spark, sf, "orders")
        .filter(F.col("o_orderdate") >= F.lit("2001-01-01").cast("timestamp_ntz"))
        .select(F.col("o_custkey").alias("c_custkey"))
    )
    return table(spark, sf, "customer").select("c_custkey").join(recent, "c_custkey", "left_anti")


@query(
    "left_labels",
    "SELECT doc_id, lang, CAST(quality AS BIGINT) AS quality FROM documents LEFT JOIN labels USING (doc_id)",
)
def left_labels(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang")
    return docs.join(table(spark, sf, "labels").select("doc_id", "quality"), "doc_id", "left")


PROMO = """cover AS (SELECT DISTINCT CAST(sale_date AS DATE) AS d, product, product % 5 AS promo FROM sales WHERE discount >= 0.05)"""


@query(
    "promo_conversion",
    f"""WITH {SALES}, {PROMO},
    sold AS (SELECT DISTINCT CAST(sale_date AS DATE) AS d, product FROM sales WHERE quantity >= 25)
    SELECT cover.promo, COUNT(DISTINCT cover.product) AS eligible, COUNT(DISTINCT sold.product) AS sold,
    CAST(COUNT(DISTINCT sold.product) AS DOUBLE) / NULLIF(COUNT(DISTINCT cover.product), 0) AS conversion
    FROM cover LEFT JOIN sold ON cover.product = sold.product AND cover.d = sold.d GROUP BY 1""",
)
def promo_conversion(spark, sf):
    """Factless coverage left-joined on product and date; both sides distinct first."""
    s = sales(spark, sf).withColumn("d", F.col("sale_date").cast("date"))
    cover = s.filter("discount >= 0.05").select("d", "product").distinct()
    sold = s.filter("quantity >= 25").select("d", "product", F.lit(1).alias("hit")).distinct()
    # One row per product decides both distinct counts.
    per = cover.join(sold, ["product", "d"], "left").groupBy("product").agg(F.max("hit").alias("hit"))
    return (
        per.groupBy((F.col("product") % 5).alias("promo"))
        .agg(F.count("*").alias("eligible"), F.count("hit").alias("sold"))
        .withColumn("conversion", F.try_divide(F.col("sold").cast("double"), F.col("eligible").cast("double")))
    )


@query(
    "star_revenue",
    f"""WITH {SALES}, {CUSTOMERS} SELECT region, p_brand AS brand, CAST(SUM(revenue) AS DOUBLE) AS revenue, COUNT(*) AS lines
    FROM sales JOIN orders ON order_id = o_orderkey JOIN cust ON o_custkey = customer_id
    JOIN part ON product = p_partkey GROUP BY 1, 2""",
)
def star_revenue(spark, sf):
    """The dimensions meet the orders first, so that line items move by order only once."""
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"))
    regions = o.join(customers(spark, sf).select("customer_id", "region"), "customer_id").select("order_id", "region")
    brands = table(spark, sf, "part").select(F.col("p_partkey").alias("product"), F.col("p_brand").alias("brand"))
    return (
        sales(spark, sf).select("order_id", "product", "revenue")
        .join(brands, "product")
        .join(regions, "order_id")
        .groupBy("region", "brand")
        .agg(F.sum("revenue").alias("revenue"), F.count("*").alias("lines"))
    )


@query(
    "busy_customer_orders",
    """SELECT o_orderkey, n AS orders_of_customer FROM orders JOIN
    (SELECT o_custkey, COUNT(*) AS n FROM orders GROUP BY 1 HAVING COUNT(*) >= 12) USING (o_custkey)""",
)
def busy_customer_orders(spark, sf):
    """Rows joined back to a filtered aggregate."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    busy = o.groupBy("o_custkey").agg(F.count("*").alias("orders_of_customer")).filter("orders_of_customer >= 12")
    return o.join(busy, "o_custkey").select("o_orderkey", "orders_of_customer")


@query(
    "overlapping_orders",
    """SELECT o_custkey, earlier AS earlier_o_orderkey, o_orderkey AS later_o_orderkey FROM (
    SELECT o_custkey, o_orderkey, o_orderdate, lag(o_orderkey) OVER w AS earlier, lag(o_orderdate) OVER w AS before
    FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey))
    WHERE o_orderdate < before + INTERVAL 30 DAY""",
)
def overlapping_orders(spark, sf):
    """Orders placed within the 30 days an earlier order of the customer is open."""
    spans = table(spark, sf, "orders").select(
        "o_custkey", "o_orderkey", F.col("o_orderdate").cast("date").alias("start"),
        F.date_add(F.col("o_orderdate").cast("date"), 30).alias("end"),
    )
    return J.overlapping(spans, "o_custkey", "o_orderkey", "start", "end")


MONTHLY_PRIORITY = """firsts AS (SELECT customer_id, CAST(date_trunc('month', order_date) AS DATE) AS effective_date,
 arg_max(priority, (order_date, order_id)) AS priority FROM ord GROUP BY 1, 2),
 turns AS (SELECT *, lag(priority) OVER (PARTITION BY customer_id ORDER BY effective_date) AS p FROM firsts),
 dim AS (SELECT customer_id, priority, effective_date,
 lead(effective_date) OVER (PARTITION BY customer_id ORDER BY effective_date) AS expiration_date
 FROM turns WHERE p IS DISTINCT FROM priority)"""


def priority_dim(spark, sf):
    """A versioned customer dimension: the last priority used in each month."""
    months = (
        orders(spark, sf)
        .groupBy("customer_id", F.trunc("order_date", "month").alias("effective_date"))
        .agg(F.max_by("priority", F.struct("order_date", "order_id")).alias("priority"))
    )
    # One row per customer and month bounds each key; read several times by callers.
    return cut(rebuild_timeline(months, months.limit(0), ["customer_id"], ["priority"], mode="window"))


@query(
    "point_in_time",
    f"""WITH {ORDERS}, {MONTHLY_PRIORITY} SELECT order_id, dim.priority AS valid_priority,
    strftime(effective_date, '%Y-%m-%d') AS effective_date FROM ord LEFT JOIN dim ON ord.customer_id = dim.customer_id
    AND effective_date <= order_date AND (expiration_date IS NULL OR expiration_date > order_date)""",
)
def point_in_time(spark, sf):
    dim = priority_dim(spark, sf).withColumnRenamed("priority", "valid_priority").drop("is_current")
    facts = orders(spark, sf).select("order_id", "customer_id", "order_date")
    return J.version_at(
        facts, dim, "customer_id", "order_date", "effective_date", "expiration_date", "order_id"
    ).select("order_id", "valid_priority", "effective_date")


@query(
    "versioned_revenue",
    f"""WITH {ORDERS}, {MONTHLY_PRIORITY} SELECT dim.priority, CAST(SUM(amount) AS DOUBLE) AS revenue, COUNT(*) AS orders
    FROM ord JOIN dim ON ord.customer_id = dim.customer_id AND effective_date <= order_date
    AND (expiration_date IS NULL OR expiration_date > order_date) GROUP BY 1""",
)
def versioned_revenue(spark, sf):
    """Facts carry the surrogate key of their version and join on it alone."""
    dim = priority_dim(spark, sf).withColumn("customer_key", F.xxhash64("customer_id", "effective_date"))
    facts = J.version_at(
        orders(spark, sf).select("order_id", "customer_id", "amount", "order_date"),
        dim.select("customer_id", "customer_key", "effective_date", "expiration_date"),
        "customer_id", "order_date", "effective_date", "expiration_date", "order_id",
    ).select("customer_key", "amount")
    return (
        facts.join(dim.select("customer_key", "priority"), "customer_key")
        .groupBy("priority")
        .agg(F.sum("amount").alias("revenue"), F.count("*").alias("orders"))
    )


@query(
    "asof_events",
    """WITH p AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase'),
    v AS (SELECT event_id AS view_id, user_id, ts, value FROM events WHERE event_type = 'view'),
    m AS (SELECT p.event_id, arg_max(v.value, (v.ts, v.view_id)) AS last_value FROM p LEFT JOIN v
    ON p.user_id = v.user_id AND v.ts <= p.ts GROUP BY 1) SELECT event_id, last_value FROM m""",
)
def asof_events(spark, sf):
    """For each purchase the user's latest view before it; no look-ahead."""
    e = events(spark, sf)
    bought = e.filter("event_type = 'purchase'").select("event_id", "user_id", "ts")
    seen = e.filter("event_type = 'view'").select("event_id", "user_id", "ts", "value")
    return J.as_of_join(bought, seen, "user_id", "ts", "event_id", ["value"]).select("event_id", "last_value")


@query(
    "broadcast_nation",
    "SELECT n_name, COUNT(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1",
)
def broadcast_nation(spark, sf):
    nation = J.broadcast_checked(table(spark, sf, "nation").select("n_nationkey", "n_name"))
    people = table(spark, sf, "customer").select("c_nationkey")
    return people.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).groupBy("n_name").agg(F.count("*").alias("n"))


SEGMENT_SPEND = f"""WITH {ORDERS} SELECT c_mktsegment AS segment, COUNT(*) AS orders, CAST(SUM(amount) AS DOUBLE) AS spent
    FROM ord JOIN customer ON customer_id = c_custkey GROUP BY 1"""


def _segments(spark, sf):
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("customer_id"), F.col("c_mktsegment").alias("segment")
    )


def _spend(joined):
    return joined.groupBy("segment").agg(F.count("*").alias("orders"), F.sum("amount").alias("spent"))


@query("salted_join", SEGMENT_SPEND)
def salted_join(spark, sf):
    facts = orders(spark, sf).select("order_id", "customer_id", "amount")
    return _spend(J.salted_join(facts, _segments(spark, sf), "customer_id", salts=8))


@query("hybrid_join", SEGMENT_SPEND)
def hybrid_join(spark, sf):
    facts = orders(spark, sf).select("customer_id", "amount")
    return _spend(J.hybrid_join(facts, _segments(spark, sf), "customer_id", share=0.001))


@query(
    "co_purchase",
    """WITH l AS (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem),
    seeds AS (SELECT l_partkey FROM l GROUP BY 1 ORDER BY COUNT(*) DESC, 1 LIMIT 10)
    SELECT a.l_partkey AS seed, b.l_partkey AS other, COUNT(*) AS baskets FROM l a
    JOIN l b ON a.l_orderkey = b.l_orderkey AND a.l_partkey <> b.l_partkey
    WHERE a.l_partkey IN (SELECT l_partkey FROM seeds) GROUP BY 1, 2""",
)
def co_purchase(spark, sf):
    """What was bought with each of the ten best-selling parts."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey")
    seeds = (
        lines.distinct().groupBy("l_partkey").agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), "l_partkey").limit(10).select("l_partkey")
    )
    return J.also_bought(lines, "l_orderkey", "l_partkey", seeds)


@query(
    "influence",
    f"""WITH {FOLLOWS}, d AS (SELECT followed_id AS node, COUNT(*) AS followers FROM follows GROUP BY 1),
    s AS (SELECT followed_id AS node, CAST(SUM(COALESCE(d.followers, 0)) AS BIGINT) AS second_hop
    FROM follows LEFT JOIN d ON follower_id = d.node GROUP BY 1)
    SELECT d.node, d.followers, s.second_hop, CAST(d.followers * 10 + s.second_hop AS DOUBLE) / 10.0 AS influence
    FROM d JOIN s USING (node) ORDER BY influence DESC, node LIMIT 100""",
)
def influence(spark, sf):
    scores = J.influence(follows(spark, sf), "follower_id", "followed_id")
    return scores.orderBy(F.desc("influence"), "node").limit(100)


@query(
    "viral_posts",
    f"""WITH {FOLLOWS} SELECT o_orderkey AS post_id, COUNT(*) AS likes, COUNT(*) FILTER (WHERE followed_id IS NULL) AS strangers
    FROM orders JOIN lineitem ON l_orderkey = o_orderkey
    LEFT JOIN follows ON follower_id = l_suppkey AND followed_id = o_custkey
    WHERE l_shipdate >= o_orderdate AND l_shipdate < o_orderdate + INTERVAL 1440 HOUR
    GROUP BY 1 HAVING COUNT(*) > 2 AND COUNT(*) FILTER (WHERE followed_id IS NULL) * 2 > COUNT(*)""",
)
def viral_posts(spark, sf):
    """Orders as posts, shipped lines as likes by suppliers, within 60 days."""
    posts = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("post_id"), F.col("o_custkey").alias("author_id"), F.col("o_orderdate").alias("posted_at")
    )
    likes = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("post_id"), F.col("l_suppkey").alias("user_id"), F.col("l_shipdate").alias("liked_at")
    )
    return J.viral_posts(posts, likes, follows(spark, sf), min_likes=2, hours=1440)


@query(
    "engagement",
    f"""WITH {FOLLOWS}, l AS (SELECT o_custkey AS u, COUNT(*) AS likes FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1),
    c AS (SELECT user_id AS u, COUNT(*) AS comments FROM events GROUP BY 1),
    f AS (SELECT followed_id AS u, COUNT(*) AS followers FROM follows GROUP BY 1)
    SELECT c_custkey AS user_id, COALESCE(likes, 0) AS likes, COALESCE(comments, 0) AS comments, COALESCE(followers, 0) AS followers,
    CAST(COALESCE(likes, 0) + COALESCE(comments, 0) AS DOUBLE) / NULLIF(COALESCE(followers, 0), 0) AS engagement_rate
    FROM customer LEFT JOIN l ON l.u = c_custkey LEFT JOIN c ON c.u = c_custkey LEFT JOIN f ON f.u = c_custkey
    ORDER BY engagement_rate DESC NULLS LAST, user_id LIMIT 10""",
)
def engagement(spark, sf):
    authors = table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("author_id"))
    likes = table(spark, sf, "lineitem").select("l_orderkey").join(authors, F.col("l_orderkey") == F.col("o_orderkey"))
    comments = events(spark, sf).select(F.col("user_id").alias("author_id"))
    users = table(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"))
    return J.engagement(users, likes, comments, follows(spark, sf))


@query(
    "cascade_delete",
    """SELECT o_orderkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)""",
)
def cascade_delete(spark, sf):
    """Orders left when customers in debt are removed."""
    gone = table(spark, sf, "customer").filter("c_acctbal < 0")
    return J.cascade(table(spark, sf, "orders"), gone, "o_custkey", "c_custkey").select("o_orderkey")
