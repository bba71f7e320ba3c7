"""Projections, filters and scalar functions."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from tidemark.functions import columns as C
from tidemark.operators.joins import entitled
from tidemark.plans.frames import AS_OF, CUSTOMERS, ORDERS, customers, events, orders
from tidemark.plans.registry import query, table


@query(
    "line_revenue",
    """SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_quantity * l_extendedprice AS total_revenue
    FROM lineitem""",
)
def line_revenue(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", (F.col("l_quantity") * F.col("l_extendedprice")).alias("total_revenue")
    )


@query(
    "line_total",
    """SELECT l_orderkey, CAST(SUM(CAST(ROUND(CAST(l_extendedprice AS DECIMAL(12,2))
    * CAST(l_tax AS DECIMAL(4,2)), 2) AS DECIMAL(18,2))) AS DOUBLE) AS tax FROM lineitem GROUP BY 1""",
)
def line_total(spark, sf):
    """Rounded to cents half-up before summing."""
    tax = F.round(F.col("l_extendedprice").cast("decimal(12,2)") * F.col("l_tax").cast("decimal(4,2)"), 2)
    return table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.sum(C.money(tax)).alias("tax"))


@query(
    "high_value_orders",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 400000",
)
def high_value_orders(spark, sf):
    return table(spark, sf, "orders").filter("o_totalprice > 400000").select("o_orderkey", "o_totalprice")


@query(
    "null_tests",
    """SELECT COUNT(*) AS docs, COUNT(*) FILTER (WHERE quality IS NULL) AS is_null,
    COUNT(*) FILTER (WHERE quality IS NOT NULL) AS is_known,
    COUNT(*) FILTER (WHERE quality = NULL) AS equals_null,
    COUNT(*) FILTER (WHERE quality <> 0) AS not_zero
    FROM documents LEFT JOIN labels USING (doc_id)""",
)
def null_tests(spark, sf):
    """= NULL matches nothing; <> drops NULLs as well."""
    rows = table(spark, sf, "documents").select("doc_id").join(table(spark, sf, "labels"), "doc_id", "left")
    q = F.col("quality")
    return rows.agg(
        F.count("*").alias("docs"),
        F.count_if(q.isNull()).alias("is_null"),
        F.count_if(q.isNotNull()).alias("is_known"),
        F.count_if(q == F.lit(None)).alias("equals_null"),
        F.count_if(q != 0).alias("not_zero"),
    )


@query(
    "orders_status_in",
    "SELECT o_orderstatus, COUNT(*) AS n FROM orders WHERE o_orderstatus IN ('F', 'O') GROUP BY 1",
)
def orders_status_in(spark, sf):
    rows = table(spark, sf, "orders").filter(F.col("o_orderstatus").isin("F", "O"))
    return rows.groupBy("o_orderstatus").agg(F.count("*").alias("n"))


@query(
    "march_orders",
    """SELECT o_orderkey, o_totalprice FROM orders
    WHERE o_orderdate >= TIMESTAMP '1998-03-01' AND o_orderdate < TIMESTAMP '1998-04-01'""",
)
def march_orders(spark, sf):
    """A range on the raw column, which Parquet statistics can prune."""
    march = C.between("o_orderdate", datetime(1998, 3, 1), datetime(1998, 4, 1))
    return table(spark, sf, "orders").filter(march).select("o_orderkey", "o_totalprice")


@query(
    "last_month_orders",
    """SELECT 'last month' AS period, COUNT(*) AS n FROM orders
      WHERE o_orderdate >= TIMESTAMP '1998-07-01' AND o_orderdate < TIMESTAMP '1998-08-01'
    UNION ALL SELECT 'year to date', COUNT(*) FROM orders
      WHERE o_orderdate >= TIMESTAMP '1998-01-01' AND o_orderdate < TIMESTAMP '1998-08-02'
    UNION ALL SELECT 'last 7 days', COUNT(*) FROM orders
      WHERE o_orderdate >= TIMESTAMP '1998-07-25' AND o_orderdate < TIMESTAMP '1998-08-01'
    UNION ALL SELECT 'since one month', COUNT(*) FROM orders
      WHERE o_orderdate >= DATE '1998-08-01' - INTERVAL 1 MONTH AND o_orderdate < TIMESTAMP '1998-08-01'""",
)
def last_month_orders(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderdate")
    periods = {
        "last month": C.in_month("o_orderdate", AS_OF, 1),
        "year to date": C.year_to_date("o_orderdate", AS_OF),
        "last 7 days": C.last_days("o_orderdate", AS_OF, 7),
        "since one month": C.since_months("o_orderdate", AS_OF, 1),
    }
    counts = rows.agg(*[F.count_if(p).alias(n) for n, p in periods.items()])
    return counts.select(
        F.inline(F.array(*[F.struct(F.lit(n).alias("period"), F.col(f"`{n}`").alias("n")) for n in periods]))
    )


@query(
    "customer_segment",
    """WITH s AS (SELECT o_custkey AS customer_id, SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS t FROM orders GROUP BY 1)
    SELECT customer_id, CASE WHEN t > 3000000 THEN 'Premium' WHEN t > 2000000 THEN 'Standard' ELSE 'Basic' END AS segment
    FROM s""",
)
def customer_segment(spark, sf):
    spend = orders(spark, sf).groupBy("customer_id").agg(F.sum("amount").alias("t"))
    band = C.banded(F.col("t"), [(3_000_000, "Premium"), (2_000_000, "Standard")], "Basic", False)
    return spend.select("customer_id", band.alias("segment"))


@query(
    "order_band",
    """SELECT o_orderkey, CASE WHEN o_totalprice >= 300000 THEN 'High' WHEN o_totalprice >= 100000 THEN 'Medium'
    ELSE 'Low' END AS band FROM orders""",
)
def order_band(spark, sf):
    band = C.banded(F.col("o_totalprice"), [(300000, "High"), (100000, "Medium")], "Low", True)
    return table(spark, sf, "orders").select("o_orderkey", band.alias("band"))


@query(
    "renamed_export",
    f"""WITH {CUSTOMERS}, {ORDERS} SELECT order_id, name AS customer_name, country, status AS order_status
    FROM ord JOIN cust USING (customer_id)""",
)
def renamed_export(spark, sf):
    """Colliding names are renamed before the join; only export columns are kept."""
    left = orders(spark, sf).withColumnsRenamed({"status": "order_status"})
    right = customers(spark, sf).withColumnsRenamed({"name": "customer_name"})
    return left.join(right, "customer_id").select("order_id", "customer_name", "country", "order_status")


@query(
    "casts",
    """SELECT o_orderkey::VARCHAR AS key_text, CAST(o_totalprice AS DECIMAL(12,2))::DOUBLE AS price,
    strftime(o_orderdate, '%Y-%m-%d') AS day, TRY_CAST(o_orderpriority AS BIGINT) AS not_a_number FROM orders""",
)
def casts(spark, sf):
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("key_text"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("price"),
        F.col("o_orderdate").cast("date").alias("day"),
        F.col("o_orderpriority").try_cast("long").alias("not_a_number"),
    )


@query(
    "upper_customer",
    """SELECT c_custkey AS "C_CUSTKEY", upper(c_name) AS "C_NAME", upper(c_mktsegment) AS "C_MKTSEGMENT" FROM customer""",
)
def upper_customer(spark, sf):
    rows = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return C.upper_names(C.upper_values(rows))


@query(
    "order_calendar",
    """SELECT o_orderkey, year(o_orderdate) AS year, month(o_orderdate) AS month,
    dayofweek(o_orderdate) + 1 AS day_of_week FROM orders""",
)
def order_calendar(spark, sf):
    d = F.to_date("o_orderdate")
    return table(spark, sf, "orders").select(
        "o_orderkey", F.year(d).alias("year"), F.month(d).alias("month"), F.dayofweek(d).alias("day_of_week")
    )


@query(
    "order_month",
    """SELECT strftime(o_orderdate, '%Y-%m') AS order_month, COUNT(*) AS n FROM orders GROUP BY 1""",
)
def order_month(spark, sf):
    return (
        table(spark, sf, "orders")
        .groupBy(C.year_month("o_orderdate").alias("order_month"))
        .agg(F.count("*").alias("n"))
    )


@query(
    "days_since",
    """SELECT o_orderkey, date_diff('day', CAST(o_orderdate AS DATE), DATE '1998-08-01') AS days FROM orders""",
)
def days_since(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", F.datediff(F.lit(AS_OF), "o_orderdate").alias("days")
    )


@query(
    "fmt_date",
    """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS plain, strftime(o_orderdate, '%d.%m.%Y') AS dotted
    FROM orders""",
)
def fmt_date(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey",
        C.fmt_date("o_orderdate").alias("plain"),
        C.fmt_date("o_orderdate", "dd.MM.yyyy").alias("dotted"),
    )


@query(
    "sql_function_date",
    """SELECT strftime(o_orderdate, '%Y/%m') AS month_text, COUNT(*) AS n FROM orders GROUP BY 1""",
)
def sql_function_date(spark, sf):
    """The same helper as a SQL function with a default argument."""
    spark.sql(
        """CREATE OR REPLACE TEMPORARY FUNCTION day_text(d TIMESTAMP_NTZ, p STRING DEFAULT 'yyyy-MM-dd')
        RETURNS STRING RETURN date_format(d, p)"""
    )
    return (
        table(spark, sf, "orders")
        .select(F.expr("day_text(o_orderdate, 'yyyy/MM')").alias("month_text"))
        .groupBy("month_text")
        .agg(F.count("*").alias("n"))
    )


@query(
    "hour_steps",
    """SELECT o_orderkey, strftime(o_orderdate - (CAST(o_custkey AS INTEGER) % 24) * INTERVAL 1 HOUR,
    '%Y-%m-%d %H:%M:%S') AS earlier FROM orders""",
)
def hour_steps(spark, sf):
    n = F.pmod(F.col("o_custkey"), F.lit(24)).cast("int")
    return table(spark, sf, "orders").select(
        "o_orderkey", C.steps_back(F.col("o_orderdate"), n, "1 HOUR").alias("earlier")
    )


@query(
    "null_safe_diff",
    """SELECT doc_id, quality IS DISTINCT FROM toxic AS differs, quality IS DISTINCT FROM 1 AS not_good
    FROM documents LEFT JOIN labels USING (doc_id)""",
)
def null_safe_diff(spark, sf):
    rows = table(spark, sf, "documents").select("doc_id").join(table(spark, sf, "labels"), "doc_id", "left")
    return rows.select(
        "doc_id",
        C.differs(F.col("quality"), F.col("toxic")).alias("differs"),
        C.differs(F.col("quality"), F.lit(1)).alias("not_good"),
    )


@query(
    "row_hashes",
    """SELECT COUNT(*) AS row_count, (SELECT COUNT(*) FROM (SELECT DISTINCT l_partkey, l_suppkey, l_quantity FROM lineitem)) AS hashes
    FROM lineitem""",
)
def row_hashes(spark, sf):
    """Distinct row hashes, counted after a combine by hash."""
    hashed = table(spark, sf, "lineitem").groupBy(
        C.row_hash(["l_partkey", "l_suppkey", "l_quantity"]).alias("h")
    ).agg(F.count("*").alias("n"))
    return hashed.agg(F.sum("n").alias("row_count"), F.count("*").alias("hashes"))


@query(
    "mask_names",
    """SELECT c_custkey, CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN c_name ELSE
    regexp_replace(left(c_name, length(c_name) - 4), '[0-9A-Za-z]', 'X', 'g') || right(c_name, 4) END AS shown
    FROM customer""",
)
def mask_names(spark, sf):
    shown = C.mask_for(F.col("c_mktsegment"), ["HOUSEHOLD"], F.col("c_name"))
    return table(spark, sf, "customer").select("c_custkey", shown.alias("shown"))


@query(
    "rls_nation",
    """SELECT c_custkey, CAST(c_nationkey AS BIGINT) AS c_nationkey FROM customer
    WHERE c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 1)""",
)
def rls_nation(spark, sf):
    """Rows visible to a user entitled to one region."""
    grants = table(spark, sf, "nation").filter("n_regionkey = 1").select(F.col("n_nationkey").alias("c_nationkey"))
    return entitled(table(spark, sf, "customer").select("c_custkey", "c_nationkey"), grants, ["c_nationkey"])


@query(
    "like_name",
    """SELECT p_partkey, p_name FROM part WHERE p_name LIKE '%ring%' OR regexp_matches(p_name, '^(red|blue) b')""",
)
def like_name(spark, sf):
    name = F.col("p_name")
    return table(spark, sf, "part").filter(name.like("%ring%") | name.rlike("^(red|blue) b")).select("p_partkey", "p_name")


@query(
    "json_path",
    """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events
    WHERE CAST(json_extract(props, '$.k') AS BIGINT) >= 50""",
)
def json_path(spark, sf):
    k = C.json_value("props", "$.k", "long")
    return events(spark, sf).select("event_id", k.alias("k")).filter("k >= 50")


@query(
    "json_nested",
    """SELECT event_id, event_type AS first_type, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events""",
)
def json_nested(spark, sf):
    """Array index and nested path in one JSON document per event."""
    doc = F.to_json(F.array(F.struct("event_type", F.from_json("props", "k long").alias("metadata"))))
    return events(spark, sf).select(
        "event_id",
        C.json_value(doc, "$[0].event_type").alias("first_type"),
        C.json_value(doc, "$[0].metadata.k", "long").alias("k"),
    )


@query(
    "json_flatten",
    """SELECT conv_id, turn, CAST(i AS BIGINT) AS item_pos, CASE i WHEN 0 THEN role ELSE CAST(turn AS VARCHAR) END AS item
    FROM conversations, (VALUES (0), (1)) AS p(i)""",
)
def json_flatten(spark, sf):
    """A JSON array per turn, flattened to rows."""
    doc = F.to_json(F.array("role", F.col("turn").cast("string")))
    rows = table(spark, sf, "conversations").select("conv_id", "turn", doc.alias("doc"))
    return C.json_items(rows, "doc").drop("doc")


@query(
    "norm_key",
    """SELECT md5(lower(trim(text))) AS cache_key, COUNT(*) AS n FROM conversations GROUP BY 1""",
)
def norm_key(spark, sf):
    return (
        table(spark, sf, "conversations")
        .groupBy(C.normal_key("text").alias("cache_key"))
        .agg(F.count("*").alias("n"))
    )


@query(
    "partition_values",
    """SELECT o_orderkey, strftime(o_orderdate, '%Y') AS y, strftime(o_orderdate, '%Y-%m') AS m,
    strftime(o_orderdate, '%Y-%m-%d') AS d, strftime(o_orderdate, '%Y-%m-%d-%H') AS h,
    CAST(('0x' || substr(md5(CAST(o_custkey AS VARCHAR)), 1, 8)) AS BIGINT) % 16 AS b,
    o_custkey - o_custkey % 100 AS t, substr(o_orderpriority, 1, 1) AS p FROM orders""",
)
def partition_values(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey",
        C.partition_value("o_orderdate", "year").alias("y"),
        C.partition_value("o_orderdate", "month").alias("m"),
        C.partition_value("o_orderdate", "day").alias("d"),
        C.partition_value("o_orderdate", "hour").alias("h"),
        C.partition_value("o_custkey", "bucket", 16).alias("b"),
        C.partition_value("o_custkey", "truncate", 100).alias("t"),
        C.truncate("o_orderpriority", 1, text=True).alias("p"),
    )
