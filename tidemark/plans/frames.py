"""The business tables of the exercises, mapped onto the star-schema tables.

Each frame has a SQL twin (a CTE body) for the comparing engine.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.columns import money, net_revenue
from tidemark.plans.registry import table

AS_OF = date(1998, 8, 1)
EVENTS_AS_OF = date(2024, 1, 29)
LAST_ORDER_DAY = date(2001, 8, 1)

# Order states and environments behind the status letters.
STATUS = {"F": "completed", "O": "pending", "P": "cancelled"}
ENVIRONMENT = {"O": "production", "F": "staging", "P": "development"}


def _named(column: str, names: dict[str, str]):
    out = None
    for k, v in names.items():
        test = F.col(column) == k
        out = F.when(test, v) if out is None else out.when(test, v)
    return out


def customers(spark: SparkSession, sf: str) -> DataFrame:
    """Customers with country and region; dimensions join by AQE's size check."""
    nation = table(spark, sf, "nation").join(
        table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    return (
        table(spark, sf, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_name").alias("name"),
            F.col("n_name").alias("country"),
            F.col("r_name").alias("region"),
            F.col("c_mktsegment").alias("segment"),
            F.col("c_acctbal").alias("balance"),
        )
    )


CUSTOMERS = """cust AS (SELECT c_custkey AS customer_id, c_name AS name, n_name AS country,
 r_name AS region, c_mktsegment AS segment, c_acctbal AS balance
 FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""


def orders(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        _named("o_orderstatus", STATUS).alias("status"),
        money("o_totalprice").alias("amount"),
        F.col("o_orderdate").alias("order_date"),
        F.col("o_orderpriority").alias("priority"),
    )


ORDERS = """ord AS (SELECT o_orderkey AS order_id, o_custkey AS customer_id,
 CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'pending' ELSE 'cancelled' END AS status,
 CAST(o_totalprice AS DECIMAL(18,2)) AS amount, o_orderdate AS order_date,
 o_orderpriority AS priority FROM orders)"""


def sales(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line"),
        F.col("l_partkey").alias("product"),
        F.col("l_suppkey").alias("supplier"),
        F.col("l_quantity").alias("quantity"),
        net_revenue("l_extendedprice", "l_discount").alias("revenue"),
        F.col("l_shipdate").alias("sale_date"),
        F.col("l_discount").alias("discount"),
    )


SALES = """sales AS (SELECT l_orderkey AS order_id, l_linenumber AS line, l_partkey AS product,
 l_suppkey AS supplier, l_quantity AS quantity,
 CAST(l_extendedprice AS DECIMAL(12,2)) * (CAST(1 AS DECIMAL(4,2)) - CAST(l_discount AS DECIMAL(4,2))) AS revenue,
 l_shipdate AS sale_date, l_discount AS discount FROM lineitem)"""


def store_days(spark: SparkSession, sf: str) -> DataFrame:
    """Revenue per store (supplier nation) and day."""
    suppliers = table(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    return (
        sales(spark, sf)
        .join(suppliers, F.col("supplier") == F.col("s_suppkey"))
        .groupBy(
            F.col("s_nationkey").cast("long").alias("store"),
            F.col("sale_date").cast("date").alias("day"),
        )
        .agg(F.sum("revenue").alias("revenue"))
    )


STORE_DAYS = SALES + """, store_days AS (SELECT CAST(s_nationkey AS BIGINT) AS store,
 CAST(sale_date AS DATE) AS day, SUM(revenue) AS revenue
 FROM sales JOIN supplier ON supplier = s_suppkey GROUP BY 1, 2)"""


def costs(spark: SparkSession, sf: str) -> DataFrame:
    teams = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return (
        table(spark, sf, "orders")
        .join(teams, F.col("o_custkey") == F.col("c_custkey"))
        .select(
            F.col("o_orderdate").cast("date").alias("date"),
            F.col("c_mktsegment").alias("team"),
            F.col("o_orderpriority").alias("service"),
            _named("o_orderstatus", ENVIRONMENT).alias("environment"),
            money("o_totalprice").alias("cost"),
        )
    )


COSTS = """costs AS (SELECT CAST(o_orderdate AS DATE) AS date, c_mktsegment AS team,
 o_orderpriority AS service, CASE o_orderstatus WHEN 'O' THEN 'production'
 WHEN 'F' THEN 'staging' ELSE 'development' END AS environment,
 CAST(o_totalprice AS DECIMAL(18,2)) AS cost
 FROM orders JOIN customer ON o_custkey = c_custkey)"""


def events(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events")


def follows(spark: SparkSession, sf: str) -> DataFrame:
    """Follower edges derived from orders, without self-loops."""
    size = table(spark, sf, "customer").count()
    return (
        table(spark, sf, "orders")
        .select(
            F.col("o_custkey").alias("follower_id"),
            F.pmod(F.col("o_orderkey"), F.lit(size)).alias("followed_id"),
        )
        .filter("follower_id <> followed_id")
        .distinct()
    )


FOLLOWS = """follows AS (SELECT DISTINCT o_custkey AS follower_id,
 o_orderkey % (SELECT COUNT(*) FROM customer) AS followed_id FROM orders
 WHERE o_custkey <> o_orderkey % (SELECT COUNT(*) FROM customer))"""


def staged_customers(spark: SparkSession, sf: str) -> DataFrame:
    """A later delivery of customers: some balances changed, some keys new."""
    c = table(spark, sf, "customer")
    changed = c.withColumn(
        "c_acctbal",
        F.when(F.col("c_mktsegment") == "BUILDING", F.col("c_acctbal") + 100.0).otherwise(
            F.col("c_acctbal")
        ),
    )
    fresh = c.filter(F.col("c_acctbal") < 0).withColumn("c_custkey", -1 - F.col("c_custkey"))
    return changed.unionByName(fresh)


STAGED = """staged AS (SELECT c_custkey, c_name, c_nationkey,
 CASE WHEN c_mktsegment = 'BUILDING' THEN c_acctbal + 100.0 ELSE c_acctbal END AS c_acctbal,
 c_mktsegment FROM customer
 UNION ALL SELECT -1 - c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment
 FROM customer WHERE c_acctbal < 0)"""
