"""Sources and sinks over the given tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.plans.frames import events, orders
from tidemark.plans.registry import query, table
from tidemark.session import fresh_path
from tidemark.sources import files
from tidemark.sources.monthly import register_monthly

CUSTOMER = (
    T.StructType()
    .add("c_custkey", "long")
    .add("c_name", "string")
    .add("c_nationkey", "integer")
    .add("c_acctbal", "double")
    .add("c_mktsegment", "string")
)


@query(
    "scan_orders",
    "SELECT o_orderkey, o_custkey, o_totalprice FROM orders",
)
def scan_orders(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")


@query(
    "external_scan",
    "SELECT o_orderpriority, COUNT(*) AS n FROM orders GROUP BY 1",
)
def external_scan(spark, sf):
    """Files left in place, addressed by path in SQL."""
    return spark.sql(
        f"SELECT o_orderpriority, count(*) AS n FROM parquet.`{sf.rstrip('/')}/orders.parquet` GROUP BY 1"
    )


@query(
    "events_props",
    """SELECT event_type, COUNT(*) AS n, CAST(SUM(CAST(json_extract(props, '$.k') AS BIGINT)) AS BIGINT) AS sum_k
    FROM events GROUP BY 1""",
)
def events_props(spark, sf):
    """Only the needed JSON field is parsed."""
    props = F.from_json("props", "k long")
    return (
        events(spark, sf)
        .select("event_type", props["k"].alias("k"))
        .groupBy("event_type")
        .agg(F.count("*").alias("n"), F.sum("k").alias("sum_k"))
    )


@query(
    "events_json_files",
    """SELECT event_type, COUNT(*) AS n FROM events GROUP BY 1""",
)
def events_json_files(spark, sf):
    """Events as many JSON files, read back by glob with a two-field schema."""
    path = fresh_path(spark, "json")
    events(spark, sf).write.partitionBy("event_type").json(path)
    rows = spark.read.option("basePath", path).schema("event_id long, event_type string").json(f"{path}/*/*")
    return rows.groupBy("event_type").agg(F.count("event_id").alias("n"))


@query(
    "bulk_load",
    """SELECT CASE WHEN c_acctbal >= 0 THEN 'good' ELSE 'rejected' END AS outcome, COUNT(*) AS n
    FROM customer GROUP BY 1""",
)
def bulk_load(spark, sf):
    """CSV load that goes on past bad rows: negative balances are rejected lines."""
    path = fresh_path(spark, "csv")
    files.write_csv(table(spark, sf, "customer"), path)
    good, bad = files.load_csv(spark, path, CUSTOMER, F.col("c_acctbal") >= 0)
    return (
        good.select(F.lit("good").alias("outcome"))
        .unionByName(bad.select(F.lit("rejected").alias("outcome")))
        .groupBy("outcome")
        .agg(F.count("*").alias("n"))
    )


@query(
    "csv_round_trip",
    """SELECT c_mktsegment, COUNT(*) AS n, CAST(SUM(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS balance
    FROM customer GROUP BY 1""",
)
def csv_round_trip(spark, sf):
    path = fresh_path(spark, "csv")
    files.write_csv(table(spark, sf, "customer"), path)
    rows = files.read_csv(spark, path, CUSTOMER)
    return rows.groupBy("c_mktsegment").agg(
        F.count("*").alias("n"), F.sum(F.col("c_acctbal").cast("decimal(18,2)")).alias("balance")
    )


@query(
    "orders_by_month_written",
    "SELECT strftime(o_orderdate, '%Y-%m') AS order_month, COUNT(*) AS n FROM orders GROUP BY 1",
)
def orders_by_month_written(spark, sf):
    path = fresh_path(spark, "months")
    files.write_by_month(table(spark, sf, "orders"), path, "o_orderdate", "order_month")
    rows = spark.read.schema("o_orderkey long, order_month string").parquet(path)
    return rows.groupBy("order_month").agg(F.count("*").alias("n"))


@query(
    "orders_since",
    """SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderdate >= TIMESTAMP '1999-03-15'""",
)
def orders_since(spark, sf):
    """Read back by time: the month predicate prunes folders."""
    path = fresh_path(spark, "months")
    files.write_by_month(table(spark, sf, "orders"), path, "o_orderdate", "order_month")
    rows = files.read_since(spark, path, "o_orderdate", "order_month", datetime(1999, 3, 15))
    return rows.select("o_orderkey", "o_totalprice")


@query(
    "monthly_source",
    """SELECT strftime(o_orderdate, '%Y-%m') AS month, COUNT(*) AS n FROM orders
    WHERE strftime(o_orderdate, '%Y-%m') >= '2000-01' GROUP BY 1""",
)
def monthly_source(spark, sf):
    """The custom source: the month filter is pushed into its file listing."""
    register_monthly(spark)
    path = fresh_path(spark, "months")
    files.write_by_month(table(spark, sf, "orders"), path, "o_orderdate", "month", codec="snappy")
    uri = path if "://" in path or path.startswith("file:") else f"file://{path}"
    rows = spark.read.format("monthly").schema("o_orderkey long, month string").load(uri)
    return rows.filter("month >= '2000-01'").groupBy("month").agg(F.count("*").alias("n"))


@query(
    "fed_ltv_top20",
    """SELECT c_custkey, c_name, COUNT(*) AS orders,
    CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS lifetime_value
    FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2
    ORDER BY lifetime_value DESC, c_custkey LIMIT 20""",
)
def fed_ltv_top20(spark, sf):
    """Orders from Parquet, customers from a CSV copy, in one query."""
    path = fresh_path(spark, "csv")
    files.write_csv(table(spark, sf, "customer"), path)
    people = files.read_csv(spark, path, CUSTOMER).select("c_custkey", "c_name")
    spend = orders(spark, sf).groupBy(F.col("customer_id").alias("c_custkey")).agg(
        F.count("*").alias("orders"), F.sum("amount").alias("lifetime_value")
    )
    joined = spend.join(people, "c_custkey")
    return joined.orderBy(F.desc("lifetime_value"), "c_custkey").limit(20)


@query(
    "row_counts",
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, COUNT(*) AS row_count FROM {t}"
        for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
    ),
)
def row_counts(spark, sf):
    names = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
    return files.table_counts({n: table(spark, sf, n) for n in names})


CODECS = ["zstd", "snappy", "gzip", "lz4_raw"]


@query("codec_sizes")
def codec_sizes(spark, sf):
    """The same table per compression codec: rows and bytes."""
    return files.bytes_per_codec(table(spark, sf, "orders"), fresh_path(spark, "codecs"), CODECS)


@query(
    "staged_revenue",
    """SELECT l_returnflag, COUNT(*) AS lines, CAST(SUM(l_quantity) AS DOUBLE) AS quantity
    FROM lineitem WHERE l_shipdate >= TIMESTAMP '1997-01-01' GROUP BY 1""",
)
def staged_revenue(spark, sf):
    """Step-wise work through session-scoped views."""
    table(spark, sf, "lineitem").createOrReplaceTempView("stage_lines")
    spark.sql(
        "SELECT l_returnflag, l_quantity FROM stage_lines WHERE l_shipdate >= TIMESTAMP_NTZ '1997-01-01'"
    ).createOrReplaceTempView("stage_recent")
    return spark.sql(
        """SELECT l_returnflag, count(*) AS lines, sum(l_quantity) AS quantity
        FROM stage_recent GROUP BY l_returnflag"""
    )


@query(
    "clickstream_daily",
    """SELECT strftime(ts, '%Y-%m-%d') AS day, n_name AS country, event_type AS category,
    COUNT(*) AS n, CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total
    FROM events JOIN customer ON user_id = c_custkey JOIN nation ON c_nationkey = n_nationkey
    GROUP BY 1, 2, 3""",
)
def clickstream_daily(spark, sf):
    """Early projection, dimensions joined after a pre-aggregation by user."""
    daily = (
        events(spark, sf)
        .groupBy(F.col("ts").cast("date").alias("day"), "user_id", F.col("event_type").alias("category"))
        .agg(F.count("*").alias("n"), F.sum(F.col("value").cast("decimal(18,2)")).alias("total"))
    )
    home = table(spark, sf, "customer").join(
        table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    ).select(F.col("c_custkey").alias("user_id"), F.col("n_name").alias("country"))
    return (
        daily.join(home, "user_id")
        .groupBy("day", "country", "category")
        .agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    )


PROFILE_SQL = " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, COUNT(*) AS row_count, COUNT(*) - COUNT({c}) AS nulls,
    COUNT(DISTINCT {c}) AS distinct_values, CAST(MIN({c}) AS VARCHAR) AS min_value,
    CAST(MAX({c}) AS VARCHAR) AS max_value FROM customer"""
    for c in CUSTOMER.names
)


@query("profile_customer", PROFILE_SQL)
def profile_customer(spark, sf):
    return files.profile(table(spark, sf, "customer"), exact=True).drop("data_type")


LINES = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag"]


@query("column_sketches")
def column_sketches(spark, sf):
    """One pass with sketches, as used on very large tables."""
    return files.profile(table(spark, sf, "lineitem").select(*LINES)).select(
        "column_name", "row_count", "nulls", "distinct_values", "min_value", "max_value"
    )


@query(
    "schema_card",
    """SELECT o_orderpriority AS value, COUNT(*) AS n FROM orders GROUP BY 1 ORDER BY n DESC, 1 LIMIT 10""",
)
def schema_card(spark, sf):
    return files.common_values(table(spark, sf, "orders"), "o_orderpriority")
