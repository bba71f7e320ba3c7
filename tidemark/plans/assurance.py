"""Copies compared by checksum trees, lookups by part filters, packed series, SQL logs by tokens."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.functions import sqltext as S
from tidemark.operators import checksums as C
from tidemark.operators import packed as P
from tidemark.operators import partfilters as B
from tidemark.plans.frames import events
from tidemark.plans.registry import query, table
from tidemark.session import cut, fresh_path


@query(
    "tree_differences",
    """WITH b AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity = 50 AND l_discount = 0.1 THEN 51 ELSE l_quantity END AS l_quantity, l_shipdate FROM lineitem
    WHERE NOT (l_shipdate >= TIMESTAMP '1998-11-01' AND l_tax = 0)), a AS (SELECT l_orderkey, l_linenumber, l_quantity, l_shipdate FROM lineitem),
    d AS (SELECT *, 'first' AS only_in FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b) UNION ALL SELECT *, 'second' FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a))
    SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_quantity, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS l_shipdate, only_in FROM d""",
)
def tree_differences(spark, sf):
    """Line items against a copy that lost some rows and changed others."""
    a = table(spark, sf, "lineitem")
    late = (F.col("l_shipdate") >= datetime(1998, 11, 1)) & (F.col("l_tax") == 0)
    quantity = F.when((F.col("l_quantity") == 50) & (F.col("l_discount") == 0.1), 51.0).otherwise(F.col("l_quantity"))
    b = a.filter(~late).withColumn("l_quantity", quantity)
    names = ["l_orderkey", "l_linenumber", "l_quantity", "l_shipdate"]
    return C.tree_differences(a.select(names), b.select(names), ["l_orderkey"])


@query(
    "orders_by_filters",
    """WITH r AS (SELECT c_custkey, ROW_NUMBER() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS k FROM customer)
    SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_custkey IN (SELECT c_custkey FROM r WHERE k = 1)""",
)
def orders_by_filters(spark, sf):
    """Orders of each nation's richest customer, from monthly folders that filters of their customers prune."""
    path = fresh_path(spark, "orders-filtered")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    B.write_parts(orders, path, F.date_format("o_orderdate", "yyyy-MM"), "o_custkey")
    best = Window.partitionBy("c_nationkey").orderBy(F.desc("c_acctbal"), "c_custkey")
    asked = table(spark, sf, "customer").withColumn("k", F.row_number().over(best)).filter("k = 1")
    found = B.lookup(spark, path, asked.select(F.col("c_custkey").alias("o_custkey")), "o_custkey")
    return found.select("o_orderkey", "o_custkey", "o_totalprice")


def _blocks(spark, sf):
    return cut(P.packed(events(spark, sf), "event_type", "ts", "value"))


@query(
    "packed_points",
    """SELECT event_type, ts_text AS ts, value, COUNT(*) AS n FROM (SELECT event_type, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts_text, value FROM events
    WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-12') GROUP BY 1, 2, 3""",
)
def packed_points(spark, sf):
    """The points of two days, decoded from the packed blocks that touch them."""
    found = P.packed_range(_blocks(spark, sf), "event_type", datetime(2024, 1, 10), datetime(2024, 1, 12))
    return found.groupBy("event_type", F.date_trunc("second", "ts").alias("ts"), "value").agg(F.count("*").alias("n"))


@query(
    "packed_totals",
    """SELECT event_type, COUNT(*) AS points, MIN(value) AS least, MAX(value) AS most FROM events
    WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-25' GROUP BY 1""",
)
def packed_totals(spark, sf):
    """Counts and extremes of twenty days, mostly from the directory of the blocks."""
    return P.range_totals(_blocks(spark, sf), "event_type", datetime(2024, 1, 5), datetime(2024, 1, 25))


_NO_TABLE = S.NO_TABLE + ", ".join(S.COST_TABLES)


@query(
    "sql_log_tokens",
    f"""SELECT conv_id, turn,
    CAST(CASE (conv_id + turn) % 5 WHEN 3 THEN 2 ELSE 1 END AS BIGINT) AS statements,
    CASE (conv_id + turn) % 5 WHEN 0 THEN 'aws_costs' WHEN 1 THEN 'azure_costs' WHEN 2 THEN 'aws_costs, hidden_costs' WHEN 3 THEN '' ELSE 'azure_costs, gcp_costs' END AS tables,
    CASE (conv_id + turn) % 5 WHEN 2 THEN '{S.UNKNOWN_TABLE}hidden_costs'
    WHEN 3 THEN '{S.FORBIDDEN}DROP; {S.NOT_SELECT}; {S.CHAINED}; {_NO_TABLE}' ELSE '' END AS errors FROM conversations WHERE text IS NOT NULL""",
)
def sql_log_tokens(spark, sf):
    """Statements in which each logged text stands as a literal or comment, judged by their tokens."""
    quoted = F.concat(F.lit("'"), F.regexp_replace("text", "'", "''"), F.lit("'"))
    remark = F.concat(F.lit("/* "), F.regexp_replace("text", r"\*", ""), F.lit(" */"))
    form = F.pmod(F.col("conv_id") + F.col("turn"), F.lit(5))
    sql = (
        F.when(form == 0, F.concat(F.lit("SELECT "), quoted, F.lit(" AS said FROM aws_costs;")))
        .when(form == 1, F.concat(remark, F.lit(" SELECT extract(year FROM day) FROM azure_costs -- drop; delete\n")))
        .when(form == 2, F.concat(F.lit("select a.x, b.y from aws_costs a, hidden_costs b where a.said = "), quoted))
        .when(form == 3, F.concat(F.lit("DROP TABLE aws_costs; SELECT "), quoted))
        .otherwise(
            F.concat(
                F.lit('WITH t AS (SELECT * FROM gcp_costs WHERE said <> '), quoted,
                F.lit(') SELECT "update" FROM t JOIN (SELECT * FROM "azure_costs") z ON t.x IS DISTINCT FROM z.x'),
            )
        )
    )
    log = table(spark, sf, "conversations").filter("text IS NOT NULL").select("conv_id", "turn", sql.alias("sql"))
    found = S.tokens(F.col("sql"))
    return log.select(
        "conv_id", "turn", S.statements(found).alias("statements"),
        F.array_join(S.tables(found), ", ").alias("tables"), F.array_join(S.log_errors(F.col("sql")), "; ").alias("errors"),
    )
