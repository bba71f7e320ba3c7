"""Sorting, limits, set operations and deduplication."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from tidemark.functions.columns import year_month
from tidemark.operators import dedup as D
from tidemark.operators import ranking as R
from tidemark.operators.aggregates import salted_totals
from tidemark.plans.frames import COSTS, ORDERS, SALES, costs, orders, sales
from tidemark.plans.registry import query, table
from tidemark.session import fresh_path
from tidemark.sources.files import write_csv


@query(
    "top3_products",
    f"WITH {SALES} SELECT product, CAST(SUM(revenue) AS DOUBLE) AS revenue FROM sales GROUP BY 1 ORDER BY SUM(revenue) DESC, product LIMIT 3",
)
def top3_products(spark, sf):
    per = sales(spark, sf).groupBy("product").agg(F.sum("revenue").alias("revenue"))
    return R.top_n(per, [F.desc("revenue"), F.asc("product")], 3)


@query("clustered_layout")
def clustered_layout(spark, sf):
    """Rows distributed by customer and sorted inside tasks: each row with its task and place."""
    laid = table(spark, sf, "orders").repartition("o_custkey").sortWithinPartitions("o_custkey", "o_orderdate")
    place = F.monotonically_increasing_id()
    return laid.select("o_custkey", "o_orderdate", F.spark_partition_id().alias("task"), place.alias("place"))


@query(
    "skew_top",
    f"""WITH {ORDERS} SELECT customer_id, COUNT(*) AS purchases, CAST(SUM(amount) AS DOUBLE) AS total FROM ord
    WHERE order_date >= TIMESTAMP '1997-01-01' AND amount > 0 AND status IN ('completed', 'pending')
    GROUP BY 1 HAVING COUNT(*) > 5 ORDER BY SUM(amount) DESC, customer_id LIMIT 1000""",
)
def skew_top(spark, sf):
    """Pruned filter, two-phase aggregation, then the thousand largest."""
    rows = orders(spark, sf).filter(
        (F.col("order_date") >= F.lit(datetime(1997, 1, 1)))
        & (F.col("amount") > 0)
        & F.col("status").isin("completed", "pending")
    ).select("order_id", "customer_id", "amount")
    per = salted_totals(rows, "customer_id", "amount", salts=8).withColumnRenamed("n", "purchases")
    return per.filter("purchases > 5").orderBy(F.desc("total"), "customer_id").limit(1000)


@query(
    "single_file_report",
    "SELECT 1::BIGINT AS files, COUNT(DISTINCT strftime(o_orderdate, '%Y-%m')) AS lines FROM orders",
)
def single_file_report(spark, sf):
    """A small monthly report as one CSV file."""
    path = fresh_path(spark, "report")
    months = orders(spark, sf).groupBy(year_month("order_date").alias("month")).agg(F.sum("amount").alias("revenue"))
    write_csv(months.orderBy("month"), path, single_file=True)
    rows = spark.read.option("header", True).csv(path)
    return rows.agg(F.countDistinct(F.col("_metadata.file_path")).alias("files"), F.count("*").alias("lines"))


@query(
    "orders_of_customer",
    """SELECT o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS position,
    o_orderkey, o_totalprice, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders""",
)
def orders_of_customer(spark, sf):
    """Every owner's rows with chosen columns, newest first."""
    rows = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate")
    listed = R.newest_first(rows, "o_custkey", "o_orderdate", "o_orderkey")
    return listed.withColumn("day", F.col("o_orderdate").cast("date")).drop("o_orderdate")


@query(
    "union_all",
    """SELECT c_nationkey::BIGINT AS nation, COUNT(*) AS n FROM (SELECT c_nationkey FROM customer UNION ALL SELECT s_nationkey FROM supplier) GROUP BY 1""",
)
def union_all(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_nationkey").alias("nation"))
    s = table(spark, sf, "supplier").select(F.col("s_nationkey").alias("nation"))
    return c.unionByName(s).groupBy("nation").agg(F.count("*").alias("n"))


@query(
    "union_distinct",
    "SELECT o_custkey AS member FROM orders UNION SELECT user_id FROM events",
)
def union_distinct(spark, sf):
    """Each side is made distinct before they meet."""
    a = table(spark, sf, "orders").select(F.col("o_custkey").alias("member"))
    b = table(spark, sf, "events").select(F.col("user_id").alias("member"))
    return a.unionByName(b).distinct()


@query("distinct_pairs", "SELECT DISTINCT p_brand, p_type FROM part")
def distinct_pairs(spark, sf):
    return table(spark, sf, "part").select("p_brand", "p_type").distinct()


@query(
    "dedup_latest",
    """SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_partkey, strftime(l_shipdate, '%Y-%m-%d') AS shipped FROM
    (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC) AS k FROM lineitem)
    WHERE k = 1""",
)
def dedup_latest(spark, sf):
    """One line per order and line number: the last shipped; combined map-side."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    kept = R.keep_latest(lines, ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey", "l_suppkey"])
    return kept.select("l_orderkey", "l_linenumber", "l_partkey", F.col("l_shipdate").cast("date").alias("shipped"))


@query(
    "multi_cloud",
    f"""WITH {COSTS}, u AS (SELECT 'aws' AS provider, team, CAST(NULL AS VARCHAR) AS resource_group, cost FROM costs WHERE environment = 'production'
    UNION ALL SELECT 'azure', NULL, service, cost FROM costs WHERE environment = 'staging'
    UNION ALL SELECT 'gcp', team, NULL, cost FROM costs WHERE environment = 'development')
    SELECT provider, team, resource_group, CAST(SUM(cost) AS DOUBLE) AS total FROM u GROUP BY 1, 2, 3""",
)
def multi_cloud(spark, sf):
    """Providers with different columns, united by name."""
    c = costs(spark, sf)
    aws = c.filter("environment = 'production'").select(F.lit("aws").alias("provider"), "team", "cost")
    azure = c.filter("environment = 'staging'").select(
        F.lit("azure").alias("provider"), F.col("service").alias("resource_group"), "cost"
    )
    gcp = c.filter("environment = 'development'").select(F.lit("gcp").alias("provider"), "team", "cost")
    rows = aws.unionByName(azure, allowMissingColumns=True).unionByName(gcp, allowMissingColumns=True)
    return rows.groupBy("provider", "team", "resource_group").agg(F.sum("cost").alias("total"))


@query(
    "exact_dups",
    "SELECT MIN(doc_id) AS survivor, COUNT(*) AS copies FROM documents GROUP BY text HAVING COUNT(*) > 1",
)
def exact_dups(spark, sf):
    return D.exact_copies(table(spark, sf, "documents"), "doc_id", ["text"]).drop("fingerprint")


@query(
    "dedup_documents",
    "SELECT MIN(doc_id) AS doc_id FROM documents GROUP BY text",
)
def dedup_documents(spark, sf):
    return D.drop_exact_copies(table(spark, sf, "documents").select("doc_id", "text"), "doc_id", ["text"]).select("doc_id")


MATCH = """k AS (SELECT c_custkey AS record, 'nation+balance' AS rules, CAST(c_nationkey AS VARCHAR) || '|' || CAST(floor(c_acctbal / 10) AS BIGINT) AS sig FROM customer
    UNION ALL SELECT c_custkey, 'segment+balance', c_mktsegment || '|' || CAST(floor(c_acctbal / 10) AS BIGINT) FROM customer),
    l AS (SELECT rules, sig, MIN(record) AS leader FROM k GROUP BY 1, 2 HAVING COUNT(*) > 1),
    links AS (SELECT record, leader, rules FROM k JOIN l USING (rules, sig) WHERE record <> leader)"""


def _matches(spark, sf):
    people = table(spark, sf, "customer")
    rules = [
        D.Rule("nation", F.col("c_nationkey").cast("string"), 0.4),
        D.Rule("segment", F.col("c_mktsegment"), 0.4),
        D.Rule("balance", F.floor(F.col("c_acctbal") / 10).cast("string"), 0.5),
    ]
    return D.match_records(people, "c_custkey", rules, 0.9)


@query("record_matches", f"WITH {MATCH} SELECT record, leader, rules FROM links")
def record_matches(spark, sf):
    """Weighted user rules: nation or segment, together with the balance class."""
    return _matches(spark, sf)


@query(
    "record_clusters",
    f"""WITH RECURSIVE {MATCH}, e AS (SELECT record AS a, leader AS b FROM links UNION SELECT leader, record FROM links),
    reach AS (SELECT DISTINCT a, a AS b FROM e UNION SELECT reach.a, e.b FROM reach JOIN e ON reach.b = e.a)
    SELECT a AS node, MIN(b) AS cluster FROM reach GROUP BY 1""",
)
def record_clusters(spark, sf):
    return D.clusters(_matches(spark, sf), "record", "leader")


@query(
    "fuzzy_brands",
    """WITH RECURSIVE names AS (SELECT p_brand AS name, MIN(p_partkey) AS first FROM part GROUP BY 1),
    near AS (SELECT a.name AS a, b.name AS b FROM names a JOIN names b ON levenshtein(a.name, b.name) <= 1),
    reach AS (SELECT a, b FROM near UNION SELECT reach.a, near.b FROM reach JOIN near ON reach.b = near.a),
    least AS (SELECT reach.a AS name, MIN(first) AS leader FROM reach JOIN names ON reach.b = names.name GROUP BY 1)
    SELECT p_partkey AS record, leader FROM part JOIN least ON p_brand = name WHERE p_partkey <> leader""",
)
def fuzzy_brands(spark, sf):
    """Parts whose brand texts are chained by single edits, with the smallest part of the chain.

    Distinct texts are matched; parts follow their text.
    """
    parts = table(spark, sf, "part").select("p_partkey", "p_brand")
    names = parts.groupBy("p_brand").agg(F.min("p_partkey").alias("first"))
    links = D.match_records(names, "first", [D.Rule("brand", D.one_edit(F.col("p_brand")), 1.0)], 1.0)
    chains = D.clusters(links, "record", "leader").select(F.col("node").alias("first"), "cluster")
    leaders = names.join(chains, "first", "left").select("p_brand", F.coalesce("cluster", "first").alias("leader"))
    linked = parts.join(leaders, "p_brand").filter(F.col("p_partkey") != F.col("leader"))
    return linked.select(F.col("p_partkey").alias("record"), "leader")


@query("near_copies")
def near_copies(spark, sf):
    """Near copies of whole documents with their verified similarity."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    links = D.near_copies(docs, "doc_id", "text")
    return links.select("doc", "leader", F.round("similarity", 6).alias("similarity"))


@query(
    "near_copy_clusters",
    r"""WITH RECURSIVE t AS (SELECT text, MIN(doc_id) AS d, COUNT(*) AS copies FROM documents WHERE text IS NOT NULL GROUP BY 1),
    w AS (SELECT d, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM t),
    g AS (SELECT DISTINCT d, unnest([array_to_string(w[i : i + 2], ' ') FOR i IN range(1, greatest(len(w) - 2, 1) + 1)]) AS gram FROM w WHERE len(w) > 0),
    n AS (SELECT d, COUNT(*) AS n FROM g GROUP BY 1),
    shared AS (SELECT a.d AS a, b.d AS b, COUNT(*) AS k FROM g AS a JOIN g AS b ON a.gram = b.gram AND a.d <> b.d GROUP BY 1, 2),
    near AS (SELECT a, b FROM shared JOIN n AS x ON a = x.d JOIN n AS y ON b = y.d WHERE k / (x.n + y.n - k) >= 0.7),
    reach AS (SELECT d AS a, d AS b FROM t WHERE copies > 1 OR d IN (SELECT a FROM near)
        UNION SELECT reach.a, near.b FROM reach JOIN near ON reach.b = near.a),
    least AS (SELECT a AS d, MIN(b) AS cluster FROM reach GROUP BY 1)
    SELECT doc_id AS node, cluster FROM documents JOIN t USING (text) JOIN least USING (d)""",
)
def near_copy_clusters(spark, sf):
    """Documents with near copies: the components of similarity 0.7, and their smallest document."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return D.clusters(D.near_copies(docs, "doc_id", "text"), "doc", "leader")
