"""The e-commerce job: clean, join, enrich, summarise, rank, write.

Works on any customer and order tables with the columns in the schemas below. The
enriched rows are computed once and persisted; each output is written once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import line_amount, order_size, year_month
from tidemark.operators.ranking import keep_latest, qualify
from tidemark.sources.files import read_csv, write_by_month, write_csv

CUSTOMERS = (
    T.StructType()
    .add("customer_id", "integer").add("name", "string").add("email", "string")
    .add("country", "string").add("signup_date", "date").add("status", "string")
)
ORDERS = (
    T.StructType()
    .add("order_id", "integer").add("customer_id", "integer").add("product_name", "string")
    .add("quantity", "integer").add("price", "double").add("order_date", "date").add("status", "string")
)


def clean_customers(raw: DataFrame) -> DataFrame:
    """Known email and country, no placeholder names, one row per customer."""
    kept = raw.filter(
        F.col("email").isNotNull() & F.col("country").isNotNull() & (F.col("name") != "Invalid User")
    )
    return keep_latest(kept, ["customer_id"], ["signup_date", "email"])


def price_orders(raw: DataFrame) -> DataFrame:
    known = raw.filter(F.col("order_id").isNotNull() & F.col("customer_id").isNotNull())
    return known.withColumn("total_amount", line_amount(F.col("quantity"), F.col("price")))


def enrich(customers: DataFrame, orders: DataFrame) -> DataFrame:
    people = customers.withColumnsRenamed({"status": "customer_status"})
    lines = orders.withColumnsRenamed({"status": "order_status"})
    return people.join(lines, "customer_id").withColumns(
        {
            "order_month": year_month("order_date"),
            "is_high_value": order_size(F.col("total_amount")),
            "days_since_signup": F.datediff("order_date", "signup_date"),
        }
    )


def _mean(total: str):
    return F.round(F.avg(total), 2).cast("decimal(10,2)")


def customer_summary(rows: DataFrame) -> DataFrame:
    return (
        rows.groupBy("customer_id", "name", "email", "country", "customer_status")
        .agg(
            F.count("*").alias("total_orders"),
            F.sum("total_amount").alias("total_spent"),
            _mean("total_amount").alias("avg_order_value"),
            F.count_if(F.col("order_status") == "completed").alias("completed_orders"),
        )
        .orderBy(F.desc("total_spent"), "customer_id")
    )


def product_summary(rows: DataFrame) -> DataFrame:
    return (
        rows.filter("order_status = 'completed'")
        .groupBy("product_name")
        .agg(
            F.count("*").alias("times_ordered"),
            F.sum("quantity").alias("total_quantity_sold"),
            F.sum("total_amount").alias("total_revenue"),
            _mean("total_amount").alias("avg_order_value"),
        )
        .orderBy(F.desc("total_revenue"), "product_name")
    )


def country_summary(rows: DataFrame) -> DataFrame:
    """Completed orders per country; customers are counted once."""
    per = (
        rows.filter("order_status = 'completed'")
        .groupBy("country", "customer_id")
        .agg(F.count("*").alias("n"), F.sum("total_amount").alias("spent"))
    )
    return (
        per.groupBy("country")
        .agg(
            F.count("*").alias("unique_customers"),
            F.sum("n").alias("total_orders"),
            F.sum("spent").alias("total_revenue"),
        )
        .withColumn(
            "avg_revenue_per_customer",
            F.round(F.col("total_revenue") / F.col("unique_customers"), 2).cast("decimal(12,2)"),
        )
        .orderBy(F.desc("total_revenue"), "country")
    )


def rankings(rows: DataFrame, best: int = 2) -> DataFrame:
    """The best customers of each country by completed spend."""
    spent = (
        rows.filter("order_status = 'completed'")
        .groupBy("country", "customer_id")
        .agg(F.sum("total_amount").alias("total_spent"))
    )
    w = Window.partitionBy("country").orderBy(F.desc("total_spent"), "customer_id")
    return qualify(spent, {"row_num": F.row_number().over(w)}, F.col("row_num") <= best)


def run(spark: SparkSession, customers_csv: str, orders_csv: str, out: str) -> DataFrame:
    """Read both CSVs, write every output below ``out``, return the enriched rows."""
    people = clean_customers(read_csv(spark, customers_csv, CUSTOMERS))
    rows = enrich(people, price_orders(read_csv(spark, orders_csv, ORDERS))).persist()
    write_csv(customer_summary(rows), f"{out}/customer_summary", single_file=True)
    write_csv(product_summary(rows), f"{out}/product_summary", single_file=True)
    write_csv(country_summary(rows), f"{out}/country_summary", single_file=True)
    write_csv(rows, f"{out}/enriched_orders_csv")
    write_by_month(rows.drop("order_month"), f"{out}/enriched_orders", "order_date", "order_month")
    return rows
