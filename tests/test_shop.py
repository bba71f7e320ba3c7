from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import fixtures as X
from tidemark.functions import columns as C
from tidemark.operators.aggregates import with_group_totals
from tidemark.plans import shop
from tidemark.sources import files


@pytest.fixture(scope="module")
def paths(tmp_path_factory):
    root = tmp_path_factory.mktemp("shop")
    (root / "customers.csv").write_text(X.ECOMMERCE_CUSTOMERS)
    (root / "orders.csv").write_text(X.ECOMMERCE_ORDERS)
    return root


@pytest.fixture(scope="module")
def rows(spark, paths):
    return shop.run(spark, f"{paths}/customers.csv", f"{paths}/orders.csv", f"{paths}/out")


def test_counts(spark, paths, rows):
    raw = files.read_csv(spark, f"{paths}/customers.csv", shop.CUSTOMERS)
    assert raw.count() == 12 and shop.clean_customers(raw).count() == 10
    assert rows.count() == 16


def test_customer_summary(rows):
    got = [(r.customer_id, r.total_orders, str(r.total_spent), str(r.avg_order_value), r.completed_orders) for r in shop.customer_summary(rows).collect()]
    assert got == [
        (8, 2, "2299.97", "1149.99", 2), (4, 2, "1599.97", "799.99", 2), (1, 3, "1209.88", "403.29", 3),
        (6, 2, "1064.94", "532.47", 1), (3, 1, "299.99", "299.99", 0), (2, 2, "140.99", "70.50", 1),
        (5, 1, "135.00", "135.00", 1), (9, 1, "79.99", "79.99", 1), (10, 1, "45.00", "45.00", 1),
        (7, 1, "31.98", "31.98", 1),
    ]


def test_product_summary(rows):
    got = [(r.product_name, r.times_ordered, r.total_quantity_sold, str(r.total_revenue), str(r.avg_order_value)) for r in shop.product_summary(rows).collect()]
    assert got == [
        ("Laptop", 3, 4, "3999.96", "1333.32"), ("Monitor", 2, 3, "899.97", "449.99"),
        ("USB Cable", 2, 15, "194.85", "97.43"), ("Headphones", 2, 4, "180.00", "90.00"),
        ("Keyboard", 2, 2, "159.98", "79.99"), ("Mouse", 1, 2, "51.00", "51.00"), ("Mouse Pad", 1, 2, "31.98", "31.98"),
    ]


def test_country_summary_counts_customers_once(rows):
    got = {r.country: (r.unique_customers, r.total_orders, str(r.total_revenue), str(r.avg_revenue_per_customer)) for r in shop.country_summary(rows).collect()}
    assert got["USA"] == (2, 5, "2809.85", "1404.93")
    assert got["Japan"] == (1, 2, "2299.97", "2299.97")
    assert got["Egypt"] == (1, 1, "135.00", "135.00") and len(got) == 8


def test_rankings(rows):
    got = {(r.country, r.row_num): (r.customer_id, str(r.total_spent)) for r in shop.rankings(rows).collect()}
    assert got[("USA", 1)] == (4, "1599.97") and got[("USA", 2)] == (1, "1209.88") and len(got) == 9


def test_enriched_values(rows):
    got = {r.order_id: (str(r.total_amount), r.order_month, r.is_high_value, r.days_since_signup) for r in rows.collect()}
    assert got[1014] == ("129.90", "2024-03", "Medium", 73)
    assert got[1012] == ("599.98", "2024-03", "High", 21)
    assert got[1017] == ("999.99", "2024-04", "High", 67)


def test_band_counts(rows):
    per = rows.groupBy("customer_id").agg(F.sum("total_amount").alias("v"))
    got = {r.band: r["count"] for r in per.groupBy(C.value_band(F.col("v")).alias("band")).count().collect()}
    assert got == {"VIP": 1, "Regular": 3, "New": 6}


def test_written_outputs(spark, paths, rows):
    import os

    parts = [f for f in os.listdir(f"{paths}/out/customer_summary") if f.endswith(".csv")]
    assert len(parts) == 1
    back = spark.read.parquet(f"{paths}/out/enriched_orders")
    assert back.count() == 16
    pruned = files.read_since(spark, f"{paths}/out/enriched_orders", "order_date", "order_month", date(2024, 4, 1))
    assert pruned.count() == 2
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(order_month" in plan


def test_bulk_load_continues(spark, tmp_path):
    (tmp_path / "bad.csv").write_text("customer_id,name,email,country,signup_date,status\n1,A,a@b,US,2024-01-01,x\nnot a number,B,b@b,US,2024-01-01,x\n")
    good, bad = files.load_csv(spark, str(tmp_path / "bad.csv"), shop.CUSTOMERS)
    assert good.count() == 1
    assert bad.select(files.CORRUPT).first()[0].startswith("not a number")


def test_infer_and_profile(spark, paths):
    df = files.infer_csv(spark, f"{paths}/orders.csv")
    assert dict(df.dtypes)["quantity"] == "int"
    raw = files.read_csv(spark, f"{paths}/customers.csv", shop.CUSTOMERS)
    assert files.null_counts(raw).first().email == 1
    for exact in (False, True):
        card = {r.column_name: r for r in files.profile(raw, exact=exact).collect()}
        assert card["country"].nulls == 1 and card["customer_id"].distinct_values == 12


def test_spend(spark):
    o = spark.createDataFrame(X.SPEND_ORDERS, "order_id int, customer_id int, order_date date, order_amount int, product_category string")
    per = o.groupBy("customer_id").agg(F.sum("order_amount").alias("t"), F.datediff(F.lit(date(2026, 1, 5)), F.min("order_date")).alias("d"))
    assert sorted(map(tuple, per.collect())) == [(101, 550, 360), (102, 180, 324), (103, 70, 322), (104, 120, 299)]
    cats = {r.product_category: r.t for r in o.groupBy("product_category").agg(F.sum("order_amount").alias("t")).collect()}
    assert cats == {"Electronics": 550, "Fashion": 180, "Health": 120, "Groceries": 70}
    rows = with_group_totals(o, ["customer_id"], total=F.sum("order_amount"))
    assert rows.count() == 5 and rows.filter("customer_id = 101 and total = 550").count() == 2


def test_sales_lines(spark):
    s = spark.createDataFrame(X.SALES, "order_id int, order_date string, product_id string, category string, quantity int, unit_price double, customer_id string, country string")
    s = s.withColumn("revenue", C.line_amount(F.col("quantity"), F.col("unit_price")))
    assert [str(r.revenue) for r in s.orderBy("order_id").collect()] == ["1499.95", "99.98", "299.99", "47.97", "49.99", "1599.98"]
    assert [r.order_id for r in s.filter("revenue > 500").orderBy("order_id").collect()] == [1, 6]
    seg = s.groupBy("customer_id").agg(F.sum("revenue").alias("t"))
    got = {r.customer_id: (r.t, r.s) for r in seg.select("customer_id", "t", C.spend_segment(F.col("t")).alias("s")).collect()}
    assert got["CUST001"] == (Decimal("1547.92"), "Premium") and got["CUST003"] == (Decimal("299.99"), "Basic")
    top = s.groupBy("product_id").agg(F.sum("revenue").alias("t")).orderBy(F.desc("t")).limit(3).collect()
    assert [(r.product_id, str(r.t)) for r in top] == [("PROD001", "1799.94"), ("PROD004", "1599.98"), ("PROD002", "149.97")]
