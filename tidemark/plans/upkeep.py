"""Open intervals, aggregates kept by signed deltas, sketches merged over time."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import deltas as D
from tidemark.operators import intervals as I
from tidemark.operators import sketches as K
from tidemark.plans.frames import events
from tidemark.plans.registry import query, table
from tidemark.session import cut


@query(
    "open_orders",
    """WITH s AS (SELECT o_orderpriority AS priority, CAST(o_orderdate AS DATE) AS a, CAST(MAX(l_shipdate) AS DATE) AS b, CAST(ROUND(o_totalprice * 100) AS BIGINT) AS cents
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderkey, o_orderpriority, o_orderdate, o_totalprice),
    d AS (SELECT DISTINCT o_orderpriority AS priority, CAST(o_orderdate AS DATE) AS day FROM orders)
    SELECT d.priority, strftime(day, '%Y-%m-%d') AS day, COUNT(a) AS n_open, CAST(SUM(cents) AS BIGINT) AS open_sum
    FROM d LEFT JOIN s ON s.priority = d.priority AND a <= day AND day < b GROUP BY 1, 2""",
)
def open_orders(spark, sf):
    """Orders of each priority that are placed but not wholly shipped, on every day with orders."""
    orders = table(spark, sf, "orders")
    shipped = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.max("l_shipdate").alias("last"))
    spans = orders.join(shipped, "o_orderkey").select(
        F.col("o_orderpriority").alias("priority"), F.col("o_orderdate").cast("date").alias("placed"),
        F.col("last").cast("date").alias("shipped"), F.round(F.col("o_totalprice") * 100).cast("long").alias("cents"),
    )
    days = orders.select(F.col("o_orderpriority").alias("priority"), F.col("o_orderdate").cast("date").alias("day")).distinct()
    return I.open_at(days, spans, ["priority"], "day", "placed", "shipped", "cents")


@query(
    "kept_by_deltas",
    """WITH o AS (SELECT CASE WHEN o_orderkey % 5 = 0 THEN '5-LOW' ELSE o_orderpriority END AS priority,
    CAST(ROUND(o_totalprice * 100) AS BIGINT) * CASE WHEN o_orderkey % 5 = 0 THEN 2 ELSE 1 END // 100000 AS price FROM orders WHERE o_orderkey % 7 <> 0)
    SELECT priority, COUNT(*) AS n, CAST(SUM(price) AS BIGINT) AS total, COUNT(DISTINCT price) AS distinct_values, MIN(price) AS least, MAX(price) AS most FROM o GROUP BY 1""",
)
def kept_by_deltas(spark, sf):
    """Counts, sums, distinct counts and extremes after updates and deletes, without the rows."""
    cents = F.round(F.col("o_totalprice") * 100).cast("long")
    kept = D.KeptAggregate(spark, ["priority"], "price", buckets=8)
    old = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderpriority").alias("old_priority"), cents.alias("cents"))
    old = old.withColumn("old_price", F.expr("cents DIV 100000"))
    kept.load(old.select(F.col("old_priority").alias("priority"), F.col("old_price").alias("price")))
    gone, moved = F.col("o_orderkey") % 7 == 0, F.col("o_orderkey") % 5 == 0
    changes = old.filter(gone | moved).select(
        "old_priority", "old_price", F.lit("5-LOW").alias("priority"), F.expr("cents * 2 DIV 100000").alias("price"),
        F.when(gone, "DELETE").otherwise("UPDATE").alias("action"),
    )
    kept.apply(D.change_deltas(changes, ["priority", "price"]))
    return kept.result()


@query(
    "quantiles_by_day",
    """SELECT strftime(ts, '%Y-%m-%d') AS day, COUNT(value) AS n, MIN(value) AS least, MAX(value) AS most FROM events GROUP BY 1""",
)
def quantiles_by_day(spark, sf):
    """Hourly quantile sketches merged to days; the ends of a sketch are exact."""
    hours = cut(K.quantile_sketches(events(spark, sf), [F.date_trunc("hour", "ts").alias("hour")], "value"))
    days = K.merged_sketches(hours, [F.col("hour").cast("date").alias("day")])
    return K.quantiles(days, {"least": 0.0, "most": 1.0})


@query(
    "hitters_by_day",
    """SELECT strftime(ts, '%Y-%m-%d') AS day, event_type AS item, COUNT(*) AS n FROM events GROUP BY 1, 2""",
)
def hitters_by_day(spark, sf):
    """Hourly counters of event types merged to days; exact while the counters suffice."""
    hours = cut(K.hitter_sketches(events(spark, sf), [F.date_trunc("hour", "ts").alias("hour")], "event_type"))
    days = K.merged_hitters(hours, [F.col("hour").cast("date").alias("day")])
    return K.heavy_hitters(days, 100)
