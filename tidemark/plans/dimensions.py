"""Dimensions, change data, layered and incremental loads."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from tidemark.functions.columns import money, year_month
from tidemark.operators import changes as X
from tidemark.operators import scd as S
from tidemark.operators.ordered import place, with_row_number
from tidemark.plans.frames import ORDERS, STAGED, events, orders, staged_customers
from tidemark.plans.joins import MONTHLY_PRIORITY, priority_dim
from tidemark.plans.registry import query, table
from tidemark.session import cut, fresh_path

KEY = ["c_custkey"]
LOAD = date(2024, 7, 1)


def _customer_dim(spark, sf):
    """Customers as a first snapshot, loaded half a year earlier."""
    return S.snapshot_scd2(
        None, table(spark, sf, "customer"), KEY, ["c_name", "c_acctbal", "c_mktsegment"], date(2024, 1, 1)
    )


def _staged(spark, sf):
    return staged_customers(spark, sf).select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")


@query(
    "scd1",
    f"""WITH {STAGED} SELECT c_custkey, c_acctbal FROM staged""",
)
def scd1(spark, sf):
    """Staged rows overwrite, new keys are added; all old keys are staged here."""
    return S.scd1(table(spark, sf, "customer"), staged_customers(spark, sf), KEY).select("c_custkey", "c_acctbal")


SCD2 = f"""{STAGED}, v AS (SELECT c.c_custkey, c.c_acctbal, '2024-01-01' AS effective_date,
    CASE WHEN s.c_acctbal IS DISTINCT FROM c.c_acctbal THEN '2024-07-01' END AS expiration_date,
    s.c_acctbal IS NOT DISTINCT FROM c.c_acctbal AS is_current FROM customer c JOIN staged s USING (c_custkey)
    UNION ALL SELECT s.c_custkey, s.c_acctbal, '2024-07-01', NULL, true FROM staged s LEFT JOIN customer c USING (c_custkey)
    WHERE c.c_custkey IS NULL OR s.c_acctbal IS DISTINCT FROM c.c_acctbal)"""


@query("scd2_changes", f"WITH {SCD2} SELECT * FROM v")
def scd2_changes(spark, sf):
    """One pass closes changed versions, opens new ones and adds new keys."""
    dim = S.scd2(_customer_dim(spark, sf), _staged(spark, sf), KEY, ["c_name", "c_acctbal", "c_mktsegment"], LOAD)
    return dim.select("c_custkey", "c_acctbal", "effective_date", "expiration_date", "is_current")


@query("scd2_rerun", f"WITH {SCD2} SELECT is_current, COUNT(*) AS n FROM v GROUP BY 1")
def scd2_rerun(spark, sf):
    """The same delivery twice on one day adds nothing."""
    tracked = ["c_name", "c_acctbal", "c_mktsegment"]
    once = S.scd2(_customer_dim(spark, sf), _staged(spark, sf), KEY, tracked, LOAD)
    again = S.snapshot_scd2(once, _staged(spark, sf), KEY, tracked, LOAD)
    return again.groupBy("is_current").agg(F.count("*").alias("n"))


@query(
    "scd3",
    f"""WITH {STAGED} SELECT c.c_custkey, COALESCE(s.c_acctbal, c.c_acctbal) AS c_acctbal,
    CASE WHEN s.c_acctbal IS DISTINCT FROM c.c_acctbal THEN c.c_acctbal END AS previous_c_acctbal
    FROM customer c LEFT JOIN staged s USING (c_custkey)""",
)
def scd3(spark, sf):
    out = S.scd3(table(spark, sf, "customer"), staged_customers(spark, sf), KEY, "c_acctbal")
    return out.select("c_custkey", "c_acctbal", "previous_c_acctbal")


@query("scd2_current", f"WITH {SCD2} SELECT c_custkey, c_acctbal FROM v WHERE expiration_date IS NULL")
def scd2_current(spark, sf):
    dim = S.scd2(_customer_dim(spark, sf), _staged(spark, sf), KEY, ["c_name", "c_acctbal", "c_mktsegment"], LOAD)
    return S.current_rows(dim).select("c_custkey", "c_acctbal")


@query(
    "version_history",
    f"""WITH {ORDERS}, {MONTHLY_PRIORITY} SELECT customer_id, row_number() OVER (PARTITION BY customer_id ORDER BY effective_date) AS version,
    strftime(effective_date, '%Y-%m-%d') AS effective_date, priority FROM dim""",
)
def version_history(spark, sf):
    """All versions of every key, numbered in order of validity."""
    ordered = place(priority_dim(spark, sf), ["customer_id"], ["effective_date"])
    return with_row_number(ordered, "version").df.select("customer_id", "version", "effective_date", "priority")


TIMELINE = f"""{ORDERS}, raw AS (SELECT customer_id, CAST(date_trunc('month', order_date) AS DATE) AS d,
    arg_max(priority, (order_date, order_id)) AS p, status FROM ord GROUP BY 1, 2, status),
    firsts AS (SELECT customer_id, d, COALESCE(MAX(p) FILTER (WHERE status = 'pending'), MAX(p) FILTER (WHERE status = 'completed')) AS p
    FROM raw WHERE status IN ('completed', 'pending') GROUP BY 1, 2),
    turns AS (SELECT *, lag(p) OVER (PARTITION BY customer_id ORDER BY d) AS q FROM firsts)"""


def _late_dim(spark, sf):
    o = orders(spark, sf)

    def monthly(status):
        return (
            o.filter(F.col("status") == status)
            .groupBy("customer_id", F.trunc("order_date", "month").alias("effective_date"))
            .agg(F.max_by("priority", F.struct("order_date", "order_id")).alias("priority"))
        )

    # The raw months, not collapsed versions, are the base the late rows join.
    return monthly("completed"), monthly("pending")


@query(
    "late_arrivals",
    f"""WITH {TIMELINE} SELECT customer_id, p AS priority, strftime(d, '%Y-%m-%d') AS effective_date,
    strftime(lead(d) OVER (PARTITION BY customer_id ORDER BY d), '%Y-%m-%d') AS expiration_date FROM turns WHERE p IS DISTINCT FROM q""",
)
def late_arrivals(spark, sf):
    """Rows that arrive late by business date shift the versions around them."""
    base, late = _late_dim(spark, sf)
    out = S.rebuild_timeline(base, late, ["customer_id"], ["priority"], mode="window")
    return out.select("customer_id", "priority", "effective_date", "expiration_date")


@query("upsert", f"WITH {STAGED} SELECT c_custkey, c_name, c_acctbal FROM staged")
def upsert(spark, sf):
    return X.upsert(table(spark, sf, "customer"), staged_customers(spark, sf), KEY).select("c_custkey", "c_name", "c_acctbal")


@query(
    "update_where",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' AND o_orderdate < TIMESTAMP '1997-01-01' THEN 'X' ELSE o_orderstatus END AS o_orderstatus FROM orders""",
)
def update_where(spark, sf):
    old = (F.col("o_orderstatus") == "P") & (F.col("o_orderdate") < F.lit(datetime(1997, 1, 1)))
    return X.update_where(table(spark, sf, "orders"), old, o_orderstatus=F.lit("X")).select("o_orderkey", "o_orderstatus")


@query("delete_where", "SELECT o_orderkey FROM orders WHERE NOT (o_orderdate < TIMESTAMP '1997-01-01')")
def delete_where(spark, sf):
    old = F.col("o_orderdate") < F.lit(datetime(1997, 1, 1))
    return X.delete_where(table(spark, sf, "orders"), old).select("o_orderkey")


AFTER = f"""{STAGED}, after AS (SELECT c_custkey, c_acctbal FROM staged WHERE c_mktsegment <> 'FURNITURE')"""


@query(
    "change_feed",
    f"""WITH {AFTER}, j AS (SELECT COALESCE(o.c_custkey, n.c_custkey) AS c_custkey, o.c_custkey AS oid, n.c_custkey AS nid,
    o.c_acctbal AS ob, n.c_acctbal AS nb FROM (SELECT c_custkey, c_acctbal FROM customer) o FULL JOIN after n ON o.c_custkey = n.c_custkey)
    SELECT c_custkey, nb AS c_acctbal, 'INSERT' AS _action, false AS _is_update FROM j WHERE oid IS NULL
    UNION ALL SELECT c_custkey, ob, 'DELETE', false FROM j WHERE nid IS NULL
    UNION ALL SELECT c_custkey, ob, 'DELETE', true FROM j WHERE oid IS NOT NULL AND nid IS NOT NULL AND ob IS DISTINCT FROM nb
    UNION ALL SELECT c_custkey, nb, 'INSERT', true FROM j WHERE oid IS NOT NULL AND nid IS NOT NULL AND ob IS DISTINCT FROM nb""",
)
def change_feed(spark, sf):
    before = table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    after = staged_customers(spark, sf).filter("c_mktsegment <> 'FURNITURE'").select("c_custkey", "c_acctbal")
    return X.change_feed(before, after, KEY)


LAST_EVENT = """last AS (SELECT user_id, arg_max(event_type, (ts, event_id)) AS event_type, arg_max(value, (ts, event_id)) AS value
    FROM events GROUP BY 1)"""


@query(
    "apply_changes",
    f"""WITH {LAST_EVENT} SELECT c_custkey AS user_id, c_acctbal AS value FROM customer
    WHERE c_custkey NOT IN (SELECT user_id FROM last) UNION ALL SELECT user_id, value FROM last WHERE event_type <> 'error'""",
)
def apply_changes(spark, sf):
    """Events as a change log on balances: the last change wins, errors delete."""
    target = table(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"), F.col("c_acctbal").alias("value"))
    action = F.when(F.col("event_type") == "error", "DELETE").otherwise("UPDATE")
    log = events(spark, sf).select("user_id", "value", action.alias("action"), F.struct("ts", "event_id").alias("seq"))
    return X.apply_changes(target, log, ["user_id"], "seq", "action")


@query(
    "gold_daily",
    """SELECT strftime(ts, '%Y-%m-%d') AS day, c_mktsegment AS segment, COUNT(*) AS n,
    CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total FROM events JOIN customer ON user_id = c_custkey
    WHERE event_type <> 'error' AND value >= 1 GROUP BY 1, 2""",
)
def gold_daily(spark, sf):
    """Bronze rows, silver after the checks, gold per day and segment."""
    silver, _ = X.split_quality(
        events(spark, sf), {"no error": F.col("event_type") != "error", "value": F.col("value") >= 1}
    )
    daily = silver.groupBy(F.col("ts").cast("date").alias("day"), "user_id").agg(
        F.count("*").alias("n"), F.sum(money("value")).alias("total")
    )
    people = table(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("segment"))
    return daily.join(people, "user_id").groupBy("day", "segment").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))


DAILY = """SELECT strftime(ts, '%Y-%m-%d') AS day, COUNT(*) AS n, CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total
    FROM events GROUP BY 1"""


def _daily(rows):
    return rows.groupBy(F.date_format("ts", "yyyy-MM-dd").alias("day")).agg(
        F.count("*").alias("n"), F.sum(money("value")).alias("total")
    )


def _stored(spark, path):
    return spark.read.schema("day string, n long, total decimal(28,2)").parquet(path)


@query("incremental_daily", DAILY)
def incremental_daily(spark, sf):
    """A first load, then only days after the high-water mark less a look-back."""
    path = fresh_path(spark, "daily")
    all_rows = events(spark, sf)
    cutoff = datetime(2024, 1, 18)
    X.refresh_partitions(_daily(all_rows.filter(F.col("ts") < F.lit(cutoff))), path, "day")
    mark = _stored(spark, path).agg(F.max("day")).first()[0]
    recent = X.new_rows(all_rows, "ts", datetime.fromisoformat(mark), "7 DAYS")
    # The look-back starts at midnight, so every rewritten day is complete.
    X.refresh_partitions(_daily(recent), path, "day")
    return _stored(spark, path)


@query("backfill_days", DAILY)
def backfill_days(spark, sf):
    """A defect in some stored days is repaired by recomputing only these."""
    path = fresh_path(spark, "daily")
    rows = events(spark, sf)
    broken = F.col("ts").between(F.lit(datetime(2024, 1, 5)), F.lit(datetime(2024, 1, 8)))
    X.refresh_partitions(_daily(rows.withColumn("value", F.when(broken, -1.0).otherwise(F.col("value")))), path, "day")
    redo = rows.filter((F.col("ts") >= F.lit(datetime(2024, 1, 5))) & (F.col("ts") < F.lit(datetime(2024, 1, 9))))
    X.refresh_partitions(_daily(redo), path, "day")
    return _stored(spark, path)


@query(
    "surrogate_keys",
    """SELECT c_custkey, 100 + row_number() OVER (ORDER BY c_custkey) AS customer_key FROM customer""",
)
def surrogate_keys(spark, sf):
    people = table(spark, sf, "customer").select("c_custkey")
    return S.dense_keys(people, ["c_custkey"], "customer_key", after=100, mode="chunked")


@query(
    "kept_aggregate",
    f"""WITH {ORDERS} SELECT strftime(order_date, '%Y-%m') AS month, CAST(SUM(amount) AS DOUBLE) AS revenue, COUNT(*) AS n FROM ord GROUP BY 1""",
)
def kept_aggregate(spark, sf):
    """A pre-computed aggregate to which the partials of new rows are added."""
    o = orders(spark, sf)
    late = F.col("order_date") >= F.lit(datetime(2000, 1, 15))

    def partial(rows):
        return rows.groupBy(year_month("order_date").alias("month")).agg(
            F.sum("amount").alias("revenue"), F.count("*").alias("n")
        )

    kept = cut(partial(o.filter(~late)))
    return X.merge_partials(kept, partial(o.filter(late)), ["month"], ["revenue", "n"])


@query(
    "rebuilt_with_default",
    "SELECT c_custkey, 'USD' AS currency, CAST(NULL AS BIGINT) AS referrer FROM customer",
)
def rebuilt_with_default(spark, sf):
    rows = table(spark, sf, "customer").select("c_custkey")
    return X.add_column(X.add_column(rows, "currency", "string", "USD"), "referrer", "bigint")


@query(
    "salary_history",
    """WITH y AS (SELECT o_custkey AS employee, year(o_orderdate) AS y, CAST(MAX(o_totalprice) AS DECIMAL(18,2)) AS salary FROM orders GROUP BY 1, 2),
    t AS (SELECT *, lag(salary) OVER (PARTITION BY employee ORDER BY y) AS p FROM y)
    SELECT employee, CAST(salary AS DOUBLE) AS salary, CAST(y AS VARCHAR) || '-01-01' AS effective_date,
    CAST(lead(y) OVER (PARTITION BY employee ORDER BY y) AS VARCHAR) || '-01-01' AS expiration_date FROM t WHERE salary IS DISTINCT FROM p""",
)
def salary_history(spark, sf):
    """Yearly salaries (largest order as stand-in) as a versioned dimension."""
    yearly = (
        orders(spark, sf)
        .groupBy(F.col("customer_id").alias("employee"), F.trunc("order_date", "year").alias("effective_date"))
        .agg(F.max("amount").alias("salary"))
    )
    out = S.rebuild_timeline(yearly, yearly.limit(0), ["employee"], ["salary"], mode="window")
    return out.select("employee", "salary", "effective_date", "expiration_date")


@query(
    "timeline_check",
    "SELECT 0::BIGINT AS faulty_keys, COUNT(DISTINCT o_custkey) AS checked_keys FROM orders",
)
def timeline_check(spark, sf):
    """No overlaps, no gaps, one current row in the rebuilt dimension."""
    dim = priority_dim(spark, sf)
    faults = S.timeline_faults(dim, ["customer_id"], mode="window").select("customer_id", F.lit(1).alias("bad"))
    keys = dim.select("customer_id").distinct().join(faults, "customer_id", "left")
    return keys.agg(F.count("bad").alias("faulty_keys"), F.count("*").alias("checked_keys"))
