"""Data-quality checks over the given tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import quality as Q
from tidemark.operators.changes import retry, split_quality
from tidemark.plans.frames import events
from tidemark.plans.registry import query, table


@query(
    "dq_nulls",
    """SELECT 'quality' AS column_name, COUNT(*) - COUNT(quality) AS nulls, COUNT(*) AS checked FROM documents LEFT JOIN labels USING (doc_id)
    UNION ALL SELECT 'toxic', COUNT(*) - COUNT(toxic), COUNT(*) FROM documents LEFT JOIN labels USING (doc_id)""",
)
def dq_nulls(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id").join(table(spark, sf, "labels"), "doc_id", "left")
    return Q.null_report(docs, ["quality", "toxic"])


@query(
    "dq_counts",
    """SELECT COUNT(*) AS before, COUNT(*) FILTER (WHERE quality = 1) AS after, COUNT(*) FILTER (WHERE quality IS DISTINCT FROM 1) AS removed,
    (SELECT COUNT(*) FROM labels WHERE quality = 1) AS expected,
    COUNT(*) FILTER (WHERE quality = 1) = (SELECT COUNT(*) FROM labels WHERE quality = 1) AS as_expected
    FROM documents LEFT JOIN labels USING (doc_id)""",
)
def dq_counts(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id").join(table(spark, sf, "labels"), "doc_id", "left")
    good = table(spark, sf, "labels").filter("quality = 1").agg(F.count("*")).scalar()
    return Q.kept_and_removed(docs, F.col("quality") == 1, good)


@query(
    "dq_dups",
    "SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, COUNT(*) AS copies FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) > 1",
)
def dq_dups(spark, sf):
    return Q.duplicate_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "dq_schema_drift",
    """SELECT * FROM (VALUES ('o_comment', 'missing', 'string', NULL), ('o_orderpriority', 'added', NULL, 'string'),
    ('o_totalprice', 'type', 'decimal(12,2)', 'double')) AS t(column_name, drift, expected, actual) WHERE (SELECT COUNT(*) FROM orders) > 0""",
)
def dq_schema_drift(spark, sf):
    expected = (
        T.StructType()
        .add("o_orderkey", "long").add("o_custkey", "long").add("o_orderstatus", "string")
        .add("o_totalprice", T.DecimalType(12, 2)).add("o_orderdate", T.TimestampNTZType()).add("o_comment", "string")
    )
    return Q.schema_drift(spark, expected, table(spark, sf, "orders").schema)


@query(
    "dq_missing_days",
    """WITH d AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders WHERE o_totalprice > 450000),
    c AS (SELECT CAST(unnest(generate_series((SELECT MIN(day) FROM d), (SELECT MAX(day) FROM d), INTERVAL 1 DAY)) AS DATE) AS day)
    SELECT strftime(day, '%Y-%m-%d') AS day FROM c WHERE day NOT IN (SELECT day FROM d)""",
)
def dq_missing_days(spark, sf):
    """Calendar days without a very large order."""
    return Q.missing_days(table(spark, sf, "orders").filter("o_totalprice > 450000"), F.col("o_orderdate"))


def _line_rules():
    return {
        "quantity at most 45": F.col("l_quantity") <= 45,
        "discount at most 0.08": F.col("l_discount") <= 0.08,
        "flag known": F.col("l_returnflag").isin("A", "N"),
    }


@query(
    "dq_rules",
    """SELECT 'lineitem' AS subject, 'quantity at most 45' AS rule, COUNT(*) AS checked, COUNT(*) FILTER (WHERE NOT (l_quantity <= 45)) AS failures FROM lineitem
    UNION ALL SELECT 'lineitem', 'discount at most 0.08', COUNT(*), COUNT(*) FILTER (WHERE NOT (l_discount <= 0.08)) FROM lineitem
    UNION ALL SELECT 'lineitem', 'flag known', COUNT(*), COUNT(*) FILTER (WHERE l_returnflag NOT IN ('A', 'N')) FROM lineitem""",
)
def dq_rules(spark, sf):
    return Q.rule_report(table(spark, sf, "lineitem"), "lineitem", _line_rules())


@query(
    "dq_primary_key",
    """SELECT COUNT(*) AS row_count, COUNT(DISTINCT (l_orderkey, l_linenumber)) AS key_count,
    COUNT(*) - COUNT(DISTINCT (l_orderkey, l_linenumber)) AS surplus FROM lineitem""",
)
def dq_primary_key(spark, sf):
    return Q.key_uniqueness(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "dq_fk",
    """SELECT doc_id, COUNT(*) AS child_rows FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) GROUP BY 1""",
)
def dq_fk(spark, sf):
    """Documents without a label row."""
    return Q.missing_parents(table(spark, sf, "documents"), "doc_id", table(spark, sf, "labels"), "doc_id")


@query(
    "dq_same_copy",
    """SELECT 'first' AS copy, COUNT(*) AS row_count, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS sum_o_totalprice, true AS same FROM orders
    UNION ALL SELECT 'second', COUNT(*), CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE), true FROM orders""",
)
def dq_same_copy(spark, sf):
    """Counts, checksums and sums of a table and a reshuffled copy of it."""
    a = table(spark, sf, "orders")
    both = Q.fingerprint(a, "first", ["o_totalprice"]).unionByName(
        Q.fingerprint(a.repartition(5, "o_custkey"), "second", ["o_totalprice"])
    )
    same = both.agg((F.min("xor_hash") == F.max("xor_hash")) & (F.min("sum_hash") == F.max("sum_hash"))).first()[0]
    return both.select("copy", "row_count", "sum_o_totalprice", F.lit(same).alias("same"))


@query(
    "dq_different_rows",
    """SELECT o_orderkey, o_orderstatus, 'first' AS only_in FROM orders WHERE o_totalprice > 490000
    UNION ALL SELECT o_orderkey, 'X', 'second' FROM orders WHERE o_totalprice > 490000""",
)
def dq_different_rows(spark, sf):
    a = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    b = a.withColumn("o_orderstatus", F.when(F.col("o_totalprice") > 490000, "X").otherwise(F.col("o_orderstatus")))
    return Q.different_rows(a, b).drop("o_totalprice")


@query(
    "dq_freshness",
    """SELECT 'events' AS subject, strftime(MAX(ts), '%Y-%m-%d %H:%M:%S') AS newest,
    CAST(date_diff('second', date_trunc('second', MAX(ts)), TIMESTAMP '2024-02-01') AS DOUBLE) / 3600 > 24 AS stale FROM events""",
)
def dq_freshness(spark, sf):
    out = Q.freshness(events(spark, sf), "events", "ts", datetime(2024, 2, 1), 24)
    return out.select("subject", "newest", "stale")


@query(
    "dq_metric_jump",
    """WITH d AS (SELECT CAST(ts AS DATE) AS day, COUNT(*) AS n FROM events GROUP BY 1),
    t AS (SELECT day, n, CAST(SUM(n) OVER w AS DOUBLE) / COUNT(n) OVER w AS m FROM d
    WINDOW w AS (ORDER BY day RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING))
    SELECT strftime(day, '%Y-%m-%d') AS day, n FROM t WHERE abs(n - m) / m > 0.05""",
)
def dq_metric_jump(spark, sf):
    daily = events(spark, sf).groupBy(F.col("ts").cast("date").alias("day")).agg(F.count("*").alias("n"))
    return Q.metric_jumps(daily, "day", "n", 7, 0.05).select("day", "n")


@query(
    "dq_null_spikes",
    """WITH d AS (SELECT CAST(ts AS DATE) AS day, COUNT(*) FILTER (WHERE event_type = 'error') AS nulls, COUNT(*) AS checked FROM events GROUP BY 1),
    t AS (SELECT *, CAST(SUM(nulls) OVER w AS DOUBLE) / CAST(SUM(checked) OVER w AS DOUBLE) AS usual_rate, CAST(nulls AS DOUBLE) / checked AS null_rate FROM d
    WINDOW w AS (ORDER BY day RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING))
    SELECT strftime(day, '%Y-%m-%d') AS day, nulls, checked, usual_rate, null_rate FROM t WHERE null_rate - usual_rate > 0.01""",
)
def dq_null_spikes(spark, sf):
    """Days with more missing measures than the week before; an error has no measure."""
    measure = F.when(F.col("event_type") != "error", F.col("value"))
    return Q.null_spikes(events(spark, sf), F.col("ts").cast("date"), measure, 7, 0.01)


@query(
    "dq_daily",
    """WITH d AS (SELECT CAST(ts AS DATE) AS day, COUNT(*) AS checked, COUNT(*) FILTER (WHERE event_type = 'error') AS no_error,
    COUNT(*) FILTER (WHERE value < 1) AS has_value FROM events GROUP BY 1),
    s AS (SELECT *, 1 - CAST(no_error + has_value AS DOUBLE) / (checked * 2) AS score FROM d)
    SELECT strftime(day, '%Y-%m-%d') AS period, checked, no_error, has_value, score, score >= 0.9 AS meets_target FROM s""",
)
def dq_daily(spark, sf):
    """The quality of events over time: failures of two rules, score and target per day."""
    rules = {"no_error": F.col("event_type") != "error", "has_value": F.col("value") >= 1}
    return Q.scores_over_time(events(spark, sf), F.col("ts").cast("date"), rules, 0.9)


@query(
    "dq_report",
    """WITH r AS (SELECT 'lineitem' AS subject, COUNT(*) AS c, COUNT(*) FILTER (WHERE l_quantity > 45) AS f FROM lineitem
    UNION ALL SELECT 'lineitem', COUNT(*), COUNT(*) FILTER (WHERE l_discount > 0.08) FROM lineitem
    UNION ALL SELECT 'lineitem', COUNT(*), COUNT(*) FILTER (WHERE l_returnflag NOT IN ('A', 'N')) FROM lineitem
    UNION ALL SELECT 'orders', COUNT(*), COUNT(*) FILTER (WHERE o_totalprice <= 0) FROM orders)
    SELECT subject, COUNT(*) AS rules, CAST(SUM(c) AS BIGINT) AS checked, CAST(SUM(f) AS BIGINT) AS failures,
    CAST(SUM(c) - SUM(f) AS DOUBLE) / CAST(SUM(c) AS BIGINT) AS score,
    CAST(SUM(c) - SUM(f) AS DOUBLE) / CAST(SUM(c) AS BIGINT) >= 0.99 AS meets_target FROM r GROUP BY 1""",
)
def dq_report(spark, sf):
    report = Q.rule_report(table(spark, sf, "lineitem"), "lineitem", _line_rules()).unionByName(
        Q.rule_report(table(spark, sf, "orders"), "orders", {"price above zero": F.col("o_totalprice") > 0})
    )
    return Q.score(report)


@query(
    "dq_quarantine",
    """SELECT reasons, COUNT(*) AS n FROM (SELECT concat_ws(',', CASE WHEN event_type = 'error' THEN 'no error' END,
    CASE WHEN value < 1 THEN 'value' END) AS reasons FROM events) WHERE reasons <> '' GROUP BY 1""",
)
def dq_quarantine(spark, sf):
    """Bad rows with the rules they break."""
    _, bad = split_quality(
        events(spark, sf), {"no error": F.col("event_type") != "error", "value": F.col("value") >= 1}
    )
    return bad.groupBy(F.array_join("reasons", ",").alias("reasons")).agg(F.count("*").alias("n"))


@query(
    "dq_retry",
    """SELECT 'fixed' AS outcome, COUNT(*) AS n FROM events WHERE value < 1 AND event_type <> 'error'
    UNION ALL SELECT 'still bad', COUNT(*) FROM events WHERE event_type = 'error'""",
)
def dq_retry(spark, sf):
    """Quarantined values are repaired and tested again."""
    rules = {"no error": F.col("event_type") != "error", "value": F.col("value") >= 1}
    _, bad = split_quality(events(spark, sf), rules)
    good, still = retry(bad, lambda d: d.withColumn("value", F.greatest("value", F.lit(1.0))), rules)
    return good.agg(F.lit("fixed").alias("outcome"), F.count("*").alias("n")).unionByName(
        still.agg(F.lit("still bad").alias("outcome"), F.count("*").alias("n"))
    )
