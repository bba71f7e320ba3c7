"""Data-quality checks. Each returns rows (check, subject, failures) or details."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.aggregates import trailing_mean


def null_report(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULLs per critical column, as rows, in one pass."""
    counts = df.agg(
        F.count("*").alias("_n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns]
    )
    rows = [
        F.struct(F.lit(c).alias("column_name"), F.col(c).alias("nulls"), F.col("_n").alias("checked"))
        for c in columns
    ]
    return counts.select(F.inline(F.array(*rows)))


def kept_and_removed(df: DataFrame, keep: Column, expected: Column | None = None) -> DataFrame:
    """Row counts before and after a cleaning rule, in one pass.

    With ``expected`` (a number or a scalar subquery) also whether so many rows are left.
    """
    ok = F.coalesce(keep, F.lit(False))
    counts = df.agg(
        F.count("*").alias("before"),
        F.count_if(ok).alias("after"),
        F.count_if(~ok).alias("removed"),
    )
    if expected is None:
        return counts
    return counts.withColumn("expected", expected).withColumn("as_expected", F.col("after") == F.col("expected"))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).filter("copies > 1")


def key_uniqueness(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows, distinct keys, and rows too many. Combined by key before any shuffle."""
    per_key = df.groupBy(*keys).agg(F.count("*").alias("n"))
    return per_key.agg(
        F.sum("n").alias("row_count"),
        F.count("*").alias("key_count"),
        (F.sum("n") - F.count("*")).alias("surplus"),
    )


def schema_drift(spark: SparkSession, expected: T.StructType, actual: T.StructType) -> DataFrame:
    """Columns added, missing, or of another type."""
    want = {f.name: f.dataType.simpleString() for f in expected.fields}
    have = {f.name: f.dataType.simpleString() for f in actual.fields}
    rows = [(c, "missing", want[c], None) for c in want if c not in have]
    rows += [(c, "added", None, have[c]) for c in have if c not in want]
    rows += [(c, "type", want[c], have[c]) for c in want if c in have and want[c] != have[c]]
    return spark.createDataFrame(
        rows, "column_name string, drift string, expected string, actual string"
    )


def missing_days(df: DataFrame, day: Column) -> DataFrame:
    """Calendar days between the first and the last day that have no rows."""
    seen = df.select(day.cast("date").alias("day")).distinct()
    span = seen.agg(F.min("day").alias("lo"), F.max("day").alias("hi"))
    calendar = span.filter("lo IS NOT NULL").select(F.explode(F.sequence("lo", "hi")).alias("day"))
    return calendar.join(seen, "day", "left_anti")


def rule_report(df: DataFrame, subject: str, rules: dict[str, Column]) -> DataFrame:
    """Failures per rule in one pass; a rule that is NULL fails."""
    counts = df.agg(
        F.count("*").alias("_n"),
        *[
            F.count_if(~F.coalesce(rule, F.lit(False))).alias(f"r{i}")
            for i, rule in enumerate(rules.values())
        ],
    )
    rows = [
        F.struct(
            F.lit(subject).alias("subject"),
            F.lit(name).alias("rule"),
            F.col("_n").alias("checked"),
            F.col(f"r{i}").alias("failures"),
        )
        for i, name in enumerate(rules)
    ]
    return counts.select(F.inline(F.array(*rows)))


def missing_parents(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Foreign-key values without a parent, with their row counts.

    The child is reduced to one row per key first, so a hot key costs one row in
    the join.
    """
    per_key = child.filter(F.col(fk).isNotNull()).groupBy(fk).agg(F.count("*").alias("child_rows"))
    return per_key.join(parent.select(F.col(pk).alias(fk)), fk, "left_anti")


def fingerprint(df: DataFrame, name: str, amounts: Sequence[str] = ()) -> DataFrame:
    """Row count, order-free checksum and sums of a table, for comparing two copies."""
    return df.agg(
        F.lit(name).alias("copy"),
        F.count("*").alias("row_count"),
        F.bit_xor(F.xxhash64(*df.columns)).alias("xor_hash"),
        F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)")).cast("string").alias("sum_hash"),
        *[F.sum(F.col(c).cast("decimal(18,2)")).alias(f"sum_{c}") for c in amounts],
    )


def different_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows in one copy only, with multiplicity."""
    return (
        a.exceptAll(b).withColumn("only_in", F.lit("first"))
        .unionByName(b.exceptAll(a).withColumn("only_in", F.lit("second")))
    )


def freshness(df: DataFrame, subject: str, ts: str, as_of: datetime, limit_hours: float) -> DataFrame:
    # Counted in microseconds: whole seconds would lose the part by which a limit is passed.
    lag = F.timestamp_diff("MICROSECOND", F.max(ts), F.lit(as_of)) / F.lit(3600.0e6)
    return df.agg(
        F.lit(subject).alias("subject"),
        F.max(ts).alias("newest"),
        lag.alias("lag_hours"),
        (lag > limit_hours).alias("stale"),
    )


def metric_jumps(per_day: DataFrame, day: str, value: str, days: int, limit: float) -> DataFrame:
    """Days whose metric is off the mean of the preceding days by more than ``limit``.

    Input: one row per day.
    """
    marked = trailing_mean(per_day, [], day, value, days)
    v = F.col(value).cast("double")
    off = F.try_divide(F.abs(v - F.col("trailing_avg")), F.col("trailing_avg"))
    return marked.withColumn("deviation", off).filter(F.col("deviation") > limit)


def null_spikes(df: DataFrame, day: Column, value: Column, days: int, limit: float) -> DataFrame:
    """Days whose NULL share is above that of the preceding ``days`` by more than ``limit``.

    Rows are counted by day first; the window sees one row per day. A day without any
    history is no spike.
    """
    per_day = df.groupBy(day.alias("day")).agg(F.count_if(value.isNull()).alias("nulls"), F.count("*").alias("checked"))
    before = Window.orderBy(F.unix_date("day")).rangeBetween(-days, -1)
    usual = F.try_divide(F.sum("nulls").over(before).cast("double"), F.sum("checked").over(before).cast("double"))
    marked = per_day.withColumn("usual_rate", usual).withColumn("null_rate", F.col("nulls").cast("double") / F.col("checked"))
    return marked.filter(F.col("null_rate") - F.col("usual_rate") > limit)


def scores_over_time(df: DataFrame, period: Column, rules: dict[str, Column], target: float = 0.99) -> DataFrame:
    """Quality score per period: failures of each rule, score over all rules, and its SLA."""
    failed = {name: F.count_if(~F.coalesce(rule, F.lit(False))).alias(name) for name, rule in rules.items()}
    counts = df.groupBy(period.alias("period")).agg(F.count("*").alias("checked"), *failed.values())
    wrong = sum((F.col(f"`{name}`") for name in rules), F.lit(0))
    passed = 1 - wrong.cast("double") / (F.col("checked") * len(rules))
    return counts.withColumn("score", passed).withColumn("meets_target", F.col("score") >= target)


def score(report: DataFrame, target: float = 0.99) -> DataFrame:
    """Quality score per table: share of passed checks over all rules, and its SLA."""
    totals = report.groupBy("subject").agg(
        F.count("*").alias("rules"),
        F.sum("checked").alias("checked"),
        F.sum("failures").alias("failures"),
    )
    passed = (F.col("checked") - F.col("failures")).cast("double")
    return totals.withColumn("score", passed / F.col("checked")).withColumn(
        "meets_target", F.col("score") >= target
    )
