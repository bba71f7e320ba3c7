"""Cost and operations analytics over a table cost(date, team, service, environment, cost)."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import banded, ratio
from tidemark.operators.aggregates import growth, trailing_mean
from tidemark.operators.ordered import place


def spend_by(costs: DataFrame, keys: Sequence[str], condition: Column | None = None) -> DataFrame:
    rows = costs if condition is None else costs.filter(condition)
    return rows.groupBy(*keys).agg(
        F.sum("cost").alias("total_cost"), F.count("*").alias("entries")
    )


def spend_matrix(costs: DataFrame, key: str, column: str, values: Sequence[str]) -> DataFrame:
    """One column of spend per listed value."""
    return costs.groupBy(key).agg(
        *[
            F.sum(F.when(F.col(column) == v, F.col("cost")).otherwise(0)).alias(v)
            for v in values
        ]
    )


def two_periods(
    costs: DataFrame, keys: Sequence[str], before: Column, after: Column
) -> DataFrame:
    """Spend in two periods, the change, and each key's share of the whole change."""
    sums = (
        costs.filter(before | after)
        .groupBy(*keys)
        .agg(
            F.sum(F.when(before, F.col("cost")).otherwise(0)).alias("cost_before"),
            F.sum(F.when(after, F.col("cost")).otherwise(0)).alias("cost_after"),
        )
        .withColumn("delta", F.col("cost_after") - F.col("cost_before"))
    )
    whole = sums.agg(F.sum("delta")).scalar()  # one value, whatever the keys
    return sums.withColumn("share_of_change", ratio(F.col("delta"), whole)).withColumn(
        "change_pct", ratio((F.col("cost_after") - F.col("cost_before")) * 100, F.col("cost_before"))
    )


def budget_outlook(
    costs: DataFrame, budgets: DataFrame, as_of: date, month_start: date, month_end: date
) -> DataFrame:
    """Projected month spend at the current pace against each team's budget."""
    days, length = (as_of - month_start).days, (month_end - month_start).days
    spent = (
        costs.filter((F.col("date") >= F.lit(month_start)) & (F.col("date") < F.lit(as_of)))
        .groupBy("team")
        .agg(F.sum("cost").alias("spent"))
    )
    pace = F.coalesce(F.col("spent"), F.lit(0)).cast("double") * length / days
    return (
        budgets.join(spent, "team", "left")
        .withColumn("projected", pace)
        .withColumn("over_budget", F.col("projected") > F.col("budget").cast("double"))
    )


def same_month_last_year(monthly: DataFrame, index: str, value: str) -> DataFrame:
    """Join on the calendar, because months may be missing. ``index`` counts months."""
    old = monthly.select((F.col(index) + 12).alias(index), F.col(value).alias("last_year"))
    return (
        monthly.join(old, index)
        .withColumn("delta", F.col(value) - F.col("last_year"))
        .withColumn("yoy_pct", ratio(F.col("delta") * 100, F.col("last_year")))
    )


def anomalies(daily: DataFrame, keys: Sequence[str], limit: float = 0.2, days: int = 7):
    """Days off the mean of the previous 7 days by more than 20 percent, either way.

    Input: one row per key and day with ``cost``.
    """
    marked = trailing_mean(daily, keys, "date", "cost", days)
    cost = F.col("cost").cast("double")
    off = F.try_divide(cost - F.col("trailing_avg"), F.col("trailing_avg"))
    return marked.withColumn("deviation", off).filter(F.abs("deviation") > limit)


def daily_spikes(daily: DataFrame, keys: Sequence[str], limit: float = 0.3) -> DataFrame:
    """Days that cost over 30 percent more than the day before (calendar neighbours)."""
    prior = daily.select(*keys, F.date_add("date", 1).alias("date"), F.col("cost").alias("day_before"))
    up = ratio(F.col("cost") - F.col("day_before"), F.col("day_before"))
    return daily.join(prior, [*keys, "date"]).withColumn("rise", up).filter(F.col("rise") > limit)


def fastest_growth(monthly: DataFrame, key: str, period: str, value: str) -> DataFrame:
    """The key and period with the largest growth."""
    grown = growth(monthly, [key], period, value).filter(F.col("growth_pct").isNotNull())
    return grown.orderBy(F.desc("growth_pct"), key, period).limit(1)


def allocate(costs: DataFrame, shares: DataFrame, on: str, to: str = "team") -> DataFrame:
    """Split the cost of shared values among teams; the rest keeps its own team.

    ``shares``: (on, team, share) with shares adding to one for each value. It is a
    rule table of a few rows; the join is left to AQE's size check.
    """
    rule = shares.select(F.col(on), F.col(to).alias("_to"), F.col("share").cast("decimal(6,4)").alias("_share"))
    joined = costs.join(rule, on, "left")
    part = F.col("cost") * F.coalesce(F.col("_share"), F.lit(1).cast("decimal(6,4)"))
    return joined.withColumn(to, F.coalesce("_to", to)).withColumn("cost", part).drop("_to", "_share")


def chargeback(usage: DataFrame, tenant: str, units: str, bill: float) -> DataFrame:
    """Split a bill by each tenant's share of usage."""
    per = usage.groupBy(tenant).agg(F.sum(units).alias("units"))
    whole = per.agg(F.sum("units")).scalar()  # one value, whatever the tenants
    return per.withColumn("share", ratio(F.col("units"), whole)).withColumn("charge", F.col("share") * bill)


def slowest(log: DataFrame, elapsed: str, condition: Column, n: int, tie: str) -> DataFrame:
    return log.filter(condition).orderBy(F.desc(elapsed), tie).limit(n)


def heavy_scans(log: DataFrame, n: int = 20, over: int = 100_000_000_000) -> DataFrame:
    """Finished queries that read more than 100 GB."""
    big = (F.col("state") == "FINISHED") & (F.col("total_bytes_read") > over)
    return log.filter(big).orderBy(F.desc("total_bytes_read"), "query_id").limit(n)


# Percent of quota and the action taken there.
QUOTA_ACTIONS = [(75, "notify"), (90, "suspend"), (100, "suspend immediately")]


def quota_crossings(per_period: DataFrame, keys: Sequence[str], period: str, value: str, quota: float):
    """First period in which running use reaches each action level of the quota.

    Input: one row per key and period.
    """
    w = Window.partitionBy(*keys).orderBy(period).rowsBetween(Window.unboundedPreceding, 0)
    used = per_period.withColumn("used", F.sum(value).over(w))
    levels = F.array(
        *[F.struct(F.lit(p).alias("level"), F.lit(a).alias("action")) for p, a in QUOTA_ACTIONS]
    )
    return (
        used.select("*", F.inline(levels))
        .filter(F.col("used").cast("double") * 100 >= F.col("level") * F.lit(float(quota)))
        .groupBy(*keys, "level", "action")
        .agg(F.min(period).alias("first_period"))
    )


# Storage class, first day of age, dollars per GB and month.
TIERS = [
    (365, "deep archive", 0.00099),
    (90, "archive", 0.004),
    (30, "infrequent", 0.0125),
]
HOT_TIER = ("standard", 0.023)


def storage_tier(age_days: Column) -> Column:
    """Class by age: up to 30 days standard, then the tiers above each limit."""
    return banded(age_days, [(d, n) for d, n, _ in TIERS], HOT_TIER[0], False)


def tier_costs(files: DataFrame, age: str, size: str) -> DataFrame:
    """Monthly cost per tier, and what the same bytes would cost on the hot tier."""
    rate = F.lit(HOT_TIER[1])
    for days, _, dollars in reversed(TIERS):
        rate = F.when(F.col(age) > days, F.lit(dollars)).otherwise(rate)
    gb = F.col(size).cast("double") / F.lit(1e9)
    return (
        files.withColumn("tier", storage_tier(F.col(age)))
        .withColumn("_c", gb * rate)
        .withColumn("_h", gb * F.lit(HOT_TIER[1]))
        .groupBy("tier")
        .agg(
            F.sum(size).alias("bytes"),
            F.sum("_c").alias("monthly_cost"),
            (F.sum("_h") - F.sum("_c")).alias("saved"),
        )
    )


GET_RATE = 0.0004 / 1000  # dollars per request


def request_cost(files: Column, queries_per_day: Column, days: int = 30) -> Column:
    """Monthly request cost when each query opens each file once."""
    return files.cast("double") * queries_per_day.cast("double") * days * GET_RATE


def storage_footprint(tables: DataFrame, fail_safe_copies: float = 1.0) -> DataFrame:
    """Size x (retention days + fail-safe) by table type; external tables store nothing."""
    kept = F.when(F.col("table_type") == "external", 0.0).otherwise(
        F.col("retention_days")
        + F.when(F.col("table_type") == "permanent", fail_safe_copies).otherwise(0.0)
    )
    return tables.withColumn("total_gb", F.col("size_gb") * kept)


def regressions(before: DataFrame, after: DataFrame, key: str, factor: float) -> DataFrame:
    """Queries whose median time grew by a factor. Inputs: (key, median)."""
    a = before.select(key, F.col("median").alias("median_before"))
    b = after.select(key, F.col("median").alias("median_after"))
    slower = F.try_divide(F.col("median_after"), F.col("median_before"))
    return a.join(b, key).withColumn("factor", slower).filter(F.col("factor") >= factor)


def latency_histogram(log: DataFrame, value: str, width: int) -> DataFrame:
    """Requests per latency bucket [bucket_start, bucket_start + width)."""
    start = F.floor(F.col(value) / width) * width
    return log.groupBy(start.cast("long").alias("bucket_start")).agg(F.count("*").alias("n"))


def idle_consumers(bill: DataFrame, use: DataFrame, key: str) -> DataFrame:
    """Consumers in the bill (key, cost) without any use: what they cost and how often."""
    per = bill.groupBy(key).agg(F.sum("cost").alias("cost"), F.count("*").alias("entries"))
    return per.join(use.select(key).filter(F.col(key).isNotNull()).distinct(), key, "left_anti")


def time_per_user(log: DataFrame, user: str, elapsed: Column, ts: str, since: Column) -> DataFrame:
    """Requests, time spent and last request of each user, and whether there is none ``since``."""
    per = log.groupBy(user).agg(F.count("*").alias("requests"), F.sum(elapsed).alias("time_spent"), F.max(ts).alias("last_seen"))
    return per.withColumn("idle", F.col("last_seen") < since)


def answer_times(log: DataFrame, user: str, ts: str, tie: str, asks: Column, answers: Column) -> DataFrame:
    """Per day: questions, those answered by the user's next entry, mean and longest seconds.

    ``asks`` and ``answers`` are conditions on entries; the next entry by (ts, tie) answers
    a question or nothing does.
    """
    rows = log.select(user, ts, tie, asks.alias("_asks"), F.when(answers, F.col(ts)).alias("_at"))
    near = place(rows, [user], [ts, tie]).following(_next=F.col("_at")).df.filter("_asks")
    took = F.timestamp_diff("MICROSECOND", F.col(ts), F.col("_next"))
    per = near.groupBy(F.col(ts).cast("date").alias("day")).agg(
        F.count("*").alias("questions"), F.count(took).alias("answered"), F.sum(took).alias("_sum"), F.max(took).alias("_max")
    )
    mean = F.try_divide(F.col("_sum").cast("double"), F.col("answered").cast("double"))
    return per.select("day", "questions", "answered", (mean / 1e6).alias("mean_seconds"), (F.col("_max").cast("double") / 1e6).alias("longest_seconds"))
