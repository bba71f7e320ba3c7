"""Aggregations: totals on rows, salted, roll-ups, sketches, cohorts, trends."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from datetime import date

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import month_index, money
from tidemark.operators.ordered import join_back, place, ranks
from tidemark.session import cut


def with_group_totals(df: DataFrame, keys: Sequence[str], **aggs: Column) -> DataFrame:
    """Group aggregates on every row, by pre-aggregation and a join.

    Unlike an unordered window, a hot key is combined before the shuffle, and the
    join back can be split by AQE.
    """
    totals = df.groupBy(*keys).agg(*[c.alias(n) for n, c in aggs.items()])
    return join_back(df, totals, keys)


def salted_totals(
    df: DataFrame, key: str, value: str, salts: int = 32, name: str = "total"
) -> DataFrame:
    """Two-phase sum and count: per (key, salt), then per key."""
    salt = F.pmod(F.xxhash64(*df.columns), F.lit(salts))
    partial = df.groupBy(key, salt.alias("_salt")).agg(
        F.sum(value).alias("_s"), F.count("*").alias("_n")
    )
    return partial.groupBy(key).agg(F.sum("_s").alias(name), F.sum("_n").alias("n"))


def partition_totals(df: DataFrame, key: str, value: str) -> DataFrame:
    """A custom aggregation per partition (Arrow batches), then a built-in merge.

    ``value`` must be an integer column (for money: cents).
    """

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            sums = b.groupby(key, sort=False, dropna=False)[value].agg(["sum", "count"])
            yield sums.reset_index().rename(columns={"sum": "s", "count": "c"})

    kind = dict(df.dtypes)[key]
    partial = df.select(key, value).mapInPandas(fold, f"{key} {kind}, s long, c long")
    return partial.groupBy(key).agg(F.sum("s").alias("total"), F.sum("c").alias("n"))


def growth(
    monthly: DataFrame, keys: Sequence[str], period: str, value: str
) -> DataFrame:
    """Change against the previous existing period. Input: one row per key and period."""
    w = Window.partitionBy(*keys).orderBy(period)
    prev = F.lag(value).over(w)
    out = monthly.withColumn("previous", prev)
    change = (F.col(value) - F.col("previous")).cast("double")
    return out.withColumn("delta", F.col(value) - F.col("previous")).withColumn(
        "growth_pct", F.try_divide(change * 100, F.col("previous").cast("double"))
    )


def running_total(per_period: DataFrame, keys: Sequence[str], period: str, value: str):
    """Cumulative sum over rows already aggregated to one per key and period."""
    w = (
        Window.partitionBy(*keys)
        .orderBy(period)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return per_period.withColumn("running_total", F.sum(value).over(w))


def rolling_rows(per_period: DataFrame, keys, period: str, value: str, rows: int):
    """Mean over the last ``rows`` rows of a key. Input: one row per key and period."""
    w = Window.partitionBy(*keys).orderBy(period).rowsBetween(1 - rows, 0)
    total, n = F.sum(value).over(w).cast("double"), F.count(value).over(w)
    return per_period.withColumn("rolling_avg", total / n)


def rolling_days(per_day: DataFrame, keys, day: str, value: str, days: int):
    """Mean over the last ``days`` calendar days of a key."""
    d = per_day.withColumn("_d", F.unix_date(day))
    w = Window.partitionBy(*keys).orderBy("_d").rangeBetween(1 - days, 0)
    total, n = F.sum(value).over(w).cast("double"), F.count(value).over(w)
    return d.withColumn("rolling_avg", total / n).drop("_d")


def trailing_mean(per_day: DataFrame, keys, day: str, value: str, days: int):
    """Mean over the ``days`` calendar days before each day, not counting it."""
    d = per_day.withColumn("_d", F.unix_date(day))
    w = Window.partitionBy(*keys).orderBy("_d").rangeBetween(-days, -1)
    total, n = F.sum(value).over(w).cast("double"), F.count(value).over(w)
    return d.withColumn("trailing_avg", F.try_divide(total, n.cast("double"))).drop("_d")


def daily_sketch(df: DataFrame, day: Column, member: str) -> DataFrame:
    """Per day: rows and a mergeable distinct-count sketch."""
    return df.groupBy(day.alias("day")).agg(
        F.count("*").alias("n"), F.hll_sketch_agg(member).alias("sketch")
    )


def merge_sketches(daily: DataFrame, period: Column) -> DataFrame:
    return daily.groupBy(period.alias("period")).agg(
        F.sum("n").alias("n"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("members"),
    )


def rollup_level(df: DataFrame, keys: Sequence[str], ts: str, unit: str) -> DataFrame:
    """Additive partials of ``value`` per key and time unit; feed one level to the next.

    A level's input is either detail rows or the output of a finer level.
    """
    slot = F.date_trunc(unit, ts).alias("slot")
    if "n" in df.columns:
        parts = [F.sum("n"), F.sum("total"), F.min("lowest"), F.max("highest")]
    else:
        v = F.col("value")
        parts = [F.count("*"), F.sum(money(v)), F.min(v), F.max(v)]
    names = ["n", "total", "lowest", "highest"]
    return df.groupBy(*keys, slot).agg(*[p.alias(a) for p, a in zip(parts, names)])


def retained(levels: DataFrame, slot: str, as_of: date, days: int) -> DataFrame:
    """Rows of a level that its retention keeps."""
    return levels.filter(F.col(slot) >= F.date_sub(F.lit(as_of), days).cast("timestamp_ntz"))


def cohorts(activity: DataFrame, member: str, at: str, offsets: Sequence[int]) -> DataFrame:
    """Share of each joining month's members that are active some months later.

    One shuffle by member: the set of a member's months is bounded by the calendar and
    is combined before the shuffle.
    """
    per = activity.groupBy(member).agg(F.collect_set(month_index(at)).alias("months"))
    per = per.withColumn("m0", F.array_min("months"))
    sizes = per.groupBy("m0").agg(F.count("*").alias("members"))
    wanted = F.array(*[F.lit(o) for o in offsets])
    active = F.array_intersect(F.transform("months", lambda m: m - F.col("m0")), wanted)
    later = (
        per.select("m0", F.explode(active).alias("offset"))
        .groupBy("m0", "offset")
        .agg(F.count("*").alias("active"))
    )
    year = F.floor((F.col("m0") - 1) / 12).cast("string")
    month = F.lpad((F.pmod(F.col("m0") - 1, F.lit(12)) + 1).cast("string"), 2, "0")
    return later.join(sizes, "m0").select(
        F.concat_ws("-", year, month).alias("cohort"),
        "offset", "members", "active", (F.col("active") / F.col("members")).alias("share"),
    )


def exact_median(df: DataFrame, keys: Sequence[str], value: str, **how) -> DataFrame:
    """Median per key through ranks; no key's values are gathered in memory."""
    # Read for measuring, ranking and sizing, so it is materialised once.
    counted = cut(
        df.filter(F.col(value).isNotNull())
        .groupBy(*keys, value)
        .agg(F.count("*").alias("_n"))
    )
    upto = place(counted, keys, [value], **how).running_sum(_hi=F.col("_n")).df
    sizes = counted.groupBy(*keys).agg(F.sum("_n").alias("_all"))
    low = F.floor((F.col("_all") + 1) / 2)
    high = F.floor((F.col("_all") + 2) / 2)
    first = F.col("_hi") - F.col("_n")
    rows = join_back(upto, sizes, keys).filter((F.col("_hi") >= low) & (first < high))
    # At most two distinct values per key remain: the lower and the upper middle.
    pick_low = F.min(value).cast("double")
    pick_high = F.max(value).cast("double")
    return rows.groupBy(*keys).agg(((pick_low + pick_high) / 2).alias("median"))


def trend_slope(monthly: DataFrame, keys: Sequence[str], index: str, value: str) -> DataFrame:
    """Least-squares slope per key over one row per period, from exact sums."""
    x, y = F.col(index).cast("decimal(38,0)"), F.col(value)
    sums = monthly.groupBy(*keys).agg(
        F.count("*").alias("periods"),
        F.sum(x).cast("double").alias("sx"),
        F.sum(y).cast("double").alias("sy"),
        F.sum(F.col(index) * y).cast("double").alias("sxy"),
        F.sum(F.col(index) * F.col(index)).cast("double").alias("sxx"),
    )
    top = F.col("periods") * F.col("sxy") - F.col("sx") * F.col("sy")
    bottom = F.col("periods") * F.col("sxx") - F.col("sx") * F.col("sx")
    return sums.select(*keys, "periods", F.try_divide(top, bottom).alias("slope"))


def top_share(spend: DataFrame, keys: Sequence[str], member: str, value: str, share: float):
    """Members within the top ``share`` of their group by value (percent rank).

    Input: one row per group and member; it is materialised once. NULL values rank last.
    """
    spend = cut(spend)
    counted = spend.groupBy(*keys).agg(F.count("*").alias("_size"))
    ranked = join_back(ranks(spend, keys, value, [member]), counted, keys)
    percent = F.coalesce(
        F.try_divide((F.col("rank") - 1).cast("double"), (F.col("_size") - 1).cast("double")),
        F.lit(0.0),
    )
    return ranked.filter(percent <= share).drop("row_num", "rank", "dense_rank", "_size")
