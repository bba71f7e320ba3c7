"""Feature tables, fallbacks, drift and experiments."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import at_midnight, bucket, last_days, money, ratio


def user_features(
    events: DataFrame, as_of: date, kinds: Sequence[str], spans: Sequence[int] = (7, 30)
) -> DataFrame:
    """Per user at ``as_of``: counts per kind and span, purchase spend, days since last."""
    before = events.filter(F.col("ts") < F.lit(at_midnight(as_of)))
    aggs = []
    for days in spans:
        recent = last_days("ts", as_of, days)
        for kind in kinds:
            hit = recent & (F.col("event_type") == kind)
            aggs.append(F.count_if(hit).alias(f"{kind}_{days}d"))
        spend = F.when(recent & (F.col("event_type") == "purchase"), money("value"))
        aggs.append(F.coalesce(F.sum(spend), F.lit(0).cast("decimal(28,2)")).alias(f"spend_{days}d"))
    last = F.datediff(F.lit(as_of), F.max("ts").cast("date")).alias("days_since_last")
    return before.groupBy("user_id").agg(*aggs, last)


def feature_version(features: DataFrame, as_of: date, version: str) -> DataFrame:
    """Stamp features so that a recomputation for a past date is kept apart."""
    return features.withColumns({"as_of": F.lit(as_of), "feature_version": F.lit(version)})


def with_fallback(
    users: DataFrame, own: DataFrame, popular: DataFrame, user: str, item: str
) -> DataFrame:
    """A user's own item, or the most popular one (a single row) for users without."""
    top = popular.select(item).limit(1).collect()
    spare = F.lit(top[0][0] if top else None)
    return (
        users.select(user)
        .join(own.select(user, item), user, "left")
        .withColumn("is_fallback", F.col(item).isNull())
        .withColumn(item, F.coalesce(F.col(item), spare))
    )


def psi(
    baseline: DataFrame, current: DataFrame, value: str, edges: Sequence[float], floor: float = 1e-4
) -> DataFrame:
    """Population stability index over bins cut at ``edges`` (a handful of numbers)."""
    slot = F.lit(0)
    for e in edges:
        slot = slot + F.when(F.col(value) > F.lit(e), 1).otherwise(0)
    both = baseline.select(slot.alias("bin"), F.lit(1).alias("b"), F.lit(0).alias("c")).unionByName(
        current.select(slot.alias("bin"), F.lit(0).alias("b"), F.lit(1).alias("c"))
    )
    bins = both.groupBy("bin").agg(F.sum("b").alias("b"), F.sum("c").alias("c"))
    totals = bins.agg(F.sum("b"), F.sum("c")).first()
    a = F.greatest(ratio(F.col("b"), F.lit(totals[0])), F.lit(floor))
    z = F.greatest(ratio(F.col("c"), F.lit(totals[1])), F.lit(floor))
    return bins.select("bin", "b", "c", ((z - a) * F.log(z / a)).alias("term"))


def assign_variant(user: Column | str, variants: int = 2) -> Column:
    """A stable variant per user, from the md5 of the id."""
    return bucket(user, variants)


def ab_metrics(users: DataFrame, variant: str, converted: str) -> DataFrame:
    """Users, conversions and rate per variant. Input: one row per user."""
    return users.groupBy(variant).agg(
        F.count("*").alias("users"),
        F.sum(F.col(converted).cast("long")).alias("conversions"),
        ratio(F.sum(F.col(converted).cast("long")), F.count("*")).alias("rate"),
    )


def ab_lift(metrics: DataFrame, variant: str) -> DataFrame:
    """Lift and z value of variant 1 against variant 0 (two rows in, one out)."""

    def of(v: int, c: str) -> Column:
        return F.max(F.when(F.col(variant) == v, F.col(c))).cast("double")

    n0, n1, c0, c1 = of(0, "users"), of(1, "users"), of(0, "conversions"), of(1, "conversions")
    pooled = (c0 + c1) / (n0 + n1)
    error = F.sqrt(pooled * (F.lit(1.0) - pooled) * (F.lit(1.0) / n0 + F.lit(1.0) / n1))
    return metrics.agg(
        F.try_divide(c1 / n1 - c0 / n0, c0 / n0).alias("lift"),
        F.try_divide(c1 / n1 - c0 / n0, error).alias("z"),
    )
