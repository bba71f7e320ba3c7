"""Time series as run-length and delta tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ordered import place
from tidemark.operators.ranking import state_runs


def deltas(df: DataFrame, keys: Sequence[str], ts: str, tie: str, **how) -> DataFrame:
    """Microseconds since the previous point of the series; NULL for the first."""
    ordered = place(df, keys, [ts, tie], **how).previous(_p=F.col(ts))
    gap = F.timestamp_diff("MICROSECOND", F.col("_p"), F.col(ts))
    return ordered.df.withColumn("delta_us", gap).drop("_p")


def encode(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: Column, **how) -> DataFrame:
    """Runs of equal value: start, end, value, number of points."""
    ordered = state_runs(df, keys, order, value, **how)
    return ordered.df.groupBy(*keys, "island").agg(
        F.min(order[0]).alias("run_start"),
        F.max(order[0]).alias("run_end"),
        F.min("_state").alias("run_value"),
        F.count("*").alias("points"),
    )


def decode(runs: DataFrame, keys: Sequence[str], step: str) -> DataFrame:
    """Points of regular series, back from their runs."""
    points = F.sequence("run_start", "run_end", F.expr(f"INTERVAL {step}"))
    return runs.select(*keys, F.explode(points).alias("ts"), F.col("run_value").alias("value"))


def in_range(runs: DataFrame, start, end) -> DataFrame:
    """Runs that touch [start, end], clipped to it, without decoding."""
    lo, hi = F.lit(start), F.lit(end)
    return (
        runs.filter((F.col("run_end") >= lo) & (F.col("run_start") <= hi))
        .withColumn("clip_start", F.greatest("run_start", lo))
        .withColumn("clip_end", F.least("run_end", hi))
    )
