"""Sketches that are made once a period and merged to longer ones: quantiles, heavy hitters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

K = 400
TRACKED = 1000


def quantile_sketches(rows: DataFrame, keys: Sequence[str | Column], value: str, k: int = K) -> DataFrame:
    """One quantile sketch (KLL) a key: keys, sketch. NULL values are left out.

    With k = 400 a rank is off by about 0.7 % of the rows with a confidence of 99 %.
    """
    return rows.groupBy(*keys).agg(F.kll_sketch_agg_double(F.col(value).cast("double"), k).alias("sketch"))


def merged_sketches(sketches: DataFrame, keys: Sequence[str | Column], k: int = K) -> DataFrame:
    """Sketches of shorter periods as one for each of ``keys``; the rows are not read again."""
    return sketches.groupBy(*keys).agg(F.kll_merge_agg_double("sketch", k).alias("sketch"))


def quantiles(sketches: DataFrame, shares: dict[str, float]) -> DataFrame:
    """The values below which these shares of the rows lie, and n; the sketch goes."""
    found = [F.kll_sketch_get_quantile_double("sketch", F.lit(float(s))).alias(name) for name, s in shares.items()]
    keys = [c for c in sketches.columns if c != "sketch"]
    return sketches.select(*keys, F.kll_sketch_get_n_double("sketch").alias("n"), *found)


def hitter_sketches(rows: DataFrame, keys: Sequence[str | Column], item: str, tracked: int = TRACKED) -> DataFrame:
    """One sketch of the frequent items a key, with at most ``tracked`` counters: keys, sketch.

    Counts are exact while a key has no more than three quarters as many items as counters;
    beyond that they may be off by a few of n / ``tracked``.
    """
    return rows.groupBy(*keys).agg(F.expr(f"approx_top_k_accumulate(`{item}`, {int(tracked)})").alias("sketch"))


def merged_hitters(sketches: DataFrame, keys: Sequence[str | Column], tracked: int = TRACKED) -> DataFrame:
    return sketches.groupBy(*keys).agg(F.expr(f"approx_top_k_combine(sketch, {int(tracked)})").alias("sketch"))


def heavy_hitters(sketches: DataFrame, most: int) -> DataFrame:
    """(keys, place, item, n): the ``most`` frequent items of each sketch; ties by item."""
    keys = [c for c in sketches.columns if c != "sketch"]
    listed = sketches.select(*keys, F.explode(F.expr(f"approx_top_k_estimate(sketch, {int(most)})")).alias("h"))
    return listed.select(*keys, F.col("h.item").alias("item"), F.col("h.count").alias("n"))
