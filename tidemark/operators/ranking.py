"""Ranks, top-k and runs over rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.ordered import Ordered, islands, join_back, place, ranks


def top_n(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """Sorted top rows; Spark keeps n per task before merging."""
    return df.orderBy(*order).limit(n)


def top_n_per_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, name="rn"
) -> DataFrame:
    """The first ``n`` rows of each group.

    ``row_number <= n`` lets Spark apply the limit before the shuffle as well, so a
    hot group sends at most n rows per map task.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return qualify(df, {name: F.row_number().over(w)}, F.col(name) <= n)


def qualify(df: DataFrame, windows: dict[str, Column], keep: Column) -> DataFrame:
    """Filter on window results."""
    return df.withColumns(windows).filter(keep)


def rank_in_group(df: DataFrame, keys: Sequence[str], measure: str, tie: Sequence[str], **how):
    """rank, dense_rank and row_number inside each group, highest first, skew-safe."""
    return ranks(df, keys, measure, tie, **how)


def keep_latest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the greatest by ``order``. Each task drops the others before the shuffle."""
    newest = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in order])
    return df.withColumn("_place", F.row_number().over(newest)).filter("_place = 1").drop("_place")


def newest_first(df: DataFrame, owner: str, at: str, tie: str, **how) -> DataFrame:
    """``position`` of each row among its owner's rows, newest first."""
    back = -F.unix_micros(F.col(at).cast("timestamp"))
    ordered = place(df.withColumn("_back", back), [owner], ["_back", tie], **how)
    return ordered.running_sum(position=F.lit(1).cast("long")).df.drop("_back")


def rows_of(df: DataFrame, owner: str, value, columns: Sequence[str], at: str, tie: str):
    """One owner's rows, chosen columns, newest first; the filter reaches the scan."""
    return df.filter(F.col(owner) == F.lit(value)).orderBy(F.desc(at), tie).select(*columns)


def step_runs(
    df: DataFrame, keys: Sequence[str], at: str, step: str, **how
) -> Ordered:
    """Runs of rows whose ``at`` advances by exactly ``step`` (an interval text).

    One row per key and ``at`` is expected. Appends ``island``.
    """
    ordered = place(df, keys, [at], **how)
    gap = F.col(at) != F.col("_prev_at") + F.expr(f"INTERVAL {step}")
    return islands(ordered, gap, {"_prev_at": F.col(at)})


def state_runs(df: DataFrame, keys, order: Sequence[str], state: Column, **how) -> Ordered:
    """Runs of equal ``state`` in row order. Appends ``island``."""
    ordered = place(df.withColumn("_state", state), keys, order, **how)
    turn = ~F.col("_prev_state").eqNullSafe(F.col("_state"))
    return islands(ordered, turn, {"_prev_state": F.col("_state")})


def run_summary(ordered: Ordered, at: str, *extra: Column) -> DataFrame:
    """Start, end and number of rows of each run."""
    return ordered.df.groupBy(*ordered.keys, "island").agg(
        F.min(at).alias("run_start"),
        F.max(at).alias("run_end"),
        F.count("*").alias("points"),
        *extra,
    )


def longest_run(runs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The longest run of each key; the earliest of equally long ones."""
    return top_n_per_group(runs, keys, [F.desc("points"), F.asc("run_start")], 1).drop("rn")


def long_run_rows(ordered: Ordered, at_least: int) -> DataFrame:
    """Member rows of runs with at least ``at_least`` rows."""
    rows = ordered.df
    sizes = rows.groupBy(*ordered.keys, "island").agg(F.count("*").alias("points"))
    return join_back(rows, sizes.filter(F.col("points") >= at_least), [*ordered.keys, "island"])


def collective_runs(
    df: DataFrame, entity: str, at: str, step: str, entities: int, points: int, **how
) -> DataFrame:
    """Periods in which at least ``entities`` distinct entities appear at every step."""
    per_time = (
        df.groupBy(at)
        .agg(F.countDistinct(entity).alias("entities"))
        .filter(F.col("entities") >= entities)
    )
    runs = run_summary(step_runs(per_time, [], at, step, **how), at)
    return runs.filter(F.col("points") >= points).drop("island")


def consecutive_drops(per_period: DataFrame, keys, period: str, value: str, drops: int):
    """Keys whose value fell ``drops`` times in a row. Input: one row per period."""
    w = Window.partitionBy(*keys).orderBy(period)
    fell = F.when(F.col(value) < F.lag(value).over(w), 1).otherwise(0)
    flagged = per_period.withColumn("_fell", fell)
    run = F.sum("_fell").over(w.rowsBetween(1 - drops, 0))
    return flagged.withColumn("_run", run).filter(F.col("_run") == drops).select(*keys).distinct()


def last_increasing(df: DataFrame, key: str, order: Sequence[str], value: str, n: int):
    """Keys whose last ``n`` rows strictly increase in ``value``."""
    newest = top_n_per_group(df, [key], [F.desc(c) for c in order], n)
    pairs = F.transform(
        F.array_sort(F.collect_list(F.struct(F.col("rn"), F.col(value).alias("v")))),
        lambda s: s["v"],
    )
    # n values per key at most.
    lists = newest.groupBy(key).agg(pairs.alias("v"))
    rising = F.lit(True)
    for i in range(n - 1):
        rising = rising & (F.col("v")[i] > F.col("v")[i + 1])
    return lists.filter((F.size("v") == n)).filter(rising).select(key)


def sessions(df: DataFrame, key: str, ts: str, tie: str, gap: str, **how) -> DataFrame:
    """Activity sessions: a pause of ``gap`` or more starts a new one."""
    ordered = place(df.select(key, ts, tie), [key], [ts, tie], **how)
    pause = F.col(ts) >= F.col("_prev") + F.expr(f"INTERVAL {gap}")
    return run_summary(islands(ordered, pause, {"_prev": F.col(ts)}), ts)
