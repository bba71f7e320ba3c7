"""Slowly changing dimensions. Intervals are half-open; an open end is NULL."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import any_differs, differs
from tidemark.operators.ordered import place

START, END, CURRENT = "effective_date", "expiration_date", "is_current"


def require_unique(df: DataFrame, key: Sequence[str], what: str) -> None:
    """Fail when a key occurs twice; reads back at most one offending key."""
    twice = df.groupBy(*key).count().filter("count > 1").drop("count").take(1)
    if twice:
        raise ValueError(f"{what} holds a key more than once: {twice[0].asDict()}")


def scd1(dim: DataFrame, staging: DataFrame, key: Sequence[str]) -> DataFrame:
    """Overwrite in place: staged rows replace, others stay, new keys are added."""
    from tidemark.operators.changes import upsert

    return upsert(dim, staging, key)


def scd2(
    dim: DataFrame,
    staging: DataFrame,
    key: Sequence[str],
    tracked: Sequence[str],
    load_date: date,
) -> DataFrame:
    """One pass: close changed versions, open new ones, add new keys.

    The comparison is null-safe. A second run with the same staging adds nothing; a
    second change on one day corrects that day's version. Keys missing from staging
    stay as they are.
    """
    require_unique(staging, key, "staging")
    day = F.lit(load_date)
    names = [*key, *tracked, START, END, CURRENT]
    old, new = dim.filter(CURRENT), staging.select(*key, *tracked)
    pair = old.select(
        *key, F.struct(*tracked, START).alias("o"), F.lit(True).alias("_has_o")
    ).join(
        new.select(*key, F.struct(*tracked).alias("n"), F.lit(True).alias("_has_n")),
        list(key),
        "full",
    )

    def version(source: str, start, end, current: bool):
        return F.struct(
            *[F.col(f"{source}.{c}").alias(c) for c in tracked],
            start.cast("date").alias(START),
            end.cast("date").alias(END),
            F.lit(current).alias(CURRENT),
        )

    none = F.lit(None)
    kept = version("o", F.col(f"o.{START}"), none, True)
    closed = version("o", F.col(f"o.{START}"), day, False)
    opened = version("n", day, none, True)
    corrected = version("n", F.col(f"o.{START}"), none, True)
    changed = any_differs("o", "n", tracked)
    versions = (
        F.when(F.col("_has_n").isNull(), F.array(kept))
        .when(F.col("_has_o").isNull(), F.array(opened))
        .when(~changed, F.array(kept))
        .when(F.col(f"o.{START}") >= day, F.array(corrected))
        .otherwise(F.array(closed, opened))
    )
    now = pair.select(*key, F.inline(versions)).select(*names)
    return dim.filter(~F.col(CURRENT)).select(*names).unionByName(now)


def snapshot_scd2(
    target: DataFrame | None,
    staging: DataFrame,
    key: Sequence[str],
    tracked: Sequence[str],
    load_date: date,
) -> DataFrame:
    """First run: every staged row is current. Later runs: expire and insert."""
    if target is None:
        require_unique(staging, key, "staging")
        return staging.select(
            *key,
            *tracked,
            F.lit(load_date).alias(START),
            F.lit(None).cast("date").alias(END),
            F.lit(True).alias(CURRENT),
        )
    return scd2(target, staging, key, tracked, load_date)


def scd3(dim: DataFrame, staging: DataFrame, key: Sequence[str], column: str) -> DataFrame:
    """Keep the last value next to the new one, in ``previous_<column>``."""
    require_unique(staging, key, "staging")
    before = f"previous_{column}"
    if before not in dim.columns:
        dim = dim.withColumn(before, F.lit(None).cast(dict(dim.dtypes)[column]))
    fresh = staging.select(*key, F.struct(F.col(column).alias("v")).alias("_n"))
    joined = dim.join(fresh, list(key), "left")
    changed = F.col("_n").isNotNull() & differs(F.col("_n.v"), F.col(column))
    return joined.select(
        *[
            F.when(changed, F.col("_n.v")).otherwise(F.col(column)).alias(column)
            if c == column
            else F.when(changed, F.col(column)).otherwise(F.col(before)).alias(before)
            if c == before
            else F.col(c)
            for c in dim.columns
        ]
    )


def current_rows(dim: DataFrame) -> DataFrame:
    return dim.filter(F.col(END).isNull())


def versions_of(dim: DataFrame, condition) -> DataFrame:
    """All versions of the chosen keys, in order of validity."""
    return dim.filter(condition).orderBy(START)


def rebuild_timeline(
    dim: DataFrame,
    late: DataFrame,
    key: Sequence[str],
    tracked: Sequence[str],
    **how,
) -> DataFrame:
    """Merge rows by business date: each version ends where the next one starts.

    Neighbours with equal values collapse into one version. A late row with the start
    of an existing version replaces it.
    """
    cols = [*key, *tracked, START]
    rows = dim.select(*cols, F.lit(0).alias("_src")).unionByName(
        late.select(*cols, F.lit(1).alias("_src"))
    )
    best = F.max_by(F.struct(*tracked), F.struct("_src", *tracked)).alias("_v")
    rows = rows.groupBy(*key, START).agg(best).select(*key, START, "_v")
    ordered = place(rows, key, [START], **how).previous(_p=F.col("_v"), _has=F.lit(True))
    turn = F.col("_has").isNull() | ~F.col("_p").eqNullSafe(F.col("_v"))
    ordered = ordered.map(lambda d: d.filter(turn).drop("_p", "_has"))
    out = ordered.following(_next=F.col(START)).df
    return out.select(
        *key,
        *[F.col("_v")[c].alias(c) for c in tracked],
        START,
        F.col("_next").alias(END),
        F.col("_next").isNull().alias(CURRENT),
    )


def half_open(dim: DataFrame, end: str, open_end: date = date(9999, 12, 31)) -> DataFrame:
    """Closed intervals with a far-future end become half-open with NULL."""
    return dim.withColumn(
        end, F.when(F.col(end) == F.lit(open_end), None).otherwise(F.date_add(end, 1))
    )


def hash_key(columns: Sequence[str]):
    """A surrogate key that needs no coordination: hash of natural key and start."""
    return F.xxhash64(*columns)


def dense_keys(df: DataFrame, order: Sequence[str], name: str, after: int = 0, **how) -> DataFrame:
    """Surrogate keys that continue from ``after``, numbered without a single task."""
    ordered = place(df, [], order, **how).running_sum(**{name: F.lit(1).cast("long")})
    return ordered.df.withColumn(name, F.col(name) + after)


def timeline_faults(dim: DataFrame, key: Sequence[str], **how) -> DataFrame:
    """Per key: overlapping versions, gaps, and more or less than one current row."""
    ordered = place(dim.withColumn("_at", F.col(START)), key, ["_at"], **how)
    near = ordered.following(_next=F.col(START)).df
    far = F.coalesce(F.col(END), F.lit("9999-12-31").cast("date"))
    return (
        near.groupBy(*key)
        .agg(
            F.count_if(F.col("_next") < far).alias("overlaps"),
            F.count_if(F.col("_next") > far).alias("gaps"),
            F.count_if(F.col(CURRENT)).alias("current_rows"),
        )
        .filter("overlaps > 0 OR gaps > 0 OR current_rows <> 1")
    )
