"""Upserts, conditional changes, change feeds, incremental and layered loads."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import any_differs
from tidemark.operators.ranking import keep_latest
from tidemark.operators.scd import require_unique


def upsert(target: DataFrame, source: DataFrame, key: Sequence[str]) -> DataFrame:
    """Matched rows take the source's values (NULLs too), unmatched are inserted."""
    require_unique(source, key, "source")
    rest = [c for c in target.columns if c not in key]
    old = target.select(*key, F.struct(*rest).alias("o"))
    new = source.select(*key, F.struct(*rest).alias("n"))
    both = old.join(new, list(key), "full")
    merged = F.when(F.col("n").isNotNull(), F.col("n")).otherwise(F.col("o"))
    return both.select(*key, merged.alias("m")).select(*key, "m.*").select(*target.columns)


def update_where(df: DataFrame, condition: Column, **values: Column) -> DataFrame:
    """SET columns where the condition holds; NULL counts as not true."""
    return df.withColumns(
        {c: F.when(condition, v).otherwise(F.col(c)) for c, v in values.items()}
    )


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """Rows for which the condition is false or unknown stay."""
    return df.filter(~F.coalesce(condition, F.lit(False)))


def change_feed(before: DataFrame, after: DataFrame, key: Sequence[str]) -> DataFrame:
    """Row changes between two versions; an update is a DELETE and an INSERT row."""
    rest = [c for c in before.columns if c not in key]
    pair = before.select(*key, F.struct(*rest).alias("o")).join(
        after.select(*key, F.struct(*rest).alias("n")), list(key), "full"
    )

    def entry(side: str, action: str, update: bool) -> Column:
        return F.struct(
            *[F.col(f"{side}.{c}").alias(c) for c in rest],
            F.lit(action).alias("_action"),
            F.lit(update).alias("_is_update"),
        )

    changed = any_differs("o", "n", rest)
    rows = (
        F.when(F.col("o").isNull(), F.array(entry("n", "INSERT", False)))
        .when(F.col("n").isNull(), F.array(entry("o", "DELETE", False)))
        .when(changed, F.array(entry("o", "DELETE", True), entry("n", "INSERT", True)))
    )
    return pair.select(*key, F.inline(rows))


def last_changes(
    log: DataFrame, key: Sequence[str], sequence: str, action: str
) -> tuple[DataFrame, DataFrame]:
    """(rows to write, keys to remove): the last change of each key decides."""
    last = keep_latest(log, key, [sequence])
    gone = F.col(action) == "DELETE"
    return last.filter(~gone).drop(action, sequence), last.filter(gone).select(*key)


def apply_changes(
    target: DataFrame, log: DataFrame, key: Sequence[str], sequence: str, action: str
) -> DataFrame:
    """Apply a change log: the last change of each key wins, deletes remove."""
    live, gone = last_changes(log, key, sequence, action)
    return upsert(target.join(gone, list(key), "left_anti"), live.select(*target.columns), key)


def add_column(df: DataFrame, name: str, kind: str, default=None) -> DataFrame:
    """A table rebuilt with a new defaulted or nullable column."""
    return df.withColumn(name, F.lit(default).cast(kind))


def split_quality(
    df: DataFrame, rules: dict[str, Column]
) -> tuple[DataFrame, DataFrame]:
    """(good rows, quarantined rows with the names of the rules they break)."""
    broken = F.array_compact(
        F.array(
            *[
                F.when(~F.coalesce(rule, F.lit(False)), F.lit(name))
                for name, rule in rules.items()
            ]
        )
    )
    marked = df.withColumn("reasons", broken)
    return marked.filter(F.size("reasons") == 0).drop("reasons"), marked.filter(
        F.size("reasons") > 0
    )


def retry(quarantine: DataFrame, fix: Callable[[DataFrame], DataFrame], rules: dict[str, Column]):
    """Fix quarantined rows and test them again."""
    return split_quality(fix(quarantine.drop("reasons")), rules)


def new_rows(source: DataFrame, ts: str, high_water, look_back: str) -> DataFrame:
    """Source rows of the periods that must be recomputed after ``high_water``."""
    return source.filter(F.col(ts) >= F.lit(high_water) - F.expr(f"INTERVAL {look_back}"))


def refresh_partitions(df: DataFrame, path: str, column: str) -> None:
    """Replace only the partitions present in ``df``; others are left alone.

    Rows are ranged by partition and row hash: few files per partition, and a
    partition with much data is written by several tasks.
    """
    (
        df.repartitionByRange(F.col(column), F.xxhash64(*df.columns))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(column)
        .parquet(path)
    )


def merge_partials(
    kept: DataFrame, fresh: DataFrame, keys: Sequence[str], sums: Sequence[str]
) -> DataFrame:
    """Keep a pre-computed aggregate in step by adding the partials of new rows."""
    return (
        kept.unionByName(fresh).groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums])
    )
