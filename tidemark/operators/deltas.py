"""Aggregates kept by signed deltas: rows come with +1, go with -1, updates do both.

The state counts how often each value occurs in each group. Counts, sums, distinct counts,
smallest and largest values all follow from it, also when rows are taken back; partials that
only add cannot do that.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import cut, fresh_path


def deltas(before: DataFrame, after: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``columns`` and delta: how many more such rows there are after than before, not 0."""
    gone = before.select(*columns, F.lit(-1).cast("long").alias("delta"))
    come = after.select(*columns, F.lit(1).cast("long").alias("delta"))
    return gone.unionByName(come).groupBy(*columns).agg(F.sum("delta").alias("delta")).filter("delta <> 0")


def change_deltas(changes: DataFrame, columns: Sequence[str], action: str = "action", old: str = "old_", new: str = "") -> DataFrame:
    """Deltas from change records: an INSERT brings its new values, a DELETE takes its old ones,
    an UPDATE does both. Other actions are an error.
    """
    verb = F.upper(action)
    side = lambda prefix, sign: F.struct(
        *[F.col(f"{prefix}{c}").alias(c) for c in columns], F.lit(sign).cast("long").alias("delta")
    )
    both = (
        F.when(verb == "INSERT", F.array(side(new, 1)))
        .when(verb == "DELETE", F.array(side(old, -1)))
        .when(verb == "UPDATE", F.array(side(old, -1), side(new, 1)))
        .otherwise(F.raise_error(F.concat(F.lit("unknown action "), F.coalesce(F.col(action), F.lit("NULL")))))
    )
    signed = changes.select(F.explode(both).alias("r")).select("r.*")
    return signed.groupBy(*columns).agg(F.sum("delta").alias("delta")).filter("delta <> 0")


def fold(state: DataFrame, changes: DataFrame, group: Sequence[str], value: str) -> DataFrame:
    """The state (group, value, refs) after the changes (group, value, delta).

    Taking back more than there is is an error: the state and the feed do not belong together.
    """
    both = state.select(*group, value, F.col("refs")).unionByName(changes.select(*group, value, F.col("delta").alias("refs")))
    refs = both.groupBy(*group, value).agg(F.sum("refs").alias("refs"))
    wrong = F.raise_error(F.lit("more rows are taken back than the state holds"))
    return refs.withColumn("refs", F.when(F.col("refs") < 0, wrong).otherwise(F.col("refs"))).filter("refs <> 0")


def summaries(state: DataFrame, group: Sequence[str], value: str) -> DataFrame:
    """group, n, total, distinct_values, least, most; NULL values count in n only."""
    known = F.col(value).isNotNull()
    return state.groupBy(*group).agg(
        F.sum("refs").alias("n"),
        F.sum(F.col(value) * F.col("refs")).alias("total"),
        F.count_if(known).alias("distinct_values"),
        F.min(value).alias("least"),
        F.max(value).alias("most"),
    )


class KeptAggregate:
    """The state and the summaries of an aggregate, in Parquet by bucket of the group.

    ``apply`` reads and rewrites only the buckets that the changes touch. Each call writes to
    new folders and then names them, so a call that fails leaves the state before it.
    """

    def __init__(self, spark: SparkSession, group: Sequence[str], value: str, buckets: int = 64):
        self.spark, self.group, self.value, self.buckets = spark, list(group), value, buckets
        self._folders: dict[int, str] = {}
        self.rewritten: list[int] = []

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.group), F.lit(self.buckets)).cast("int")

    def load(self, rows: DataFrame) -> None:
        """Starts from a table."""
        self._folders = {}
        self.apply(rows.groupBy(*self.group, self.value).agg(F.count("*").alias("delta")))

    def apply(self, changes: DataFrame) -> None:
        signed = cut(changes.select(*self.group, self.value, "delta").withColumn("bucket", self._bucket()))
        touched = sorted(r[0] for r in signed.select("bucket").distinct().collect())  # at most ``buckets``
        self.rewritten = touched
        if not touched:
            return
        old = [f"{self._folders[b]}/bucket={b}" for b in touched if b in self._folders]
        if old:
            state = self.spark.read.parquet(*old)
        else:
            state = signed.limit(0).select(*self.group, self.value, F.col("delta").alias("refs"))
        path = fresh_path(self.spark, "kept")
        after = fold(state, signed.drop("bucket"), self.group, self.value).withColumn("bucket", self._bucket())
        after.write.partitionBy("bucket").parquet(path)
        left = {r[0] for r in self.spark.read.schema(after.schema).parquet(path).select("bucket").distinct().collect()}
        for b in touched:
            if b in left:
                self._folders[b] = path
            else:
                self._folders.pop(b, None)
        if not getattr(self, "_schema", None):
            self._schema = after.drop("bucket").schema

    def state(self) -> DataFrame:
        folders = [f"{path}/bucket={b}" for b, path in self._folders.items()]
        if not folders:
            return self.spark.createDataFrame([], self._schema)
        return self.spark.read.schema(self._schema).parquet(*folders)

    def result(self) -> DataFrame:
        return summaries(self.state(), self.group, self.value)
