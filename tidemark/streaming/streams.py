"""Structured Streaming jobs. Transforms are plain DataFrame functions, so the same
code serves batch and stream; sinks commit by batch id, so a replay adds nothing."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.operators.changes import last_changes
from tidemark.operators.costs import daily_spikes
from tidemark.operators.scd import require_unique
from tidemark.operators.sketches import TRACKED, heavy_hitters, hitter_sketches
from tidemark.operators.versions import Dataset
from tidemark.session import fresh_path

EVENT = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def landed(
    spark: SparkSession, path: str, schema: str = EVENT, glob: str | None = None,
    files_per_batch: int | None = None, ts: str | None = "ts",
) -> DataFrame:
    """Newly landed Parquet files as a stream; event time becomes a zoned timestamp.

    ``glob`` names the tables to take below ``path``, each a file or a folder of files.
    ``files_per_batch`` caps the intake of one batch during a spike.
    """
    reader = spark.readStream.schema(schema)
    if glob:
        # As a part of the path it finds folders, too; a filter would only see file names.
        path = f"{path.rstrip('/')}/{{{glob}}}"
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    rows = reader.parquet(path)
    return rows.withColumn(ts, F.col(ts).cast("timestamp")) if ts else rows


def zoned(df: DataFrame, ts: str = "ts") -> DataFrame:
    """The batch twin of ``landed``: same types."""
    return df.withColumn(ts, F.col(ts).cast("timestamp"))


# --- transforms for both worlds ------------------------------------------------------


def hourly_health(events: DataFrame) -> DataFrame:
    """Counts, errors and about how many users per hour."""
    return events.groupBy(F.window("ts", "1 hour")).agg(
        F.count("*").alias("n"),
        F.count_if(F.col("event_type") == "error").alias("errors"),
        F.approx_count_distinct("user_id").alias("users_about"),
    ).select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "n", "errors", "users_about")


def active_now(events: DataFrame, span: str = "10 minutes", slide: str = "5 minutes") -> DataFrame:
    """Sliding windows of activity."""
    return events.groupBy(F.window("ts", span, slide)).agg(
        F.count("*").alias("n"), F.approx_count_distinct("user_id").alias("users_about")
    ).select(F.col("window.start").alias("window_start"), "n", "users_about")


def active_users(events: DataFrame, span: str = "10 minutes", slide: str = "5 minutes") -> DataFrame:
    """Sliding windows of a batch: events and the exact number of active users."""
    per = events.groupBy(F.window("ts", span, slide), "user_id").agg(F.count("*").alias("n"))
    return per.groupBy("window").agg(F.sum("n").alias("n"), F.count("user_id").alias("users")).select(
        F.col("window.start").alias("window_start"), "n", "users"
    )


def top_per_hour(events: DataFrame, most: int = 3) -> DataFrame:
    """The event types with most events in each hour, from counts; ties by name."""
    per = events.groupBy(F.window("ts", "1 hour"), "event_type").agg(F.count("*").alias("n"))
    order = Window.partitionBy("window").orderBy(F.desc("n"), "event_type")
    ranked = per.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= most)
    return ranked.select(F.col("window.start").alias("window_start"), "place", "event_type", "n")


def feature_counters(events: DataFrame, item: str = "event_type", span: str = "1 hour") -> DataFrame:
    """(window_start, sketch): bounded counters of the frequent items of each window, for both
    worlds. In a stream the state of a window is one sketch, however many items it sees.
    """
    counted = hitter_sketches(events, [F.window("ts", span).alias("window")], item)
    return counted.select(F.col("window.start").alias("window_start"), "sketch")


def top_items(counters: DataFrame, most: int = 3) -> DataFrame:
    """(window_start, place, item, n): the ``most`` frequent items of each window, ties by item.

    Counts are exact while a window has no more items than three quarters of its counters.
    All counters of a sketch are ranked, so that a tie does not depend on their order.
    """
    order = Window.partitionBy("window_start").orderBy(F.desc("n"), "item")
    ranked = heavy_hitters(counters, TRACKED).withColumn("place", F.row_number().over(order))
    return ranked.filter(F.col("place") <= most).select("window_start", "place", "item", "n")


def session_windows(events: DataFrame, gap: str = "30 minutes") -> DataFrame:
    return events.groupBy("user_id", F.session_window("ts", gap)).agg(F.count("*").alias("points")).select(
        "user_id",
        F.col("session_window.start").alias("session_start"),
        F.col("session_window.end").alias("session_end"),
        "points",
    )


def user_metrics(events: DataFrame) -> DataFrame:
    """Running metrics per user, kept in the state store."""
    return events.groupBy("user_id").agg(
        F.count("*").alias("n"),
        F.sum(F.col("value").cast("decimal(18,2)")).alias("total"),
        F.max("ts").alias("last_seen"),
    )


def rate_breaches(events: DataFrame, limit: int = 10, span: str = "1 minute") -> DataFrame:
    """Users with more than ``limit`` requests in a window; a report, not a gate."""
    return (
        events.groupBy("user_id", F.window("ts", span))
        .agg(F.count("*").alias("requests"))
        .filter(F.col("requests") > limit)
        .select("user_id", F.col("window.start").alias("window_start"), "requests")
    )


def first_copies(events: DataFrame, keys: Sequence[str], watermark: str, ts: str = "ts") -> DataFrame:
    """Drop repeated messages that arrive within the watermark of each other."""
    return events.withWatermark(ts, watermark).dropDuplicatesWithinWatermark(list(keys))


def enriched(events: DataFrame, people: DataFrame, on: str) -> DataFrame:
    """Stream rows with the attributes of a table; small tables broadcast by size."""
    return events.join(people, on, "left")


def matched_streams(
    left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str, within: str, watermark: str
) -> DataFrame:
    """Two streams joined on a key and a time interval; state is bounded by both."""
    a = left.withWatermark(left_ts, watermark).alias("a")
    b = right.withWatermark(right_ts, watermark).alias("b")
    near = (F.col(f"b.{right_ts}") >= F.col(f"a.{left_ts}")) & (
        F.col(f"b.{right_ts}") <= F.col(f"a.{left_ts}") + F.expr(f"INTERVAL {within}")
    )
    return a.join(b, (F.col(f"a.{key}") == F.col(f"b.{key}")) & near)


def late_rows(events: DataFrame, arrival: str, ts: str, allowed: str) -> DataFrame:
    """Batch view of lateness: rows more than ``allowed`` behind their arrival day."""
    late = F.col(ts) < F.col(arrival) - F.expr(f"INTERVAL {allowed}")
    return events.agg(F.count("*").alias("n"), F.count_if(late).alias("too_late"))


# --- sinks ---------------------------------------------------------------------------


def drain(
    stream: DataFrame, label: str, mode: str = "append",
    checkpoint: str | None = None, path: str | None = None,
) -> DataFrame:
    """Process what has landed, append to Parquet, return the rows as a batch table."""
    spark = stream.sparkSession
    path = path or fresh_path(spark, label)
    checkpoint = checkpoint or fresh_path(spark, f"{label}-checkpoint")
    run = (
        stream.writeStream.outputMode(mode)
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    run.awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


def drain_each(
    stream: DataFrame, label: str, step: Callable[[DataFrame, int], None],
    mode: str = "append", checkpoint: str | None = None,
) -> None:
    """Process what has landed with a function per batch."""
    spark = stream.sparkSession
    run = (
        stream.writeStream.outputMode(mode)
        .foreachBatch(step)
        .option("checkpointLocation", checkpoint or fresh_path(spark, f"{label}-checkpoint"))
        .trigger(availableNow=True)
        .start()
    )
    run.awaitTermination()


def append_once(data: Dataset, name: str) -> Callable[[DataFrame, int], None]:
    """Append each batch as one version; a batch id already committed is skipped."""

    def step(batch: DataFrame, batch_id: int) -> None:
        data.append(batch, batch=f"{name}-{batch_id}")

    return step


def upsert_once(
    data: Dataset, name: str, key: Sequence[str], then=None, compact_after: int = 50
):
    """Merge each batch into the dataset by key, then write it to a second sink.

    A batch costs its own size: the table is not rewritten. After ``compact_after``
    pending merges it is compacted. Both sinks know the batch id: the dataset by its
    commit, the second by a folder per batch that a replay overwrites.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        require_unique(batch, key, "batch")
        data.merge(batch, key, batch=f"{name}-{batch_id}")
        if then is not None:
            then(batch, batch_id)
        _fold(data, compact_after)
        batch.unpersist()

    return step


def _fold(data: Dataset, after: int) -> None:
    if len(data.resolve().deletes) >= after:
        data.compact()


def folder_per_batch(path: str) -> Callable[[DataFrame, int], None]:
    def step(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return step


def apply_once(
    data: Dataset, name: str, key: Sequence[str], sequence: str, action: str, compact_after: int = 50
):
    """Merge each batch of change records into the dataset; deletes hide their keys."""

    def step(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        live, gone = last_changes(batch, key, sequence, action)
        data.merge(live, key, removed=gone, batch=f"{name}-{batch_id}")
        _fold(data, compact_after)
        batch.unpersist()

    return step


def spike_alerts(daily: Dataset, alerts: Dataset, keys: Sequence[str], limit: float = 0.3):
    """Add each batch's costs to the daily sums and record days that jumped.

    Only the sums of days in the batch are merged; the alerts are one row per key and
    day and are replaced as a whole.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        at = [*keys, "date"]
        fresh = batch.groupBy(*at).agg(F.sum("cost").cast("decimal(28,2)").alias("cost")).persist()
        known = daily.read().join(fresh.select(*at), at, "left_semi")
        sums = known.unionByName(fresh).groupBy(*at).agg(F.sum("cost").cast("decimal(28,2)").alias("cost"))
        daily.merge(sums, at, batch=f"daily-{batch_id}")
        jumps = daily_spikes(daily.read(), keys, limit).select(*at, "rise")
        alerts.overwrite(jumps, batch=f"alerts-{batch_id}")
        fresh.unpersist()

    return step


def new_only(stream_batch: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Rows of a batch whose key is not known yet, one per key."""
    fresh = stream_batch.join(known.select(key), key, "left_anti")
    return fresh.groupBy(key).agg(F.min(F.struct(*fresh.columns)).alias("_r")).select("_r.*")
