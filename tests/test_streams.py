"""Streams over files in event-time order, against their batch twins."""

import time
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.operators.versions import Dataset
from tidemark.streaming import streams as S

DELAY = "7 days"


@pytest.fixture(scope="module")
def landing(spark, sf, tmp_path_factory):
    """Three files of ten days each, oldest first."""
    path = str(tmp_path_factory.mktemp("landing") / "events")
    rows = spark.read.parquet(f"{sf}/events.parquet")
    for a, b in ((1, 11), (11, 21), (21, 32)):
        part = rows.filter((F.dayofmonth("ts") >= a) & (F.dayofmonth("ts") < b))
        part.coalesce(1).write.mode("append").parquet(path)
        time.sleep(1.1)
    return path


def stream(spark, landing):
    return S.landed(spark, landing, files_per_batch=1)


def same(a, b):
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_closed_windows_equal_batch(spark, landing, sf):
    batch = S.hourly_health(S.zoned(spark.read.parquet(f"{sf}/events.parquet")))
    newest = spark.read.parquet(f"{sf}/events.parquet").agg(F.max("ts")).first()[0]
    got = S.drain(S.hourly_health(stream(spark, landing).withWatermark("ts", DELAY)), "t")
    closed = batch.filter(F.col("window_end") <= F.lit(newest).cast("timestamp") - F.expr("INTERVAL 7 DAYS"))
    assert 0 < got.count() < batch.count()
    same(got.drop("users_about"), closed.drop("users_about"))


def test_dedup_and_metrics_over_batches(spark, landing, sf):
    rows = spark.read.parquet(f"{sf}/events.parquet")
    sent = stream(spark, landing).withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2))))
    kept = S.drain(S.first_copies(sent, ["event_id"], DELAY).select("event_id"), "t")
    assert kept.count() == rows.count() == kept.distinct().count()
    data = Dataset(spark, S.fresh_path(spark, "m"))
    batch = S.user_metrics(S.zoned(rows))
    data.create(batch.schema)
    step = S.upsert_once(data, "m", ["user_id"])

    def replayed(df, n):
        step(df, n)
        step(df, n)

    S.drain_each(S.user_metrics(stream(spark, landing)), "m", replayed, mode="update")
    same(data.read(), batch)
    assert data.head() == 3  # one version per batch, replays add none


def test_restart_continues(spark, landing, sf, tmp_path):
    """Two files first, then a stop, then the third on the same checkpoint."""
    import glob
    import shutil

    files = sorted(glob.glob(f"{landing}/*.parquet"), key=lambda f: __import__("os").path.getmtime(f))
    inbox = tmp_path / "in"
    inbox.mkdir()
    data = Dataset(spark, str(tmp_path / "d"))
    events = spark.read.parquet(f"{sf}/events.parquet").select("event_id")
    data.create(events.schema)
    check = str(tmp_path / "c")
    for part in (files[:2], files[2:]):
        for f in part:
            shutil.copy(f, inbox)
        S.drain_each(S.landed(spark, str(inbox)).select("event_id"), "r", S.append_once(data, "r"), checkpoint=check)
    same(data.read(), events)


def test_late_rows_are_dropped_and_counted(spark, tmp_path):
    path = str(tmp_path / "late")
    def write(rows):
        df = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz")
        df.withColumns({"user_id": F.lit(1).cast("long"), "event_type": F.lit("view"), "value": F.lit(1.0), "props": F.lit("{}")}).select(
            "event_id", "ts", "user_id", "event_type", "value", "props"
        ).coalesce(1).write.mode("append").parquet(path)
        time.sleep(1.1)

    T = datetime.fromisoformat
    write([(1, T("2024-01-01 00:10")), (2, T("2024-01-20 00:10"))])
    write([(3, T("2024-01-14 00:10")), (5, T("2024-01-25 00:10"))])
    # Lateness is judged by the watermark of the batch before.
    write([(4, T("2024-01-02 00:10")), (6, T("2024-02-20 00:10"))])
    out = S.drain(S.hourly_health(stream(spark, path).withWatermark("ts", DELAY)), "late")
    starts = sorted(r.window_start.day for r in out.collect())
    assert starts == [1, 14, 20, 25]  # six days late is kept, eighteen is not
    rows = spark.createDataFrame([(T("2024-01-01"), T("2024-01-10")), (T("2024-01-05"), T("2024-01-10"))], "ts timestamp, at timestamp")
    assert S.late_rows(rows, "at", "ts", "7 DAYS").first().too_late == 1


def test_change_stream_and_sessions(spark, landing, sf):
    target = spark.createDataFrame([(i, 0.0) for i in range(200)], "user_id long, value double")
    data = Dataset(spark, S.fresh_path(spark, "t"))
    data.append(target)
    act = F.when(F.col("event_type") == "error", "DELETE").otherwise("UPDATE").alias("act")
    log = stream(spark, landing).select("user_id", "value", "event_id", act)
    S.drain_each(log, "t", S.apply_once(data, "t", ["user_id"], "event_id", "act"))
    rows = spark.read.parquet(f"{sf}/events.parquet").select("user_id", "value", "event_id", act)
    from tidemark.operators.changes import apply_changes

    # Per batch the last change wins, so the final state equals one batch over all.
    same(data.read(), apply_changes(target, rows, ["user_id"], "event_id", "act"))
    sess = S.session_windows(S.zoned(spark.read.parquet(f"{sf}/events.parquet")))
    assert sess.agg(F.sum("points")).first()[0] == rows.count()


def test_a_table_in_one_file_and_as_a_folder(spark, tmp_path):
    from tidemark.plans import catalog

    docs = spark.createDataFrame([(i, f" Text {i % 7}") for i in range(40)], "doc_id long, text string")
    folder, single = str(tmp_path / "folder"), str(tmp_path / "single")
    docs.repartition(4).write.parquet(f"{folder}/documents.parquet")
    docs.coalesce(1).write.parquet(f"{single}/whole")
    (part,) = (tmp_path / "single" / "whole").glob("part-*.parquet")
    part.rename(tmp_path / "single" / "documents.parquet")
    for path in (folder, single):
        assert S.landed(spark, path, docs.schema, "documents.parquet", ts=None).isStreaming
        assert catalog.QUERIES["incremental_dedup"](spark, path).first().kept == 7
