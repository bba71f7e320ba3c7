"""Streaks of days from keyed state: equal to plain Python, ended after idle days, kept over a restart."""

import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.streaming import state as ST
from tidemark.streaming import streams as S

START = datetime(2024, 1, 1)
DAYS = {1: [0, 1, 2, 5, 6], 2: [0], 3: [0, 3, 4, 20, 21, 22], 4: [21]}


def land(spark, path, low, high):
    rows = [(u * 100 + d, START + timedelta(days=d, hours=u), u, "view", 1.0, "{}") for u, ds in DAYS.items() for d in ds if low <= d < high]
    rows.append((9, START + timedelta(days=high - 1), None, "view", 1.0, "{}"))
    spark.createDataFrame(rows, S.EVENT.replace("timestamp_ntz", "timestamp")).withColumn(
        "ts", F.col("ts").cast("timestamp_ntz")
    ).coalesce(1).write.mode("append").parquet(path)
    time.sleep(1.1)


def streak_of(days):
    longest = run = 0
    for k, d in enumerate(days):
        run = run + 1 if k and days[k - 1] == d - 1 else 1
        longest = max(longest, run)
    return run, longest


@pytest.fixture(scope="module")
def told(spark, tmp_path_factory):
    path, out, check = (str(tmp_path_factory.mktemp("streaks") / n) for n in ("in", "out", "check"))
    land(spark, path, 0, 4)
    run = lambda: S.drain(ST.streaks(S.landed(spark, path), "1 day", idle_days=5), "t", checkpoint=check, path=out)
    first = run().collect()
    land(spark, path, 4, 10)  # a restart: state comes from the checkpoint
    second = run().collect()
    land(spark, path, 20, 23)
    return first, second, run().collect()


def test_last_rows_equal_plain_python(told):
    first, second, third = told
    for rows, until in ((first, 4), (second, 10)):
        for u, days in DAYS.items():
            seen = [d for d in days if d < until]
            mine = [r for r in rows if r.user_id == u and not r.ended]
            assert bool(mine) == bool(seen)
            if seen:
                best = max(mine, key=lambda r: r.n)
                assert (best.day - 19723, (best.streak, best.longest), best.n) == (seen[-1], streak_of(seen), len(seen))
    assert {r.user_id for r in third} == set(DAYS)


def test_idle_users_end_and_start_anew(told):
    _, second, third = told
    ended = {(r.user_id, r.day - 19723) for r in third if r.ended}
    assert {(1, 6), (2, 0), (3, 4)} <= ended and not {u for u, _ in ended} & {4}
    after = [r for r in third if r.user_id == 3 and not r.ended]
    assert max(after, key=lambda r: r.day)[1:5] == (19723 + 22, 3, 3, 3)
