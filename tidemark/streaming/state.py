"""Keyed state of any shape in a stream, with timers that let it go: streaks of days per user.

Built-in aggregates keep one running value and keep it for ever. Here each user has a
streak of active days, an idle user is reported and forgotten after a while of event time,
and both survive a restart with the state store.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

DAY_MS = 86_400_000
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STREAKS = "user_id long, day int, streak int, longest int, n long, ended boolean"


def keeps_state(spark: SparkSession) -> None:
    """The state store that such processors need."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)


class Streaks(StatefulProcessor):
    """Days in a row on which a user was active.

    Emits the user's state whenever a batch has rows of it, and once more with ``ended``
    when ``idle_days`` whole days without a row have passed after the last active one; then
    the state is gone, and a later row starts anew, whatever the batches. ``day`` (days since 1970) is the last active one. Rows before it count in
    ``n`` only, as the days already told cannot be changed.
    """

    def __init__(self, idle_days: int):
        self.idle_days = idle_days

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("streak", "day int, streak int, longest int, n long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        day, streak, longest, n = self.state.get() if self.state.exists() else (None, 0, 0, 0)
        counts: Counter = Counter()
        for part in rows:
            counts.update(part["day"].astype(int).tolist())
        for one in sorted(counts):
            if day is not None and one > day + self.idle_days:
                # The timer may not have run before these rows; the result is the same.
                yield self._row(key, day, streak, longest, n, True)
                day, streak, longest, n = None, 0, 0, 0
            n += counts[one]
            if day is not None and one <= day:
                continue
            streak = streak + 1 if day is not None and one == day + 1 else 1
            day, longest = one, max(longest, streak)
        self.state.update((day, streak, longest, n))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer((day + 1 + self.idle_days) * DAY_MS)
        yield self._row(key, day, streak, longest, n, False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.state.exists():
            row = self._row(key, *self.state.get(), True)
            self.state.clear()
            yield row

    def close(self) -> None:
        pass

    @staticmethod
    def _row(key, day, streak, longest, n, ended) -> pd.DataFrame:
        return pd.DataFrame({"user_id": [key[0]], "day": [day], "streak": [streak], "longest": [longest], "n": [n], "ended": [ended]})


def streaks(events: DataFrame, delay: str, idle_days: int, ts: str = "ts") -> DataFrame:
    """The streaks of each user of a stream, by event time: see Streaks.

    ``delay`` is the watermark's. A session without the right state store is set to it.
    Rows without a user or a time are left out.
    """
    keeps_state(events.sparkSession)
    rows = events.filter(F.col("user_id").isNotNull() & F.col(ts).isNotNull()).withWatermark(ts, delay)
    dated = rows.select("user_id", ts, F.unix_date(F.to_date(ts)).alias("day"))
    return dated.groupBy("user_id").transformWithStateInPandas(
        statefulProcessor=Streaks(idle_days), outputStructType=STREAKS, outputMode="Append", timeMode="EventTime"
    )


def last_streaks(told: DataFrame) -> DataFrame:
    """What the stream last told of each user: user_id, day, longest, n, before any end."""
    best = told.filter(~F.col("ended")).groupBy("user_id").agg(F.max(F.struct("n", "day", "streak", "longest")).alias("s"))
    return best.select("user_id", "s.day", "s.streak", "s.longest", "s.n")
