"""Time series in packed blocks: delta-of-delta times and delta values in as few bits as they need.

A block is a row of up to ``POINTS`` points of one series with a directory (first and last
time, number of points, least and largest value), so that Parquet and Spark prune blocks by
time and only those that a query touches are decoded.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

POINTS = 1024
CENTS, BITS = 0, 1


def zigzag(x: np.ndarray) -> np.ndarray:
    return ((x << 1) ^ (x >> 63)).view(np.uint64)


def unzigzag(z: np.ndarray) -> np.ndarray:
    return ((z >> np.uint64(1)) ^ (np.uint64(0) - (z & np.uint64(1)))).view(np.int64)


def pack(z: np.ndarray) -> bytes:
    """One byte for the width, then each number in that many bits."""
    width = int(z.max()).bit_length() if len(z) else 0
    if not width:
        return b"\x00"
    each = (z[:, None] >> np.arange(width, dtype=np.uint64)) & np.uint64(1)
    return bytes([width]) + np.packbits(each.astype(np.uint8).reshape(-1)).tobytes()


def unpack(raw: bytes, n: int) -> np.ndarray:
    width = raw[0]
    if not width or not n:
        return np.zeros(n, np.uint64)
    each = np.unpackbits(np.frombuffer(raw, np.uint8, offset=1), count=n * width).reshape(n, width)
    return (each.astype(np.uint64) << np.arange(width, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)


def _headed(first: np.ndarray, rest: np.ndarray) -> bytes:
    """The first number whole, as it would widen all the others; then the packed rest."""
    return first[:1].tobytes() + pack(rest)


def pack_times(t: np.ndarray) -> bytes:
    """The first difference, then differences of differences; the first time is in the directory."""
    steps = np.diff(t)
    return _headed(steps, zigzag(np.diff(steps))) if len(steps) else b""


def unpack_times(raw: bytes, first: int, n: int) -> np.ndarray:
    steps = np.zeros(n, np.int64)
    if n > 1:
        steps[1:] = np.frombuffer(raw, np.int64, 1)
        steps[2:] += np.cumsum(unzigzag(unpack(raw[8:], n - 2)))
    return np.int64(first) + np.cumsum(steps)


def pack_values(v: np.ndarray, null: np.ndarray) -> bytes:
    """Hundredths as differences where they give every value back, else XORs of the doubles."""
    mask = np.packbits(null).tobytes() if null.any() else b""
    head = bytes([1 if mask else 0]) + mask
    v = v[~null]
    if not len(v):
        return head
    with np.errstate(over="ignore", invalid="ignore"):
        scaled = np.round(v * 100)
        cents = np.where(np.abs(scaled) < 1 << 53, scaled, 0).astype(np.int64)
    if np.array_equal((cents / 100).view(np.int64), v.view(np.int64)):
        return head + bytes([CENTS]) + _headed(cents, zigzag(np.diff(cents)))
    bits = v.view(np.uint64)
    return head + bytes([BITS]) + _headed(bits, bits[1:] ^ bits[:-1])


def unpack_values(raw: bytes, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The values (0 where null) and the null mask."""
    at = 1
    null = np.zeros(n, bool)
    if raw[0]:
        size = -(-n // 8)
        null = np.unpackbits(np.frombuffer(raw, np.uint8, size, 1), count=n).astype(bool)
        at += size
    some = int(n - null.sum())
    out = np.zeros(n)
    if some:
        kind, first, rest = raw[at], raw[at + 1 : at + 9], unpack(raw[at + 9 :], some - 1)
        if kind == CENTS:
            out[~null] = np.cumsum(np.append(np.frombuffer(first, np.int64), unzigzag(rest))) / 100
        else:
            out[~null] = np.bitwise_xor.accumulate(np.append(np.frombuffer(first, np.uint64), rest)).view(np.float64)
    return out, null


def _block(t: np.ndarray, v: np.ndarray, null: np.ndarray) -> tuple:
    some = v[~null]
    numbers = some[~np.isnan(some)]
    ends = (float(numbers.min()), float(numbers.max())) if len(numbers) else (None, None)
    return int(t[0]), int(t[-1]), len(t), *ends, pack_times(t), pack_values(v, null)


def _fields(series: T.DataType, time: T.DataType) -> T.StructType:
    ends = [T.StructField("first_ts", time), T.StructField("last_ts", time)]
    rest = T.StructType.fromDDL("points int, least double, most double, times binary, readings binary")
    return T.StructType([T.StructField("series", series), *ends, *rest.fields])


def packed(df: DataFrame, series: str, ts: str, value: str, points: int = POINTS) -> DataFrame:
    """(series, first_ts, last_ts, points, least, most, times, readings): the blocks of all series.

    Rows are dealt by ranges of (series, time), so a series of any size is packed by many
    tasks; a task holds one open block. Doubles come back bit for bit, NULL, NaN and -0.0
    included; ``least`` and ``most`` leave NULL and NaN out. Equal times stay as separate
    points, smaller values first. A NULL series is a series; points without a time are left out.
    """
    rows = df.filter(F.col(ts).isNotNull()).select(F.col(series).alias("series"), F.col(ts).alias("at"), F.col(value).cast("double").alias("value"))
    order = ["series", "at", "value"]
    schema = _fields(rows.schema["series"].dataType, rows.schema["at"].dataType)

    def run(batches):
        held: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None
        name: object = None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column(0)
            codes = keys.dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
            heads = np.flatnonzero(np.append(True, codes[1:] != codes[:-1]))
            null = np.array(batch.column(2).is_null())
            times = batch.column(1)
            columns = (times.cast(pa.int64()).to_numpy(), batch.column(2).fill_null(0.0).to_numpy(), null)
            done: list[tuple] = []
            for a, b in zip(heads, np.append(heads[1:], len(codes))):
                mine = tuple(c[a:b] for c in columns)
                key = keys[int(a)].as_py()
                if held is not None and key == name:
                    mine = tuple(np.concatenate(pair) for pair in zip(held, mine))
                elif held is not None:
                    done.append((name, *_block(*held)))
                name, n = key, len(mine[0])
                whole = (n - 1) // points * points  # the last block stays open
                done += [(name, *_block(*(c[k : k + points] for c in mine))) for k in range(0, whole, points)]
                held = tuple(c[whole:] for c in mine)
            if done:
                yield _batch(done, keys.type, times.type)
        if held is not None:
            yield _batch([(name, *_block(*held))], keys.type, times.type)

    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return dealt.mapInArrow(run, schema).withColumnRenamed("series", series)


def _batch(blocks: list[tuple], kind: pa.DataType, time: pa.DataType) -> pa.RecordBatch:
    kinds = [kind, pa.int64(), pa.int64(), pa.int32(), pa.float64(), pa.float64(), pa.binary(), pa.binary()]
    names = ["series", "first_ts", "last_ts", "points", "least", "most", "times", "readings"]
    columns = [pa.array(c, k) for c, k in zip(zip(*blocks), kinds)]
    columns[1:3] = [c.cast(time) for c in columns[1:3]]
    return pa.RecordBatch.from_arrays(columns, names=names)


def unpacked(blocks: DataFrame, series: str, ts: str = "ts", value: str = "value") -> DataFrame:
    """(series, ts, value): the points of the given blocks."""
    time = blocks.schema["first_ts"].dataType
    schema = T.StructType([T.StructField("series", blocks.schema[series].dataType), T.StructField("at", time), T.StructField("value", T.DoubleType())])

    def run(batches):
        for batch in batches:
            firsts = batch.column(1).cast(pa.int64()).to_pylist()
            for k, first in enumerate(firsts):
                n, times, readings = (batch.column(c)[k].as_py() for c in range(2, 5))
                found, null = unpack_values(readings, n)
                key = batch.column(0).take(pa.array(np.full(n, k)))
                at = pa.array(unpack_times(times, first, n)).cast(batch.column(1).type)
                yield pa.RecordBatch.from_arrays([key, at, pa.array(found, mask=null)], names=["series", "at", "value"])

    points = blocks.select(F.col(series).alias("series"), "first_ts", "points", "times", "readings").mapInArrow(run, schema)
    return points.select(F.col("series").alias(series), F.col("at").alias(ts), F.col("value").alias(value))


def _bounds(blocks: DataFrame, start: datetime, end: datetime) -> tuple[Column, Column]:
    kind = blocks.schema["first_ts"].dataType
    return F.lit(start).cast(kind), F.lit(end).cast(kind)


def touched(blocks: DataFrame, start: datetime, end: datetime) -> DataFrame:
    """The blocks that may hold points of [start, end): by the directory, pushed to the scan."""
    lo, hi = _bounds(blocks, start, end)
    return blocks.filter((F.col("last_ts") >= lo) & (F.col("first_ts") < hi))


def packed_range(blocks: DataFrame, series: str, start: datetime, end: datetime, keep: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """The points of [start, end); ``keep`` may narrow the blocks first, as by series or value bounds."""
    lo, hi = _bounds(blocks, start, end)
    some = touched(blocks, start, end)
    points = unpacked(keep(some) if keep else some, series)
    return points.filter((F.col("ts") >= lo) & (F.col("ts") < hi))


def range_totals(blocks: DataFrame, series: str, start: datetime, end: datetime) -> DataFrame:
    """(series, points, least, most) of [start, end): blocks inside are answered by the directory,
    only those that cross an end are decoded. NULL and NaN values count as points alone.
    """
    lo, hi = _bounds(blocks, start, end)
    inside = (F.col("first_ts") >= lo) & (F.col("last_ts") < hi)
    some = touched(blocks, start, end)
    whole = some.filter(inside).select(series, "points", "least", "most")
    number = F.when(~F.isnan("value"), F.col("value"))
    edge = packed_range(blocks, series, start, end, lambda b: b.filter(~inside))
    edge = edge.select(series, F.lit(1).alias("points"), number.alias("least"), number.alias("most"))
    return whole.unionByName(edge).groupBy(series).agg(F.sum("points").alias("points"), F.min("least").alias("least"), F.max("most").alias("most"))
