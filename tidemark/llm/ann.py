"""Approximate nearest neighbours by inner product: cross-polytope hashing with multiprobe.

Each table turns the directions of the vectors by three rounds of random signs and a
Hadamard transform and takes the nearest signed axis as the bucket; a query looks into the
axes nearest to it, and all candidates are ranked by exact inner products. Directions tell
nothing of lengths, and a long vector wins at a small cosine, which buckets miss: the rows
far longer than the rest, at most one in ``LONG_ROWS``, are compared with every query.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.prefix import dealt
from tidemark.llm.vectordups import usable
from tidemark.session import cut

LONG_ROWS = 8
BAND = 1.1


def hadamard(x: np.ndarray) -> np.ndarray:
    """Normalised Walsh-Hadamard transform of the rows; their length is a power of two."""
    n, size = x.shape
    step = 1
    while step < size:
        x = x.reshape(n, size // (2 * step), 2, step)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2)
        step *= 2
    return x.reshape(n, size) / np.sqrt(size)


def turned(x: np.ndarray, table: int, seed: int = 11) -> np.ndarray:
    """The pseudo-random rotation of one table."""
    signs = np.random.default_rng([seed, table, x.shape[1]]).choice([-1.0, 1.0], (3, x.shape[1]))
    for s in signs:
        x = hadamard(x * s)
    return x


def directions(x: np.ndarray) -> np.ndarray:
    """The rows over their own lengths, padded to a power of two above their size."""
    out = np.zeros((len(x), 1 << int(x.shape[1]).bit_length()))
    x = x / np.abs(x).max(axis=1)[:, None]  # no square overflows or vanishes
    out[:, : x.shape[1]] = x / np.sqrt((x * x).sum(axis=1))[:, None]
    return out


def axes(y: np.ndarray, probes: int) -> np.ndarray:
    """The ``probes`` nearest signed axes of each row, nearest first: 2 i for +i, 2 i + 1 for -i."""
    signed = np.stack([y, -y], axis=2).reshape(len(y), -1)
    probes = min(probes, signed.shape[1])
    if probes == 1:
        return signed.argmax(axis=1)[:, None]
    some = np.argpartition(-signed, probes - 1, axis=1)[:, :probes]
    order = np.argsort(-np.take_along_axis(signed, some, axis=1), axis=1, kind="stable")
    return np.take_along_axis(some, order, axis=1)


def _best(query: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int):
    """The k best candidates of each query, each id once; ties to the smaller id."""
    order = np.lexsort((-score, ids, query))
    query, ids, score = query[order], ids[order], score[order]
    once = np.append(True, (query[1:] != query[:-1]) | (ids[1:] != ids[:-1]))[: len(query)]
    query, ids, score = query[once], ids[once], score[once]
    order = np.lexsort((ids, -score, query))
    query, ids, score = query[order], ids[order], score[order]
    heads = np.flatnonzero(np.append(True, query[1:] != query[:-1])[: len(query)])
    place = np.arange(len(query)) - np.repeat(heads, np.diff(np.append(heads, len(query))))
    top = place < k
    return query[top], ids[top], score[top]


def buckets(rows: DataFrame, tables: int, probes: int) -> DataFrame:
    """(id, vector, tab, bucket) of vectors: one bucket a table for data, ``probes`` for queries."""

    def run(batches):
        for batch in batches:
            ids, raw = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            by_size: dict[int, list[int]] = {}
            for k, r in enumerate(raw):
                by_size.setdefault(len(r), []).append(k)
            for some in by_size.values():
                for a in range(0, len(some), 2000):
                    mine = some[a : a + 2000]
                    x = directions(np.stack([np.frombuffer(raw[k], np.float64) for k in mine]))
                    near = np.stack([axes(turned(x, t), probes) for t in range(tables)], axis=1)
                    n, _, p = near.shape
                    each = np.repeat(np.arange(n), tables * p)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([ids[k] for k in mine], pa.int64()).take(pa.array(each)),
                            pa.array(np.tile(np.repeat(np.arange(tables, dtype=np.int32), p), n)),
                            pa.array(near.reshape(-1).astype(np.int32)),
                        ],
                        names=["id", "tab", "bucket"],
                    )

    return rows.select("id", "vector").mapInArrow(run, "id long, tab int, bucket int")


def scored(tasks: DataFrame, k: int, most: int = 400_000) -> DataFrame:
    """Exact inner products within each task key; returns the k best of each query that a
    partition has found (query_id, vec_id, score).

    ``tasks``: tab, bucket, part, block, asks (whether the row is a query), id, vector. Equal keys
    come together; between keys only bounded lists of best candidates are held.
    """
    names = ["tab", "bucket", "part", "block", "asks", "id", "vector"]

    def run(batches):
        held: dict = {c: [] for c in names}
        kept: list[tuple] = []
        count = 0
        key = None

        def compare():
            asks = np.array(held["asks"], bool)
            ids = np.array(held["id"], np.int64)
            sizes = np.array([len(v) for v in held["vector"]])
            out = []
            for size in np.unique(sizes[asks]):
                q, d = np.flatnonzero(asks & (sizes == size)), np.flatnonzero(~asks & (sizes == size))
                if not len(d):
                    continue
                x = np.stack([np.frombuffer(held["vector"][i], np.float64) for i in d])
                for a in range(0, len(q), 256):
                    some = q[a : a + 256]
                    score = np.stack([np.frombuffer(held["vector"][i], np.float64) for i in some]) @ x.T
                    score[ids[some][:, None] == ids[d][None, :]] = -np.inf
                    if len(d) > k:
                        bar = np.partition(score, len(d) - k, axis=1)[:, len(d) - k]
                        hit = np.nonzero((score >= bar[:, None]) & (score > -np.inf))
                    else:
                        hit = np.nonzero(score > -np.inf)
                    out.append(_best(ids[some][hit[0]], ids[d][hit[1]], score[hit], k))
            return out

        def batch_of(found):
            return pa.RecordBatch.from_arrays([pa.array(c) for c in found], names=["query_id", "vec_id", "score"])

        def reduce(parts):
            return _best(*(np.concatenate([p[i] for p in parts]) for i in range(3)), k)

        for batch in batches:
            rows = {c: batch.column(i).to_pylist() for i, c in enumerate(names)}
            keys = list(zip(rows["tab"], rows["bucket"], rows["part"], rows["block"]))
            a = 0
            for b in range(1, len(keys) + 1):
                if b < len(keys) and keys[b] == keys[a]:
                    continue
                if keys[a] != key and held["id"]:
                    kept += compare()
                    count = sum(len(p[0]) for p in kept)
                    held = {c: [] for c in names}
                key = keys[a]
                for c in names:
                    held[c].extend(rows[c][a:b])
                a = b
            if count > most:
                kept = [reduce(kept)]
                if len(kept[0][0]) > most // 2:
                    yield batch_of(kept.pop())
                count = sum(len(p[0]) for p in kept)
        if held["id"]:
            kept += compare()
        if kept:
            yield batch_of(reduce(kept))

    rows = dealt(tasks.select(*names), *names[:4]).sortWithinPartitions(*names[:4])
    return rows.mapInArrow(run, "query_id long, vec_id long, score double")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """The k best of each query over all partitions, each id once, ranked from 1."""

    def run(batches):
        kept, last = [], None
        for batch in batches:
            parts = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            if kept:
                parts = [np.concatenate([a, b]) for a, b in zip(kept, parts)]
            last = parts[0][-1] if len(parts[0]) else last
            open_ = parts[0] == last
            kept = [p[open_] for p in parts]
            kept = list(_best(*kept, k)) if len(kept[0]) else kept
            yield ranked(*(p[~open_] for p in parts))
        if kept:
            yield ranked(*kept)

    def ranked(query, ids, score):
        query, ids, score = _best(query, ids, score, k)
        rank = pd.Series(query).groupby(query, sort=False).cumcount().to_numpy() + 1
        return pa.RecordBatch.from_arrays([pa.array(query), pa.array(rank.astype(np.int32)), pa.array(ids), pa.array(score)], names=["query_id", "rank", "vec_id", "score"])

    return found.repartition("query_id").sortWithinPartitions("query_id").mapInArrow(run, "query_id long, rank int, vec_id long, score double")


def loaded(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, vector as doubles, size, band) of the vectors that take part; the lengths of a
    band differ by a factor of at most ``BAND``, and 1 is in the middle of one.
    """

    def band(v: np.ndarray) -> int:
        top = float(np.abs(v).max())
        return int(np.floor((np.log(top) + np.log(np.linalg.norm(v / top))) / np.log(BAND) + 0.5))

    def run(batches):
        for batch in batches:
            found = [(i, usable(v)) for i, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
            found = [(i, v) for i, v in found if v is not None and i is not None]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([i for i, _ in found], pa.int64()),
                    pa.array([(v + 0.0).tobytes() for _, v in found], pa.binary()),
                    pa.array([len(v) for _, v in found], pa.int32()),
                    pa.array([band(v) for _, v in found], pa.int32()),
                ],
                names=["id", "vector", "size", "band"],
            )

    return vectors.select(F.col(key).cast("long"), vector).mapInArrow(run, "id long, vector binary, size int, band int")


def long_rows(rows: DataFrame) -> DataFrame:
    """The rows of the longest bands, as many whole bands as hold at most one row in
    ``LONG_ROWS`` of their vector size. Doubles have about 15,000 bands.
    """
    each = Window.partitionBy("size")
    down = each.orderBy(F.desc("band")).rowsBetween(Window.unboundedPreceding, 0)
    bands = rows.groupBy("size", "band").agg(F.count(F.lit(1)).alias("n"))
    bands = bands.withColumn("upto", F.sum("n").over(down)).withColumn("all", F.sum("n").over(each))
    return rows.join(bands.filter(F.col("upto") * LONG_ROWS <= F.col("all")).select("size", "band"), ["size", "band"])


def nearest(
    vectors: DataFrame, queries: Callable[[Column], Column], k: int = 20, key: str = "vec_id", vector: str = "embedding", tables: int = 6, probes: int = 40, part_rows: int = 2048
) -> DataFrame:
    """query_id, rank from 1, vec_id, score: the k nearest found of each row that ``queries``
    (a condition on the key) holds for, by inner product in double precision.

    A row is no candidate of its own id; ties go to the smaller id. Vectors that are null,
    empty, zero or hold null or non-finite components take no part, nor do rows without a
    key; vectors of other lengths than the query's are no candidates. Of rows that repeat
    a key, a query's result has that key once, with its best score; repeated query rows are
    one query if they are equal. A query whose buckets hold fewer than k candidates is
    compared with all rows, in blocks; so is every query with the rows of ``long_rows``,
    whose inner products are large at small cosines.

    Recall grows with ``tables`` and ``probes`` (of twice the padded length buckets); the
    defaults are for neighbours with a cosine around 0.4, and nearer ones are found more
    surely. A bucket is compared in parts of about ``part_rows`` rows, each with blocks of about
    ``part_rows`` of the queries that look into it.
    """
    rows = cut(loaded(vectors, key, vector))
    if rows.isEmpty():
        return rows.select(F.col("id").alias("query_id"), F.lit(0).alias("rank"), F.col("id").alias("vec_id"), F.lit(0.0).alias("score")).limit(0)
    asked = cut(rows.filter(queries(F.col("id"))).select("id", "vector").distinct())
    data = buckets(rows, tables, 1)
    looks = buckets(asked, tables, probes)
    many = lambda some, name: some.groupBy("tab", "bucket").agg(F.ceil(F.count(F.lit(1)) / part_rows).cast("int").alias(name))
    piece = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    sizes = cut(many(data, "parts").join(many(looks, "blocks"), ["tab", "bucket"]))
    split = data.join(sizes, ["tab", "bucket"]).withColumn("part", piece("parts")).withColumn("block", every("blocks"))
    spread = looks.join(sizes, ["tab", "bucket"]).withColumn("block", piece("blocks")).withColumn("part", every("parts"))
    columns = ["tab", "bucket", "part", "block", "asks", "id"]
    narrow_data = split.withColumn("asks", F.lit(False)).select(*columns).join(rows.select("id", "vector"), "id")
    narrow_looks = spread.withColumn("asks", F.lit(True)).select(*columns).join(asked, "id")
    long = cut(long_rows(rows).select("id", "vector"))
    tasks = narrow_data.unionByName(narrow_looks)
    if not long.isEmpty():
        tasks = tasks.unionByName(against(long, asked, part_rows))
    first = cut(scored(tasks, k))
    got = first.groupBy("query_id").agg(F.count_distinct("vec_id").alias("n"))
    short = cut(asked.join(got.withColumnRenamed("query_id", "id"), "id", "left").filter(F.coalesce("n", F.lit(0)) < k).select("id", "vector"))
    if not short.isEmpty():
        first = first.unionByName(scored(against(rows, short, part_rows), k))
    return _ranked(first, k)


def against(rows: DataFrame, asked: DataFrame, part_rows: int) -> DataFrame:
    """Tasks for ``scored``: all rows against the asked ones, in blocks of both."""
    n = asked.count()
    blocks = max(1, -(-n // part_rows))
    parts = max(1, -(-rows.count() // part_rows))
    piece = lambda many: F.pmod(F.xxhash64("id"), F.lit(many)).cast("int")
    every = lambda many: F.explode(F.sequence(F.lit(0), F.lit(many - 1)))
    data = rows.select("id", "vector", piece(parts).alias("part"), every(blocks).alias("block")).withColumn("asks", F.lit(False))
    looks = asked.select("id", "vector", piece(blocks).alias("block"), every(parts).alias("part")).withColumn("asks", F.lit(True))
    return data.unionByName(looks).withColumn("tab", F.lit(-1)).withColumn("bucket", F.lit(0))
