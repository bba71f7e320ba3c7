"""Vector search through an inverted file: vectors lie by cell, questions look into few cells.

Cells are the k-means centres of a bounded sample. Vectors are written by the cell of
their nearest centre, so a search reads only the folders of the cells it looks into. How
far a cell reaches from its centre is kept, which tells the cells that can be left out
without losing a hit.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.ranking import top_n_per_group
from tidemark.session import cut, fresh_path

PART_ROWS = 4096
BLOCK_QUESTIONS = 1024
SLACK = 1e-9


@dataclass(frozen=True)
class CellIndex:
    """Where the vectors lie, the unit centres, and of each cell its rows and widest cosine."""

    path: str
    ident: str
    centers: np.ndarray
    rows: np.ndarray
    reach: np.ndarray
    category: bool
    schema: str

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(T.StructType.fromJson(json.loads(self.schema))).parquet(self.path)


def _units(batch: pa.RecordBatch, column: int, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """The rows with a usable vector of ``dims`` numbers, and their unit vectors."""
    values = batch.column(column)
    lengths = pc.fill_null(pc.list_value_length(values), 0).to_numpy(zero_copy_only=False)
    some = np.flatnonzero(lengths == dims)
    x = values.take(pa.array(some)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(some), dims)
    peak = np.abs(x).max(axis=1) if len(some) else np.empty(0)
    fine = np.isfinite(peak) & (peak > 0)
    x = x[fine] / peak[fine, None]
    return some[fine], x / np.linalg.norm(x, axis=1, keepdims=True)


def fit_centers(vectors: DataFrame, column: str, dims: int, cells: int, sample_rows: int = 50_000, rounds: int = 10, seed: int = 7) -> np.ndarray:
    """Unit centres of at most ``cells`` groups, by spherical k-means on a sample.

    The sample has about ``sample_rows`` rows, chosen by a hash of the vector (all, if there
    are fewer), and is all that reaches the driver.
    """
    usable = vectors.select(F.col(column).cast("array<double>").alias("v")).filter(F.size("v") == dims)
    total = usable.count()
    share = min(1.0, sample_rows / max(1, total))
    chosen = usable.filter(F.pmod(F.xxhash64(F.lit(seed), "v"), F.lit(1 << 30)) < int(share * (1 << 30)) + 1)
    rows = chosen.limit(2 * sample_rows).toArrow()
    batch = pa.RecordBatch.from_arrays([rows["v"].combine_chunks()], names=["v"]) if rows.num_rows else None
    x = np.unique(_units(batch, 0, dims)[1], axis=0) if batch else np.empty((0, dims))
    if not len(x):
        return np.eye(1, dims)
    rng = np.random.default_rng(seed)
    cells = min(cells, len(x))
    centers = x[rng.choice(len(x), cells, replace=False)]
    for _ in range(rounds):
        near = (x @ centers.T).argmax(axis=1)
        sums = np.zeros_like(centers)
        np.add.at(sums, near, x)
        norms = np.linalg.norm(sums, axis=1)
        # A cell that lost all its rows starts anew somewhere.
        lost = norms < 1e-12
        sums[lost], norms[lost] = x[rng.choice(len(x), int(lost.sum()))], 1.0
        centers = sums / norms[:, None]
    return centers


def build_cells(
    vectors: DataFrame, ident: str, column: str, dims: int, cells: int | None = None, category: str | None = None, sample_rows: int = 50_000
) -> CellIndex:
    """Writes the vectors by cell and returns the index; by default about sqrt(rows) cells.

    Null, zero and non-finite vectors, those of other lengths, and rows without ident are
    left out. A cell of any size is cut into files of about ``PART_ROWS`` rows by a hash of
    the ident.
    """
    spark = vectors.sparkSession
    if cells is None:
        cells = max(1, min(int(vectors.count() ** 0.5), sample_rows // 8))
    centers = fit_centers(vectors, column, dims, cells, sample_rows)
    shared = spark.sparkContext.broadcast(centers)
    plain = vectors.filter(F.col(ident).isNotNull()).select(
        F.col(ident).alias("ident"), (F.col(category).cast("string") if category else F.lit(None).cast("string")).alias("category"),
        F.col(column).cast("array<double>").alias("v"),
    )
    schema = T.StructType([*plain.schema.fields[:2], *T.StructType.fromDDL("unit array<double>, cell int, near double").fields])

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            some, x = _units(batch, 2, dims)
            scores = x @ shared.value.T
            cell = scores.argmax(axis=1)
            near = scores[np.arange(len(cell)), cell]
            offsets = pa.array(np.arange(len(some) + 1, dtype=np.int32) * dims)
            rows = batch.take(pa.array(some))
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), rows.column(1), pa.ListArray.from_arrays(offsets, pa.array(x.reshape(-1))), pa.array(cell.astype(np.int32)), pa.array(near)],
                names=["ident", "category", "unit", "cell", "near"],
            )

    placed = cut(plain.mapInArrow(assign, schema))
    counts = placed.groupBy("cell").agg(F.count("*").alias("n"), F.min("near").alias("reach")).collect()  # a row a cell
    rows, reach = np.zeros(len(centers), np.int64), np.ones(len(centers))
    for r in counts:
        rows[r["cell"]], reach[r["cell"]] = r["n"], r["reach"]
    parts = spark.createDataFrame([(r["cell"], max(1, -(-r["n"] // PART_ROWS))) for r in counts], "cell int, parts long")
    path = fresh_path(spark, "cells")
    part = F.pmod(F.xxhash64(F.lit(5), "ident"), F.col("parts")).cast("int").alias("part")
    laid = placed.join(F.broadcast(parts), "cell").select("ident", "category", "unit", part, "cell")
    tasks = int(min(max(spark.sparkContext.defaultParallelism, rows.sum() // PART_ROWS), 10_000))
    laid.repartition(tasks, "cell", "part").sortWithinPartitions("cell", "part").write.partitionBy("cell").parquet(path)
    return CellIndex(path, ident, centers, rows, reach, category is not None, laid.schema.json())


def _asked(index: CellIndex, questions: DataFrame, question: str, column: str, category: str | None) -> DataFrame:
    """(question, category, unit) of the usable questions."""
    dims = index.centers.shape[1]
    plain = questions.filter(F.col(question).isNotNull()).select(
        F.col(question).alias("question"), (F.col(category).cast("string") if category else F.lit(None).cast("string")).alias("category"),
        F.col(column).cast("array<double>").alias("v"),
    )

    def units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            some, x = _units(batch, 2, dims)
            rows = batch.take(pa.array(some))
            offsets = pa.array(np.arange(len(some) + 1, dtype=np.int32) * dims)
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), rows.column(1), pa.ListArray.from_arrays(offsets, pa.array(x.reshape(-1)))], names=["question", "category", "unit"]
            )

    schema = T.StructType([*plain.schema.fields[:2], T.StructField("unit", T.ArrayType(T.DoubleType()))])
    return cut(plain.mapInArrow(units, schema))


def _probes(index: CellIndex, asked: DataFrame, probes: int, beyond: DataFrame | None = None) -> DataFrame:
    """(question, category, unit, cell): the ``probes`` nearest filled cells of each question; with
    ``beyond`` (question, floor) the other cells that may hold a hit above the floor.

    A vector of a cell is no nearer to a question than the angle to the centre less the
    widest angle within the cell allows.
    """
    shared = asked.sparkSession.sparkContext.broadcast(index)
    rows = asked.join(beyond, "question") if beyond is not None else asked.withColumn("floor", F.lit(None).cast("double"))
    dims, second = index.centers.shape[1], beyond is not None

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = shared.value
        filled = np.flatnonzero(one.rows)
        few = min(probes, len(filled))
        for batch in batches:
            if not batch.num_rows or not len(filled):
                continue
            x = batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
            scores = np.clip(x @ one.centers[filled].T, -1, 1)
            order = np.argsort(-scores, axis=1, kind="stable")
            chosen = np.zeros(scores.shape, bool)
            np.put_along_axis(chosen, order[:, :few], True, axis=1)
            if second:
                angle = np.arccos(scores) - np.arccos(np.clip(one.reach[filled], -1, 1))[None, :]
                floor = batch.column(3).fill_null(-2.0).to_numpy(zero_copy_only=False)
                chosen = ~chosen & (np.cos(np.maximum(angle, 0)) + SLACK >= floor[:, None])
            q, c = np.nonzero(chosen)
            picked = batch.take(pa.array(q))
            yield pa.RecordBatch.from_arrays([*picked.columns[:3], pa.array(filled[c].astype(np.int32))], names=["question", "category", "unit", "cell"])

    schema = T.StructType([*asked.schema.fields, T.StructField("cell", T.IntegerType())])
    return rows.select(*asked.columns, "floor").mapInArrow(choose, schema)


def _matched(index: CellIndex, probed: DataFrame, k: int, inside: bool) -> DataFrame:
    """(question, ident, similarity): the k best of each question within each part of a cell.

    A part of a cell meets a block of its questions, in one group of bounded size.
    """
    spark = probed.sparkSession
    probed = cut(probed)
    per = probed.groupBy("cell").agg(F.ceil(F.count("*") / BLOCK_QUESTIONS).cast("int").alias("blocks"))
    parts = spark.createDataFrame(
        [(int(c), int(max(1, -(-n // PART_ROWS)))) for c, n in enumerate(index.rows) if n], "cell int, parts int"
    )
    sizes = cut(per.join(parts, "cell"))  # a row a cell
    block = F.pmod(F.xxhash64(F.lit(3), "question"), F.col("blocks")).cast("int")
    asks = probed.join(F.broadcast(sizes), "cell").withColumn("block", block)
    asks = asks.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select("cell", "part", "block", "question", "category", "unit")
    held = index.read(spark).join(F.broadcast(sizes.select("cell", "blocks")), "cell")
    held = held.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select("cell", "part", "block", "ident", "category", "unit")
    kinds = {"question": dict(probed.dtypes)["question"], "ident": dict(held.dtypes)["ident"]}

    def best(left: pa.Table, right: pa.Table) -> pa.Table:
        schema = pa.schema([("question", left.schema.field("question").type), ("ident", right.schema.field("ident").type), ("similarity", pa.float64())])
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        right = right.take(pc.sort_indices(right["ident"]))
        matrix = lambda t: t["unit"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(t.num_rows, -1)
        scores = matrix(left) @ matrix(right).T
        if inside:
            names = pd.factorize(np.array(left["category"].to_pylist() + right["category"].to_pylist(), object))[0]
            mine, theirs = names[: left.num_rows, None], names[None, left.num_rows :]
            scores = np.where((mine == theirs) & (mine >= 0), scores, -np.inf)
        few = min(k, scores.shape[1])
        order = np.argsort(-scores, axis=1, kind="stable")[:, :few]
        q = np.repeat(np.arange(len(scores)), few)
        found = scores[q, order.reshape(-1)]
        good = found > -np.inf
        return pa.Table.from_arrays(
            [left["question"].take(pa.array(q[good])), right["ident"].take(pa.array(order.reshape(-1)[good])), pa.array(found[good])], schema=schema
        )

    keys = ["cell", "part", "block"]
    met = asks.groupBy(*keys).cogroup(held.groupBy(*keys))
    return met.applyInArrow(best, f"question {kinds['question']}, ident {kinds['ident']}, similarity double")


def search_cells(
    index: CellIndex,
    questions: DataFrame,
    k: int,
    question: str = "question_id",
    column: str = "embedding",
    probes: int = 8,
    category: str | None = None,
    exact: bool = False,
) -> DataFrame:
    """The ``k`` most similar vectors that the ``probes`` nearest cells of each question hold:
    question, ident, similarity, rank; ties go to the smaller ident.

    ``category`` names a column of the questions that must equal the index's category. With
    ``exact`` a second pass looks into every further cell that may hold a vector as near as
    the k-th found, so that the result is that of comparing everything; in well separated
    data these are few. Unusable questions have no rows.
    """
    if category is not None and not index.category:
        raise ValueError("the index was built without a category")
    asked = _asked(index, questions, question, column, category)
    order = [F.desc("similarity"), F.asc("ident")]
    found = top_n_per_group(_matched(index, _probes(index, asked, probes), k, category is not None), ["question"], order, k, "rank")
    if exact:
        found = cut(found)
        floors = found.groupBy("question").agg(F.when(F.count("*") >= k, F.min("similarity")).alias("floor"))
        floors = asked.select("question").join(floors, "question", "left")
        more = _matched(index, _probes(index, asked, probes, floors), k, category is not None)
        found = top_n_per_group(found.drop("rank").unionByName(more), ["question"], order, k, "rank")
    return found.select(F.col("question").alias(question), F.col("ident").alias(index.ident), "similarity", "rank")


def compared_share(index: CellIndex, questions: DataFrame, question: str = "question_id", column: str = "embedding", probes: int = 8) -> float:
    """The vectors that questions are compared with in the first pass, as a share of all."""
    asked = _asked(index, questions, question, column, None)
    counts = _probes(index, asked, probes).groupBy("cell").count().collect()  # a row a cell
    n = asked.count()
    return float(sum(index.rows[r["cell"]] * r["count"] for r in counts) / max(1, n * index.rows.sum()))
