"""Links within groups, found in blocks, and connected components.

Groups of any size are cut into blocks by a hash of the member; each pair of blocks is a
task row key, so that a large group is compared by many tasks. A task returns one row per
member with its number of links and a root of its part, never pairs.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.prefix import dealt
from tidemark.session import cut


def block_pairs(members: DataFrame, sizes: DataFrame, most: int) -> DataFrame:
    """Task rows of ``members`` (grp, id, ...) by the groups in ``sizes`` (grp, n, w): grp, i,
    j, second (whether the row is of block j), id and the other columns.

    A group is cut into w blocks at least, and into so many that a block has about ``most``
    members. Groups that are not in ``sizes`` have no tasks.
    """
    blocks = sizes.select("grp", F.greatest(F.ceil(F.col("n") / most), F.col("w"), F.lit(1)).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64(F.lit(29), F.col("id")), F.col("blocks")).cast("int")
    with_other = members.join(blocks, "grp").withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return with_other.select(
        "grp",
        F.least("own", "other").alias("i"),
        F.greatest("own", "other").alias("j"),
        (F.col("own") > F.col("other")).alias("second"),
        *[c for c in members.columns if c != "grp"],
    )


def spanning(linked: np.ndarray, same: bool) -> np.ndarray:
    """Root of each row and then of each column: the first member that links lead to."""
    n, m = linked.shape
    rows = np.arange(n)
    columns = rows.copy() if same else np.arange(n, n + m)
    far = n + m
    while True:
        down = np.where(linked, rows[:, None], far).min(axis=0, initial=far)
        new_columns = np.minimum(columns, down)
        across = np.where(linked, new_columns[None, :], far).min(axis=1, initial=far)
        new_rows = np.minimum(rows, across)
        if same:
            new_columns = new_rows = np.minimum(new_rows, new_columns)
        if np.array_equal(new_rows, rows) and np.array_equal(new_columns, columns):
            return rows if same else np.concatenate([rows, columns])
        rows, columns = new_rows, new_columns


def linked_blocks(tasks: DataFrame, verify: Callable[[dict, dict, bool], np.ndarray], payload: list[str]) -> DataFrame:
    """Compares the blocks of each task; returns id, links, root for members with links.

    ``tasks``: grp, i, j, second, id, copies and the payload columns. ``verify`` gets the
    columns of two blocks as lists (and whether they are one) and returns the links as a
    boolean matrix; with one block it may leave the diagonal as it is. ``links`` counts the
    copies that the linked members stand for.
    """
    names = ["grp", "i", "j", "second", "id", "copies", *payload]

    def answers(key_rows: dict):
        second = np.array(key_rows["second"], bool)
        same = key_rows["i"][0] == key_rows["j"][0]
        left = {c: [x for x, s in zip(key_rows[c], second) if not s] for c in names[4:]}
        right = left if same else {c: [x for x, s in zip(key_rows[c], second) if s] for c in names[4:]}
        if (same and len(left["id"]) < 2) or not left["id"] or not right["id"]:
            return None
        linked = verify(left, right, same)
        if same:
            np.fill_diagonal(linked, False)
        if not linked.any():
            return None
        roots = spanning(linked, same)
        ids = np.array(left["id"] if same else left["id"] + right["id"], np.int64)
        one, two = np.array(left["copies"], np.int64), np.array(right["copies"], np.int64)
        links = linked @ two if same else np.concatenate([linked @ two, linked.T @ one])
        some = np.flatnonzero(links)
        return pa.RecordBatch.from_arrays(
            [pa.array(ids[some]), pa.array(links[some].astype(np.int64)), pa.array(ids[roots[some]])], names=["id", "links", "root"]
        )

    def run(batches):
        held: dict = {}
        key = None
        for batch in batches:
            rows = {c: batch.column(k).to_pylist() for k, c in enumerate(names)}
            keys = list(zip(rows["grp"], rows["i"], rows["j"]))
            a = 0
            for b in range(1, len(keys) + 1):
                if b < len(keys) and keys[b] == keys[a]:
                    continue
                if keys[a] != key and held:
                    out = answers(held)
                    if out is not None:
                        yield out
                    held = {}
                key = keys[a]
                for c in names:
                    held.setdefault(c, []).extend(rows[c][a:b])
                a = b
        if held:
            out = answers(held)
            if out is not None:
                yield out

    rows = dealt(tasks.select(*names), "grp", "i", "j").sortWithinPartitions("grp", "i", "j")
    return rows.mapInArrow(run, "id long, links long, root long")


def components(edges: DataFrame) -> DataFrame:
    """(id, label) of the nodes in ``edges`` (a, b): nodes with equal labels are connected.

    Each round hooks every node to the neighbour with the smallest hash (another hash each
    round), and goes on with the edges between the labels that differ; their number falls
    by a constant factor each round, whatever the shape. The driver only learns whether
    edges are left.
    """
    maps: list[DataFrame] = []
    left = cut(_distinct(edges.select("a", "b")))
    while not left.isEmpty():
        both = left.union(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        rank = lambda c: F.xxhash64(F.lit(len(maps)), F.col(c))  # noqa: B023, E731
        best = both.select("a", "b", rank("b").alias("h")).groupBy("a").agg(F.min("h").alias("h"), F.min_by("b", "h").alias("to"))
        hooked = cut(best.select("a", F.when(rank("a") < F.col("h"), F.col("a")).otherwise(F.col("to")).alias("to")))
        maps.append(hooked)
        of = lambda c: hooked.select(F.col("a").alias(c), F.col("to").alias(f"to_{c}"))
        left = cut(_distinct(left.join(of("a"), "a").join(of("b"), "b").select(F.col("to_a").alias("a"), F.col("to_b").alias("b"))))
    if not maps:
        return edges.select(F.col("a").alias("id"), F.col("b").alias("label")).limit(0)
    labels = maps[-1]
    for hooked in maps[-2::-1]:
        later = labels.select(F.col("a").alias("to"), F.col("to").alias("last"))
        labels = cut(hooked.join(later, "to", "left").select("a", F.coalesce("last", "to").alias("to")))
    return labels.select(F.col("a").alias("id"), F.col("to").alias("label"))


def _distinct(edges: DataFrame) -> DataFrame:
    ordered = edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return ordered.distinct()
