"""Near duplicates of embeddings: sign hashes of random hyperplanes, exact cosines, components."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.links import block_pairs, components, linked_blocks
from tidemark.session import cut


def tables_for(threshold: float, bits: int, recall: float) -> int:
    """Tables of ``bits`` signs so that a pair at the threshold shares one with this probability."""
    alike = (1 - math.acos(threshold) / math.pi) ** bits
    return math.ceil(math.log(1 - recall) / math.log(1 - alike))


def hyperplanes(size: int, tables: int, bits: int, seed: int = 5) -> np.ndarray:
    return np.random.default_rng([seed, size]).standard_normal((size, tables * bits))


def usable(vector: list | None) -> np.ndarray | None:
    """The vector in double precision; None if null, empty, zero or not finite throughout."""
    if not vector or None in vector:
        return None
    v = np.array(vector, np.float64)
    return v if np.isfinite(v).all() and v.any() else None


def signed(vectors: DataFrame, key: str, vector: str, label: str, tables: int, bits: int) -> DataFrame:
    """key, label, ok, digest of the vector, the vector as doubles, and its sign hash in each table."""

    def run(batches):
        planes: dict[int, np.ndarray] = {}
        power = 1 << np.arange(bits, dtype=np.int64)
        for batch in batches:
            found = [usable(v) for v in batch.column(2).to_pylist()]
            keys: list = [None] * len(found)
            by_size: dict[int, list[int]] = {}
            for k, v in enumerate(found):
                if v is not None:
                    by_size.setdefault(len(v), []).append(k)
            for size, rows in by_size.items():
                if size not in planes:
                    planes[size] = hyperplanes(size, tables, bits)
                for a in range(0, len(rows), 512):
                    some = rows[a : a + 512]
                    sign = np.stack([found[k] / np.abs(found[k]).max() for k in some]) @ planes[size] > 0
                    hashes = sign.reshape(len(some), tables, bits) @ power
                    for k, h in zip(some, hashes.astype(np.int32)):
                        keys[k] = h
            raw = [None if v is None else (v + 0.0).tobytes() for v in found]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([None if r is None else hashlib.blake2b(r, digest_size=16).digest() for r in raw], pa.binary()),
                    pa.array(raw, pa.binary()),
                    pa.array(keys, pa.list_(pa.int32())),
                ],
                names=["key", "label", "digest", "vector", "signs"],
            )

    kind = vectors.schema[label].dataType
    schema = T.StructType(
        [
            T.StructField("key", T.LongType()),
            T.StructField("label", kind),
            T.StructField("digest", T.BinaryType()),
            T.StructField("vector", T.BinaryType()),
            T.StructField("signs", T.ArrayType(T.IntegerType())),
        ]
    )
    return vectors.select(F.col(key).cast("long").alias("key"), F.col(label).alias("label"), F.col(vector).alias("v")).mapInArrow(run, schema)


def cosine_links(threshold: float):
    """Links of two blocks of one table bucket, each pair in the first table that it shares."""

    def verify(left: dict, right: dict, same: bool) -> np.ndarray:
        def unit(side):
            x = np.stack([np.frombuffer(v, np.float64) for v in side["vector"]])
            x = x / np.abs(x).max(axis=1)[:, None]
            return x, np.sqrt((x * x).sum(axis=1))

        a, a_norm = unit(left)
        b, b_norm = (a, a_norm) if same else unit(right)
        linked = (a @ b.T) / a_norm[:, None] / b_norm[None, :] >= threshold
        if same:
            np.fill_diagonal(linked, False)
        one, two = np.nonzero(linked)
        signs_a, signs_b = np.array(left["signs"]), np.array(right["signs"])
        first = (signs_a[one] == signs_b[two]).argmax(axis=1)
        linked[one, two] = first == left["tab"][0]
        return linked

    return verify


def near_duplicates(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", threshold: float = 0.98, bits: int = 20, recall: float = 0.9999, block: int = 128
) -> DataFrame:
    """One row per vector: key, n_links, component_id, kept.

    Vectors with equal, not null labels and equal length are linked at a cosine of at least
    the threshold, in double precision; a link at the threshold is found with at least the
    given probability, a closer one more surely. Vectors that are null, empty, zero or hold
    null or non-finite components, and those without a label, link with nothing.
    ``n_links`` counts other rows, ``component_id`` is the smallest key that links lead to
    (null keys count as the largest), ``kept`` says whether that is the row's own key.

    Equal vectors of a label are one class, combined before they move, and their links are
    counted without pairs. Classes meet in the buckets of each table; a large bucket is cut
    into blocks of about ``block`` classes, compared pair of blocks by pair of blocks.
    """
    tables = tables_for(threshold, bits, recall)
    rows = cut(signed(vectors, key, vector, label, tables, bits))
    live = rows.filter(F.col("digest").isNotNull() & F.col("label").isNotNull())
    classes = cut(
        live.groupBy("label", "digest")
        .agg(F.count(F.lit(1)).alias("copies"), F.min("key").alias("least"), F.first("vector").alias("vector"), F.first("signs").alias("signs"))
        .withColumn("id", F.monotonically_increasing_id())
    )
    size = F.octet_length("vector").alias("size")
    members = classes.select("id", "label", size, F.posexplode("signs").alias("tab", "sign")).select(
        F.struct("label", "size", "tab", "sign").alias("grp"), "id", "tab"
    )
    sizes = cut(members.groupBy("grp").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").withColumn("w", F.lit(1)))
    tasks = block_pairs(members, sizes, block)
    loaded = tasks.join(classes.select("id", "copies", "vector", "signs"), "id")
    found = cut(linked_blocks(loaded, cosine_links(threshold), ["vector", "signs", "tab"]))
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    labels = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    named = cut(classes.select("id", "label", "digest", "copies", "least").join(links, "id", "left").join(labels.withColumnRenamed("label", "part"), "id", "left"))
    least = named.filter("part IS NOT NULL").groupBy("part").agg(F.min("least").alias("of_part"))
    known = cut(
        named.join(least, "part", "left").select(
            F.col("label").alias("l"),
            F.col("digest").alias("d"),
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.when(F.col("part").isNull(), F.col("least")).otherwise(F.col("of_part")).alias("component"),
        )
    )
    out = rows.select("key", "label", "digest").join(known, (F.col("label") == F.col("l")) & (F.col("digest") == F.col("d")), "left")
    component = F.coalesce("component", "key")
    return out.select(
        F.col("key").alias(key),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("key") == component, F.lit(False)).alias("kept"),
    )
