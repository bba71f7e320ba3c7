"""Token counts of documents in flat token files without an index.

Files hold ids of a fixed width, each document followed by an end id. Blocks of the files
are searched for that id side by side; a prefix scan over one row per block gives each
block the number of documents and the last end before it, which stitches documents that
span blocks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.prefix import dealt
from tidemark.llm.store import Folder, file_size, open_input
from tidemark.session import cut, fresh_path

KINDS = {2: "<u2", 4: "<u4"}


def write_flat(encoded: DataFrame, end_id: int, width: int = 2, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """Writes ids (binary, unsigned 32-bit) as flat files; returns (path, place, key) of each document.

    One file a task, documents as they come, ``end_id`` after each; a null is a document
    without ids. Raises ValueError if an id needs more than ``width`` bytes or is the end
    id. Only files that the returned rows name count.
    """
    root = fresh_path(encoded.sparkSession, "flat")

    def write(batches):
        folder, out, place, path = Folder(root, ".ids"), None, 0, None
        try:
            for batch in batches:
                if out is None and batch.num_rows:
                    path, out = folder.next()
                for data in batch.column(1):
                    array = np.frombuffer(data.as_buffer() or b"", "<u4")
                    if len(array) and (int(array.max()) >> 8 * width or (array == end_id).any()):
                        raise ValueError(f"an id does not fit into {width} bytes or is the end id {end_id}")
                    out.write(np.append(array, end_id).astype(KINDS[width]).tobytes())
                places = np.arange(place, place + batch.num_rows)
                place += batch.num_rows
                yield pa.RecordBatch.from_arrays([pa.array([path] * batch.num_rows, pa.string()), pa.array(places), batch.column(0)], names=["path", "place", key])
        finally:
            if out is not None:
                out.close()

    kind = encoded.schema[key].dataType.simpleString()
    return cut(encoded.select(key, ids).mapInArrow(write, f"path string, place long, `{key}` {kind}"))


def blocks_of(files: DataFrame, block_bytes: int, width: int) -> DataFrame:
    """(path, block, at, size): byte ranges of the whole ids in the files in ``path``."""

    def lay_out(batches):
        for batch in batches:
            for path in batch.column(0).to_pylist():
                size = file_size(path)
                size -= size % width
                at = np.arange(0, size, block_bytes)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([path] * len(at), pa.string()), pa.array(np.arange(len(at))), pa.array(at), pa.array(np.minimum(block_bytes, size - at))],
                    names=["path", "block", "at", "size"],
                )

    return files.select("path").mapInArrow(lay_out, "path string, block long, at long, size long")


def count_tokens(files: DataFrame, end_id: int, width: int = 2, block_bytes: int = 1 << 22) -> DataFrame:
    """(path, place, n_tokens, ended) of each document in the files named by ``path``.

    ``n_tokens`` does not count the end id. Ids after the last end id are a document that
    is not ``ended``; an empty file has none, and bytes after the last whole id do not
    count. Names that are repeated count once. A block holds ``block_bytes``, however long
    the documents; no task reads a whole file.
    """
    block_bytes -= block_bytes % width

    def search(batches):
        for batch in batches:
            columns = (batch.column(k).to_pylist() for k in range(4))
            for path, block, at, size in zip(*columns):
                with open_input(path) as f:
                    data = f.read_at(size, at)
                ids = np.frombuffer(data, KINDS[width])
                ends = np.flatnonzero(ids == end_id) + at // width
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([path], pa.string()),
                        pa.array([block], pa.int64()),
                        pa.array([at // width + len(ids)], pa.int64()),
                        pa.array([len(ends)], pa.int64()),
                        pa.array([int(ends[-1]) if len(ends) else None], pa.int64()),
                        pa.array([ends], pa.list_(pa.int64())),
                    ],
                    names=["path", "block", "upto", "n", "last", "ends"],
                )

    ranges = dealt(blocks_of(files.select("path").distinct(), block_bytes, width), "path", "block")
    found = cut(ranges.mapInArrow(search, "path string, block long, upto long, n long, last long, ends array<long>"))
    earlier = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    stitched = found.select("path", "block", "upto", "n", "last").select(
        "path",
        "block",
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"),
        F.coalesce(F.max("last").over(earlier), F.lit(-1)).alias("previous"),
        F.max("last").over(Window.partitionBy("path")).alias("final"),
        (F.max("upto").over(Window.partitionBy("path")) == F.col("upto")).alias("closes"),
        "upto",
        F.sum("n").over(Window.partitionBy("path")).alias("documents"),
    )
    whole = found.select("path", "block", "ends").join(stitched, ["path", "block"])
    ended = whole.select("path", "before", "previous", "ends", F.posexplode("ends").alias("k", "end")).select(
        "path",
        (F.col("before") + F.col("k")).alias("place"),
        (F.col("end") - F.when(F.col("k") == 0, F.col("previous")).otherwise(F.element_at("ends", F.greatest(F.col("k"), F.lit(1)))) - 1).alias("n_tokens"),
        F.lit(True).alias("ended"),
    )
    rest = F.col("upto") - F.coalesce("final", F.lit(-1)) - 1
    open_ = stitched.filter(F.col("closes") & (rest > 0)).select("path", F.col("documents").alias("place"), rest.alias("n_tokens"), F.lit(False).alias("ended"))
    return ended.unionByName(open_)
