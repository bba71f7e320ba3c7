"""Running sums over a global order: one range shuffle and one row per partition."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import cut


def dealt(df: DataFrame, *columns: str | Column) -> DataFrame:
    """Rows by key over as many tasks as the session names for shuffles.

    For rows whose work does not follow their bytes: a plain repartition would be merged
    into few tasks by its small size.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *columns)


def running_sums(df: DataFrame, order: list[Column], values: dict[str, str]) -> DataFrame:
    """Adds ``values[c]``: the sum of long column c over all rows up to and with this one.

    The order should be total up to rows that may change places. Rows are dealt out by
    range of the order, so no key is held together; each partition is added up in its own
    sort order and then moved by the totals of the partitions before it, a table with one
    row per partition. Null counts as 0.
    """
    names = [c for c in values]
    at = [df.columns.index(c) for c in names]
    fields = [T.StructField(values[c], T.LongType()) for c in names]
    schema = T.StructType([*df.schema, *fields, T.StructField("_range", T.IntegerType())])

    def add_up(batches):
        part = TaskContext.get().partitionId()
        carried = [0] * len(at)
        for batch in batches:
            columns = list(batch.columns)
            for k, i in enumerate(at):
                sums = np.cumsum(batch.column(i).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)) + carried[k]
                carried[k] = int(sums[-1]) if len(sums) else carried[k]
                columns.append(pa.array(sums, pa.int64()))
            columns.append(pa.array(np.full(batch.num_rows, part, np.int32)))
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    local = cut(df.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(add_up, schema))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    totals = local.groupBy("_range").agg(*[F.sum(c).alias(f"_t{k}") for k, c in enumerate(names)])
    moved = totals.select(
        "_range", *[F.coalesce(F.sum(f"_t{k}").over(before), F.lit(0)).alias(f"_b{k}") for k in range(len(names))]
    )
    out = local.join(F.broadcast(moved), "_range")
    sums = [(F.col(values[c]) + F.col(f"_b{k}")).alias(values[c]) for k, c in enumerate(names)]
    return out.select(*[F.col(f"`{c}`") for c in df.columns], *sums)
