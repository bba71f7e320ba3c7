"""A versioned dataset as plain Parquet folders plus a small commit log.

Every commit writes its rows to ``data/_v=<n>`` and then one JSON row to
``log/<n>``. Readers list commits first, so a half-written version is never seen,
and two writers of the same version collide on the log folder. A commit names the
data folders that make up the table, so old versions stay readable until they are
expired. Only commit rows, never data, are read on the driver.
"""

from __future__ import annotations

import json
import math
import time
from collections.abc import Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import partition_value
from tidemark.sources.files import data_files

LOG = T.StructType(
    [
        T.StructField("version", T.LongType()),
        T.StructField("parent", T.LongType()),
        T.StructField("committed_ms", T.LongType()),
        T.StructField("operation", T.StringType()),
        T.StructField("parts", T.ArrayType(T.LongType())),
        T.StructField("deletes", T.ArrayType(T.LongType())),
        T.StructField("layout", T.StringType()),
        T.StructField("schema", T.StringType()),
        T.StructField("batch", T.StringType()),
    ]
)
REFS = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("kind", T.StringType()),
        T.StructField("version", T.LongType()),
        T.StructField("set_ms", T.LongType()),
    ]
)
PART = "_part"


class Dataset:
    """Append, overwrite, time travel, layout changes and upkeep over one folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    # --- commit log -----------------------------------------------------------

    def _exists(self, path: str) -> bool:
        return self._fs(path).exists(self._path(path))

    def _path(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _fs(self, path: str):
        return self._path(path).getFileSystem(
            self.spark.sparkContext._jsc.hadoopConfiguration()
        )

    def log(self) -> DataFrame:
        """The commit log as a table."""
        if not self._exists(f"{self.root}/log"):
            return self.spark.createDataFrame([], LOG)
        return self.spark.read.schema(LOG).json(f"{self.root}/log/*")

    def _commits(self) -> list:
        return sorted(self.log().collect(), key=lambda r: r.version)

    def head(self) -> int:
        top = self.log().agg(F.max("version")).first()[0]
        return -1 if top is None else top

    def _commit(self, version, parent, operation, parts, deletes, layout, schema, batch=None):
        row = (
            version, parent, int(time.time() * 1000), operation, parts, deletes,
            json.dumps(layout), schema.json(), batch,
        )
        self.spark.createDataFrame([row], LOG).coalesce(1).write.mode("errorifexists").json(
            f"{self.root}/log/{version:08d}"
        )
        return version

    # --- writing --------------------------------------------------------------

    def create(self, schema: T.StructType, layout: dict | None = None) -> int:
        """An empty version 0. ``layout``: column, transform, width of the partition."""
        return self._commit(0, None, "create", [], [], layout or {}, schema)

    def _write(
        self, df: DataFrame, version: int, layout: dict, schema: T.StructType, files: int | None = None
    ):
        stored = {f.name: _stored(f) for f in schema.fields}
        df = df.select(*[F.col(c).alias(stored.get(c, c)) for c in df.columns])
        path = f"{self.root}/data/_v={version}"
        sort = layout.get("sort", [])
        if not layout.get("column"):
            out = df.repartition(files) if files else df
            out = out.sortWithinPartitions(*sort) if sort else out
            out.write.mode("overwrite").parquet(path)
            return
        value = partition_value(layout["column"], layout["transform"], layout.get("width"))
        marked = df.withColumn(PART, value.cast("string"))
        # Ranges over (partition, order): few files per partition, and a partition
        # with much data is written by several tasks.
        by = [PART, *(sort or [layout["column"]])]
        spread = (
            marked.repartitionByRange(files, *by) if files else marked.repartitionByRange(*by)
        )
        spread.sortWithinPartitions(*by).write.mode("overwrite").partitionBy(PART).parquet(path)

    def _last(self):
        commits = self._commits()
        return commits[-1] if commits else None

    def append(self, df: DataFrame, batch: str | None = None) -> int:
        """Add rows as a new version; a ``batch`` id already committed adds nothing."""
        commits = self._commits()
        if batch is not None:
            for c in commits:
                if c.batch == batch:
                    return c.version
        last = commits[-1] if commits else None
        version = last.version + 1 if last else 0
        layout = json.loads(last.layout) if last else {}
        schema = _merged(_schema(last), df.schema) if last else df.schema
        self._write(df, version, layout, schema)
        parts = [*(last.parts if last else []), version]
        return self._commit(
            version, last.version if last else None, "append", parts,
            list(last.deletes) if last else [], layout, schema, batch,
        )

    def overwrite(
        self, df: DataFrame, operation: str = "overwrite", batch: str | None = None,
        files: int | None = None, layout: dict | None = None,
    ) -> int:
        """Replace the content by ``df`` as a new version."""
        commits = self._commits()
        if batch is not None:
            for c in commits:
                if c.batch == batch:
                    return c.version
        last = commits[-1] if commits else None
        version = last.version + 1 if last else 0
        chosen = layout if layout is not None else (json.loads(last.layout) if last else {})
        schema = _kept(_schema(last), df.schema) if last else df.schema
        self._write(df, version, chosen, schema, files)
        return self._commit(
            version, last.version if last else None, operation, [version], [], chosen,
            schema, batch,
        )

    def delete_keys(self, keys: DataFrame) -> int:
        """Keep deletes as a separate key set; readers apply it to older rows only."""
        last = self._last()
        version = last.version + 1
        stored = {f.name: _stored(f) for f in _schema(last).fields}
        keys = keys.select(*[F.col(c).alias(stored[c]) for c in keys.columns])
        keys.distinct().write.mode("overwrite").parquet(f"{self.root}/deletes/_v={version}")
        return self._commit(
            version, last.version, "delete", list(last.parts), [*last.deletes, version],
            json.loads(last.layout), _schema(last),
        )

    def merge(
        self, rows: DataFrame, keys: Sequence[str], removed: DataFrame | None = None,
        batch: str | None = None,
    ) -> int:
        """Replace rows by key without rewriting the table.

        The new rows and the set of their keys are written side by side in one
        commit; readers hide older rows with these keys. The cost is that of the
        batch; ``compact`` folds the sets in later. ``removed`` adds keys to hide.
        ``rows`` must hold each key once.
        """
        last = self._last()
        if batch is not None:
            for c in self._commits():
                if c.batch == batch:
                    return c.version
        version = last.version + 1
        schema = _merged(_schema(last), rows.schema)
        hidden = rows.select(*keys)
        if removed is not None:
            hidden = hidden.unionByName(removed.select(*keys))
        stored = {f.name: _stored(f) for f in schema.fields}
        hidden = hidden.select(*[F.col(k).alias(stored[k]) for k in keys]).distinct()
        hidden.write.mode("overwrite").parquet(f"{self.root}/deletes/_v={version}")
        layout = json.loads(last.layout)
        self._write(rows, version, layout, schema)
        return self._commit(
            version, last.version, "merge", [*last.parts, version], [*last.deletes, version],
            layout, schema, batch,
        )

    def delete_backlog(self) -> DataFrame:
        """Pending delete sets with their keys: many mean a compaction is due."""
        out = self.spark.createDataFrame([], "version long, deleted_keys long")
        for d in self._last().deletes:
            one = self.spark.read.parquet(f"{self.root}/deletes/_v={d}")
            out = out.unionByName(
                one.agg(F.lit(d).cast("long").alias("version"), F.count("*").alias("deleted_keys"))
            )
        return out

    def set_layout(self, layout: dict) -> int:
        """New partitioning for later versions; old files stay as they are."""
        last = self._last()
        if layout.get("column"):
            stored = {f.name: _stored(f) for f in _schema(last).fields}
            layout = {**layout, "column": stored[layout["column"]]}
        return self._commit(
            last.version + 1, last.version, "layout", list(last.parts), list(last.deletes),
            layout, _schema(last),
        )

    def _evolve(self, operation: str, schema: T.StructType) -> int:
        last = self._last()
        return self._commit(
            last.version + 1, last.version, operation, list(last.parts), list(last.deletes),
            json.loads(last.layout), schema,
        )

    def add_column(self, name: str, kind: str) -> int:
        """A new nullable column; existing files are not rewritten.

        Should the name have been used before, the new column is stored under another
        one, so that a dropped column's values never come back.
        """
        fields = _schema(self._last()).fields
        used = {_stored(f) for c in self._commits() for f in _schema(c).fields}
        fresh = T.StructType.fromDDL(f"{name} {kind}").fields[0]
        if name in used:
            fresh = T.StructField(name, fresh.dataType, True, {"stored": f"{name}__{self.head() + 1}"})
        return self._evolve("add_column", T.StructType([*fields, fresh]))

    def rename_column(self, old: str, new: str) -> int:
        """Only the schema changes; files keep the stored name."""
        fields = [
            T.StructField(new, f.dataType, f.nullable, {"stored": _stored(f)}) if f.name == old else f
            for f in _schema(self._last()).fields
        ]
        return self._evolve("rename_column", T.StructType(fields))

    def drop_column(self, name: str) -> int:
        fields = [f for f in _schema(self._last()).fields if f.name != name]
        return self._evolve("drop_column", T.StructType(fields))

    def reorder_columns(self, names: Sequence[str]) -> int:
        schema = _schema(self._last())
        return self._evolve("reorder_columns", T.StructType([schema[n] for n in names]))

    # --- reading --------------------------------------------------------------

    def resolve(
        self, version: int | None = None, at_ms: int | None = None,
        offset_s: int | None = None, ref: str | None = None,
    ):
        """The commit for a version, a time, an offset before now, or a pointer."""
        commits = self._commits()
        if ref is not None:
            version = self.refs()[ref]
        if offset_s is not None:
            at_ms = int(time.time() * 1000) - offset_s * 1000
        if version is not None:
            found = [c for c in commits if c.version == version]
        elif at_ms is not None:
            found = [c for c in commits if c.committed_ms <= at_ms]
        else:
            found = commits
        if not found:
            raise ValueError("no such version")
        return found[-1]

    def read(self, start=None, end=None, **when) -> DataFrame:
        """The table's rows, now or as of an earlier version.

        ``start``/``end`` bound the layout column (half-open). For the time transforms
        the partition predicate is derived here, so whole folders are skipped.
        """
        commit = self.resolve(**when)
        schema = _schema(commit)
        layouts = {c.version: json.loads(c.layout) for c in self._commits()}
        if not commit.parts:
            return self.spark.createDataFrame([], schema)
        out = None
        groups: dict[str, list[int]] = {}
        for p in commit.parts:
            groups.setdefault(json.dumps(layouts[p], sort_keys=True), []).append(p)
        for text, parts in groups.items():
            rows = self._read_group(schema, json.loads(text), parts, start, end)
            out = rows if out is None else out.unionByName(rows)
        for keys, gone in self._delete_sets(commit.deletes):
            # A key deleted at _d hides rows written before it; later rows are new.
            older = [out[k].eqNullSafe(gone[f"_k_{k}"]) for k in keys]
            hidden = reduce(lambda a, b: a & b, older) & (out["_v"] < gone["_d"])
            out = out.join(gone, hidden, "left_anti")
        return out.select(*[F.col(_stored(f)).alias(f.name) for f in schema.fields])

    def _delete_sets(self, versions: Sequence[int]):
        """Delete sets with the same key columns as one table (keys, newest delete)."""
        sets: dict[tuple[str, ...], DataFrame] = {}
        for d in versions:
            one = self.spark.read.parquet(f"{self.root}/deletes/_v={d}").withColumn("_d", F.lit(d).cast("long"))
            keys = tuple(c for c in one.columns if c != "_d")
            sets[keys] = sets[keys].unionByName(one) if keys in sets else one
        for keys, rows in sets.items():
            yield keys, rows.groupBy(*[F.col(k).alias(f"_k_{k}") for k in keys]).agg(F.max("_d").alias("_d"))

    def _read_group(self, schema, layout, parts, start, end) -> DataFrame:
        stored = [T.StructField(_stored(f), f.dataType) for f in schema.fields]
        column = layout.get("column")
        needed = {_stored(f) for f in schema.fields}
        for extra in self._hidden_fields(column, needed):
            stored.append(extra)
        stored.append(T.StructField("_v", T.LongType()))
        if column:
            stored.append(T.StructField(PART, T.StringType()))
        rows = (
            self.spark.read.schema(T.StructType(stored))
            .option("basePath", f"{self.root}/data")
            .parquet(*[f"{self.root}/data/_v={p}" for p in parts])
        )
        timed = layout.get("transform") in ("year", "month", "day", "hour")
        for bound, is_start in ((start, True), (end, False)):
            if bound is None or not column:
                continue
            edge = F.lit(bound)
            rows = rows.filter(F.col(column) >= edge if is_start else F.col(column) < edge)
            if timed:
                part = bound.strftime(
                    {"year": "%Y", "month": "%Y-%m", "day": "%Y-%m-%d", "hour": "%Y-%m-%d-%H"}[
                        layout["transform"]
                    ]
                )
                rows = rows.filter(F.col(PART) >= part if is_start else F.col(PART) <= part)
        return rows.drop(PART)

    def _hidden_fields(self, column: str | None, known: set[str]) -> list[T.StructField]:
        """Stored columns no longer in the schema that a layout or a delete still needs."""
        last = self._commits()
        keys = {c for d in last[-1].deletes for c in self.spark.read.parquet(f"{self.root}/deletes/_v={d}").columns}
        wanted = ({column} if column else set()) | keys
        found = {_stored(f): f.dataType for c in last for f in _schema(c).fields}
        return [T.StructField(n, found[n]) for n in sorted(wanted - known) if n in found]

    # --- metadata ---------------------------------------------------------------

    def history(self) -> DataFrame:
        return self.log().select("version", "parent", "committed_ms", "operation").orderBy("version")

    def summary(self) -> DataFrame:
        """Versions, schemas, layouts, oldest commit and head of the table."""
        return self.log().agg(
            F.count("*").alias("versions"),
            F.countDistinct("schema").alias("schemas"),
            F.countDistinct("layout").alias("layouts"),
            F.min("committed_ms").alias("oldest_ms"),
            F.max("version").alias("head"),
        )

    def files(self, **when) -> DataFrame:
        """Data files of a version: partition, rows, bytes."""
        parts = self.resolve(**when).parts
        if not parts:
            return self.spark.createDataFrame([], "file string, bytes long, rows long, part string")
        out = None
        for p in parts:
            # With a schema, a part without rows is an empty table and not an error.
            one = data_files(self.spark, f"{self.root}/data/_v={p}", schema=f"{PART} string")
            out = one if out is None else out.unionByName(one)
        return out.withColumn("part", F.regexp_extract("file", rf"{PART}=([^/]+)/", 1))

    def partitions(self, **when) -> DataFrame:
        return self.files(**when).groupBy("part").agg(
            F.count("*").alias("files"), F.sum("rows").alias("rows"), F.sum("bytes").alias("bytes")
        )

    # --- pointers ---------------------------------------------------------------

    def refs(self) -> dict[str, int]:
        if not self._exists(f"{self.root}/refs"):
            return {}
        rows = self.spark.read.schema(REFS).json(f"{self.root}/refs/*").collect()
        return {r.name: r.version for r in sorted(rows, key=lambda r: r.set_ms)}

    def point(self, name: str, version: int | None = None, kind: str = "tag") -> None:
        """Set a branch or tag to a version without copying data."""
        row = (name, kind, self.head() if version is None else version, int(time.time() * 1000))
        self.spark.createDataFrame([row], REFS).coalesce(1).write.json(
            f"{self.root}/refs/{name}-{row[3]}"
        )

    # --- upkeep -----------------------------------------------------------------

    def compact(self, target_bytes: int = 256 << 20, most_rows: int = 4_000_000) -> int:
        """Rewrite into files of about ``target_bytes``; pending deletes are applied.

        Where files are sorted, a task writes about ``most_rows`` rows at most, so that
        what it sorts does not follow the table.
        """
        total = self.files().agg(F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows")).first()
        files = math.ceil((total["bytes"] or 0) / target_bytes)
        layout = json.loads(self._last().layout)
        if layout.get("column") or layout.get("sort"):
            files = max(files, math.ceil((total["rows"] or 0) / most_rows))
        return self.overwrite(self.read(), operation="compact", files=max(1, files))

    def expired(self, before_ms: int) -> DataFrame:
        """Versions older than a time that neither the head nor a pointer needs."""
        keep = [self.head(), *self.refs().values()]
        return self.log().filter(
            (F.col("committed_ms") < before_ms) & ~F.col("version").isin(keep)
        )

    def expire(self, before_ms: int) -> list[str]:
        """Remove expired commits, then the data folders no commit names any more."""
        gone = {r.version for r in self.expired(before_ms).collect()}
        kept = [c for c in self._commits() if c.version not in gone]
        used = {p for c in kept for p in c.parts}
        used_deletes = {d for c in kept for d in c.deletes}
        removed = []
        for c in self._commits():
            if c.version in gone:
                self._remove(f"{self.root}/log/{c.version:08d}")
                for p in set(c.parts) - used:
                    removed.append(f"{self.root}/data/_v={p}")
                for d in set(c.deletes) - used_deletes:
                    removed.append(f"{self.root}/deletes/_v={d}")
        for path in sorted(set(removed)):
            self._remove(path)
        return sorted(set(removed))

    def _remove(self, path: str) -> None:
        if not path.startswith(self.root + "/"):
            raise ValueError("outside the dataset")
        self._fs(path).delete(self._path(path), True)

    def orphans(self) -> DataFrame:
        """Data files that no commit references; a report, nothing is removed."""
        listed = (
            self.spark.read.format("binaryFile")
            .option("recursiveFileLookup", "true")
            .option("pathGlobFilter", "*.parquet")
            .load(f"{self.root}/data")
            .select("path", "length", F.regexp_extract("path", r"_v=(\d+)/", 1).cast("long").alias("v"))
        )
        used = self.log().select(F.explode("parts").alias("v")).distinct()
        return listed.join(used, "v", "left_anti").select("path", "length")


def _schema(commit) -> T.StructType:
    return T.StructType.fromJson(json.loads(commit.schema))


def _stored(field: T.StructField) -> str:
    """The name of a column inside the files."""
    return (field.metadata or {}).get("stored", field.name)


def _merged(old: T.StructType, new: T.StructType) -> T.StructType:
    known = set(old.names)
    return T.StructType([*old.fields, *[f for f in new.fields if f.name not in known]])


def _kept(old: T.StructType, new: T.StructType) -> T.StructType:
    """The new schema, with the stored names of columns that stay."""
    names = {f.name: _stored(f) for f in old.fields}
    return T.StructType(
        [
            T.StructField(f.name, f.dataType, f.nullable, {"stored": names[f.name]})
            if f.name in names
            else f
            for f in new.fields
        ]
    )


# --- layout jobs over any file set --------------------------------------------------


def file_health(files: DataFrame, small_bytes: int = 64 << 20) -> DataFrame:
    """File count and sizes, with a flag when the mean is small."""
    mb = F.lit(1024.0 * 1024.0)
    return files.agg(
        F.count("*").alias("files"),
        F.round(F.avg("bytes") / mb, 1).alias("avg_mb"),
        F.round(F.min("bytes") / mb, 1).alias("min_mb"),
        F.round(F.max("bytes") / mb, 1).alias("max_mb"),
        (F.avg("bytes") < small_bytes).alias("needs_compaction"),
    )


def sorted_layout(df: DataFrame, part: Column, columns: Sequence[str], files: int) -> DataFrame:
    """Rows ranged by partition and filter columns and sorted inside each file."""
    by = ["_p", *columns]
    return (
        df.withColumn("_p", part).repartitionByRange(files, *by).sortWithinPartitions(*by).drop("_p")
    )


def z_value(df: DataFrame, columns: Sequence[str], bits: int = 10) -> DataFrame:
    """Append ``_z``: interleaved bits of each numeric column's quantile bucket."""
    n = 1 << bits
    probs = [i / n for i in range(1, n)]
    bounds = df.agg(*[F.percentile_approx(c, probs, 10000).alias(c) for c in columns]).first()
    z = F.lit(0).cast("long")
    for i, c in enumerate(columns):
        slot = _slots(bounds[c] or [])(F.col(c).cast("double"))
        for bit in range(bits):
            one = F.shiftright(slot, bit).bitwiseAND(F.lit(1).cast("long"))
            z = z.bitwiseOR(F.shiftleft(one, bit * len(columns) + i))
    return df.withColumn("_z", z)


def _slots(edges: Sequence[float]):
    """How many of the edges a value exceeds, by binary search on Arrow batches."""
    sorted_edges = np.asarray(edges, dtype=np.float64)

    @F.pandas_udf("long")
    def slot(values: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(sorted_edges, values.to_numpy(), side="left"))

    return slot


def z_ordered(df: DataFrame, columns: Sequence[str], files: int, bits: int = 10) -> DataFrame:
    return z_value(df, columns, bits).repartitionByRange(files, "_z").sortWithinPartitions("_z").drop("_z")


def file_ranges(spark: SparkSession, path: str, column: str) -> DataFrame:
    """Smallest and largest value of a column in each data file."""
    return (
        spark.read.parquet(path)
        .groupBy(F.col("_metadata.file_path").alias("file"))
        .agg(F.min(column).alias("lo"), F.max(column).alias("hi"), F.count("*").alias("rows"))
    )


def files_to_read(ranges: DataFrame, low, high) -> DataFrame:
    """How many files a closed range predicate could touch, and the share skipped."""
    hit = (F.col("hi") >= F.lit(low)) & (F.col("lo") <= F.lit(high))
    return ranges.agg(
        F.count("*").alias("files"),
        F.count_if(hit).alias("touched"),
        (F.lit(1.0) - F.count_if(hit) / F.count("*")).alias("skipped_share"),
    )


def clustering_depth(ranges: DataFrame, **how) -> DataFrame:
    """Largest and mean number of files whose value ranges overlap, by event sweep."""
    from tidemark.operators.ordered import place

    opens = ranges.select(F.col("lo").alias("at"), F.lit(0).alias("kind"), "file", F.lit(1).alias("d"))
    closes = ranges.select(F.col("hi").alias("at"), F.lit(1).alias("kind"), "file", F.lit(-1).alias("d"))
    swept = place(opens.unionByName(closes), [], ["at", "kind", "file"], **how).running_sum(
        depth=F.col("d")
    )
    return swept.df.filter("kind = 0").agg(
        F.max("depth").alias("max_depth"), F.avg("depth").alias("avg_depth")
    )


def partition_advice(bytes_per_day: Column, key: str = "user_id") -> Column:
    """Granularity from daily volume (fixed thresholds: 1 TB and 10 TB a day)."""
    tb = float(1 << 40)
    return (
        F.when(bytes_per_day > 10 * tb, f"day + bucket({key}, 128)")
        .when(bytes_per_day >= tb, "day")
        .otherwise("month")
    )


def identity_risk(df: DataFrame, columns: Sequence[str], most: int = 10_000) -> DataFrame:
    """Columns with too many values to be used as identity partitions."""
    counts = df.agg(*[F.approx_count_distinct(c).alias(c) for c in columns])
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("values")) for c in columns])
    return counts.select(F.inline(rows)).withColumn("too_many", F.col("values") > most)
