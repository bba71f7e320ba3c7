"""A small Spark data source over month folders that takes pushed-down filters."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualTo,
    Filter,
    GreaterThanOrEqual,
    InputPartition,
    LessThan,
)


PACK_BYTES = 128 << 20


class MonthFiles(InputPartition):
    """Data files of about ``PACK_BYTES`` together, each with its month."""

    def __init__(self, files: list[tuple[str, str]]):
        self.files = files


class MonthlyReader(DataSourceReader):
    """Reads the months that the filters leave; small files share a task."""

    def __init__(self, path: str, columns: list[str], partition: str):
        self.path = path
        self.columns = columns
        self.partition = partition
        self.kept: list[Filter] = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            if (
                isinstance(f, (EqualTo, GreaterThanOrEqual, LessThan))
                and f.attribute == (self.partition,)
            ):
                self.kept.append(f)
            else:
                yield f

    def _wanted(self, month: str) -> bool:
        tests = {
            EqualTo: lambda v: month == v,
            GreaterThanOrEqual: lambda v: month >= v,
            LessThan: lambda v: month < v,
        }
        return all(tests[type(f)](f.value) for f in self.kept)

    def partitions(self) -> list[InputPartition]:
        from pyarrow import fs

        files, root = fs.FileSystem.from_uri(self.path)
        packs: list[list[tuple[str, str]]] = []
        room = 0
        for info in files.get_file_info(fs.FileSelector(root, recursive=True)):
            if not info.path.endswith(".parquet"):
                continue
            month = info.path.rsplit("/", 2)[-2].split("=", 1)[-1]
            if not self._wanted(month):
                continue
            if not packs or info.size > room:
                packs.append([])
                room = PACK_BYTES
            packs[-1].append((info.path, month))
            room -= info.size
        return [MonthFiles(p) for p in packs]

    def read(self, partition: MonthFiles) -> Iterator:
        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyarrow import fs

        store, _ = fs.FileSystem.from_uri(self.path)
        stored = [c for c in self.columns if c != self.partition]
        for path, month in partition.files:
            with store.open_input_file(path) as handle:
                for batch in pq.ParquetFile(handle).iter_batches(columns=stored):
                    months = pa.array([month] * batch.num_rows, pa.string())
                    arrays = {n: batch.column(n) for n in stored} | {self.partition: months}
                    yield pa.RecordBatch.from_arrays(
                        [arrays[c] for c in self.columns], names=self.columns
                    )


class MonthlySource(DataSource):
    """``spark.read.format("monthly").schema(...).option("path", uri).load()``."""

    @classmethod
    def name(cls) -> str:
        return "monthly"

    def schema(self) -> str:
        raise ValueError("give the schema with .schema(...)")

    def reader(self, schema) -> DataSourceReader:
        return MonthlyReader(
            self.options["path"], schema.names, self.options.get("partition", "month")
        )


def register_monthly(spark) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(MonthlySource)
