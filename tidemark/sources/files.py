"""Readers and writers. Schemas are explicit; inference is left to profiling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import cut

CORRUPT = "_corrupt"


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def infer_csv(spark: SparkSession, path: str) -> DataFrame:
    """Header row and inferred types; costs one more pass over the files."""
    return spark.read.csv(path, header=True, inferSchema=True)


def load_csv(
    spark: SparkSession, path: str, schema: T.StructType, checks: Column | None = None
) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejected rows with their raw line): a load that continues past bad rows.

    The parsed rows are materialised once: a query that reads few columns would parse
    only those and overlook bad values in the others.
    """
    wide = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    rows = (
        spark.read.schema(wide)
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .csv(path)
    )
    rows = cut(rows)
    bad = F.col(CORRUPT).isNotNull()
    if checks is not None:
        bad = bad | ~F.coalesce(checks, F.lit(False))
    return rows.filter(~bad).drop(CORRUPT), rows.filter(bad)


def read_json(spark: SparkSession, glob: str, schema: T.StructType | str) -> DataFrame:
    """Only the fields in ``schema`` are parsed."""
    return spark.read.schema(schema).json(glob)


def external_table(spark: SparkSession, name: str, path: str) -> DataFrame:
    """Register files left in place as a table."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING parquet LOCATION '{path}'")
    return spark.table(name)


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV with header. ``single_file`` is for small reports only."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", True).csv(path)


def write_by_month(
    df: DataFrame, path: str, ts: str, name: str, codec: str = "zstd", mode="overwrite"
) -> None:
    """Parquet partitioned by the month of ``ts``.

    Rows are range-partitioned by month and time first: each task then writes few
    months, and a month with much data is written by several tasks.
    """
    months = df.withColumn(name, F.date_format(ts, "yyyy-MM"))
    (
        months.repartitionByRange(name, ts)
        .write.mode(mode)
        .option("compression", codec)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(name)
        .parquet(path)
    )


def read_since(spark: SparkSession, path: str, ts: str, name: str, start) -> DataFrame:
    """Rows from ``start`` on; the month predicate prunes folders."""
    first = start.strftime("%Y-%m")
    rows = spark.read.schema(_with_partition(spark, path, name)).parquet(path)
    return rows.filter((F.col(name) >= first) & (F.col(ts) >= F.lit(start)))


def _with_partition(spark: SparkSession, path: str, name: str) -> T.StructType:
    # Partition text like 2024-01 must not be inferred as a date.
    found = spark.read.parquet(path).schema
    kept = [f for f in found.fields if f.name != name]
    return T.StructType([*kept, T.StructField(name, T.StringType())])


def bytes_per_codec(df: DataFrame, root: str, codecs: Sequence[str]) -> DataFrame:
    """Write once per codec and report rows and bytes, for choosing a codec."""
    spark = df.sparkSession
    out = None
    for codec in codecs:
        path = f"{root}/{codec}"
        df.write.mode("overwrite").option("compression", codec).parquet(path)
        one = data_files(spark, path).agg(
            F.lit(codec).alias("codec"),
            F.sum("rows").alias("rows"),
            F.sum("bytes").alias("bytes"),
        )
        out = one if out is None else out.unionByName(one)
    return out


def data_files(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Rows and bytes per data file; row counts come from the file footers."""
    reader = spark.read.schema(schema) if schema else spark.read
    rows = reader.parquet(path)
    return rows.groupBy(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_size").alias("bytes"),
    ).agg(F.count("*").alias("rows"))


# --- profiling ---


def null_counts(df: DataFrame) -> DataFrame:
    """One row: the number of NULLs in every column, in a single pass."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])


def profile(df: DataFrame, exact: bool = False, samples: int = 0) -> DataFrame:
    """One row per column: rows, nulls, distinct values, min, max, sample values.

    Without ``exact`` this is one pass with sketches. With it, each column is read
    on its own, pre-aggregated by value, so no distinct set is held in one task.
    """
    if exact:
        parts = [_exact_profile(df, f) for f in df.schema.fields]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out
    aggs = [F.count("*").alias("_rows")]
    for i, f in enumerate(df.schema.fields):
        c = F.col(f"`{f.name}`")
        text = c.cast("string")
        aggs += [
            F.count_if(c.isNull()).alias(f"n{i}"),
            F.approx_count_distinct(c).alias(f"d{i}"),
            F.min(c).cast("string").alias(f"lo{i}"),
            F.max(c).cast("string").alias(f"hi{i}"),
        ]
        if samples:
            aggs.append(F.min(text).alias(f"s{i}"))
    wide = df.agg(*aggs)
    cards = [
        F.struct(
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            F.col("_rows").alias("row_count"),
            F.col(f"n{i}").alias("nulls"),
            F.col(f"d{i}").alias("distinct_values"),
            F.col(f"lo{i}").alias("min_value"),
            F.col(f"hi{i}").alias("max_value"),
        )
        for i, f in enumerate(df.schema.fields)
    ]
    return wide.select(F.inline(F.array(*cards)))


def _exact_profile(df: DataFrame, field: T.StructField) -> DataFrame:
    c = F.col(f"`{field.name}`")
    values = df.groupBy(c.alias("v")).agg(F.count("*").alias("n"))
    return values.agg(
        F.lit(field.name).alias("column_name"),
        F.lit(field.dataType.simpleString()).alias("data_type"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
        F.coalesce(F.sum(F.when(F.col("v").isNull(), F.col("n"))), F.lit(0)).alias("nulls"),
        F.count("v").alias("distinct_values"),
        F.min("v").cast("string").alias("min_value"),
        F.max("v").cast("string").alias("max_value"),
    )


def common_values(df: DataFrame, column: str, k: int = 10) -> DataFrame:
    """The ``k`` most frequent values of a column, for a schema card."""
    return (
        df.groupBy(F.col(column).cast("string").alias("value"))
        .agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), "value")
        .limit(k)
    )


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    out = None
    for name, df in tables.items():
        one = df.agg(F.lit(name).alias("table_name"), F.count("*").alias("row_count"))
        out = one if out is None else out.unionByName(one)
    return out
