"""Registry of named queries with their ANSI-SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Plan = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Plan] = {}
ORACLES: dict[str, str] = {}
NATIVE: dict[str, Plan] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def present(df: DataFrame) -> DataFrame:
    """Boundary types for comparison: bigint, double, text, boolean.

    Only for the exchange with another engine; operators keep native types.
    """
    out = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        kind = field.dataType
        if isinstance(kind, (T.IntegerType, T.ShortType, T.ByteType)):
            column = column.cast("long")
        elif isinstance(kind, (T.DecimalType, T.FloatType)):
            column = column.cast("double")
        elif isinstance(kind, T.DateType):
            column = F.date_format(column, "yyyy-MM-dd")
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss")
        out.append(column.alias(field.name))
    return df.select(*out)


def query(name: str, sql: str | None = None) -> Callable[[Plan], Plan]:
    """Register a plan; ``sql`` is the same question for the comparing engine."""

    def register(plan: Plan) -> Plan:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        NATIVE[name] = plan
        QUERIES[name] = lambda spark, sf_dir: present(plan(spark, sf_dir))
        if sql:
            ORACLES[name] = sql
        return plan

    return register
