"""Bloom filters of partition folders, for point lookups on a column the files are not sorted by."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import cut

HASHES = 7
MOST_POWER = 40


def _position(k: int, value: Column) -> Column:
    return F.xxhash64(F.lit(k), value)


def part_filters(rows: DataFrame, part: str, column: str, bits: int = 10) -> DataFrame:
    """(part, words, word, mask): the set 64-bit words of a Bloom filter for each part.

    A filter has ``words`` words, a power of two, with at least about ``bits`` bits for each
    distinct value: one lookup in a hundred or fewer looks into a part in vain. NULLs have
    no place in it. Words are combined where the rows are read, so what moves is the
    filters, not the values; a part of any size is built by many tasks.
    """
    value = F.col(f"`{column}`")
    live = rows.select(F.col(f"`{part}`").alias("part"), value.alias("value")).filter("value IS NOT NULL")
    power = F.greatest(F.ceil(F.log2(F.col("n") * bits / 64)), F.lit(0)).cast("int")
    sizes = cut(
        live.groupBy("part").agg(F.approx_count_distinct("value", 0.02).alias("n"))
        .select("part", F.pow(F.lit(2.0), power).cast("long").alias("words"))
    )
    bit = F.explode(F.array(*[F.pmod(_position(k, F.col("value")), F.col("words") * 64) for k in range(HASHES)]))
    return (
        live.join(sizes, "part")
        .select("part", "words", bit.alias("bit"))
        .groupBy("part", "words", F.shiftright("bit", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, CAST(bit & 63 AS INT))")).alias("mask"))
    )


def parts_with(filters: DataFrame, asked: DataFrame, column: str) -> DataFrame:
    """(part, value): the parts that may hold an asked value. A part that holds it is never missing.

    Asked values find words by an equi-join on (words, word); a part stays if all of its
    bits are set. ``column`` must have the type of the filtered one.
    """
    values = asked.select(F.col(f"`{column}`").alias("value")).filter("value IS NOT NULL").distinct()
    powers = F.explode(F.array(*[F.lit(1 << p).cast("long") for p in range(MOST_POWER)]))
    sized = values.withColumn("words", powers).join(F.broadcast(filters.select("words").distinct()), "words", "left_semi")
    bit = F.explode(F.array(*[F.pmod(_position(k, F.col("value")), F.col("words") * 64) for k in range(HASHES)]))
    probes = sized.select("value", "words", bit.alias("bit")).withColumn("word", F.shiftright("bit", 6))
    hit = probes.join(filters, ["words", "word"]).filter(F.expr("(mask & shiftleft(1L, CAST(bit & 63 AS INT))) <> 0"))
    return hit.groupBy("part", "value").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") == HASHES).select("part", "value")


def write_parts(rows: DataFrame, path: str, part: Column, column: str, bits: int = 10) -> None:
    """Writes the rows in a folder for each ``part`` (as text, 'none' where NULL), and the filters beside them."""
    rows.withColumn("part", F.coalesce(part.cast("string"), F.lit("none"))).write.partitionBy("part").parquet(f"{path}/rows")
    part_filters(_rows(rows.sparkSession, path), "part", column, bits).write.parquet(f"{path}/filters")


def _rows(spark: SparkSession, path: str) -> DataFrame:
    """The written rows; the part is read as text, whatever it looks like."""
    sample = spark.read.parquet(f"{path}/rows")
    fields = [f for f in sample.schema.fields if f.name != "part"]
    return spark.read.schema(T.StructType([*fields, T.StructField("part", T.StringType())])).parquet(f"{path}/rows")


def lookup(spark: SparkSession, path: str, asked: DataFrame, column: str) -> DataFrame:
    """The rows of ``write_parts`` whose column has an asked value; repeated and NULL values
    ask nothing more. Spark prunes the other folders by the list of candidate parts, which
    stays a table; within the folders the values decide.
    """
    rows = _rows(spark, path)
    wanted = asked.select(F.col(f"`{column}`").cast(rows.schema[column].dataType).alias(column)).distinct()
    found = parts_with(spark.read.parquet(f"{path}/filters"), wanted, column)
    parts = cut(found.groupBy("part").agg(F.count(F.lit(1)).alias("asked")))
    return rows.join(parts.filter("asked > 0").select("part"), "part", "left_semi").join(wanted, column, "left_semi")


def skipped(filters: DataFrame, asked: DataFrame, column: str) -> DataFrame:
    """One row: parts, candidates (parts that a lookup reads), skipped_share."""
    every = filters.select("part").distinct()
    hit = parts_with(filters, asked, column).select("part").distinct().withColumn("hit", F.lit(1))
    both = every.join(hit, "part", "left").agg(F.count(F.lit(1)).alias("parts"), F.count("hit").alias("candidates"))
    return both.withColumn("skipped_share", F.try_divide(F.col("parts") - F.col("candidates"), F.col("parts")))
