"""Versioned datasets and file layout over the orders table."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from tidemark.operators import versions as V
from tidemark.plans.frames import events
from tidemark.plans.registry import query, table
from tidemark.session import fresh_path
from tidemark.sources.files import data_files, profile

MONTHLY = {"column": "o_orderdate", "transform": "month"}
SPLIT = datetime(1999, 1, 1)


def _dataset(spark, sf):
    """Version 0 empty, version 1 the older orders, version 2 the newer ones."""
    rows = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    data = V.Dataset(spark, fresh_path(spark, "dataset"))
    data.create(rows.schema, MONTHLY)
    data.append(rows.filter(F.col("o_orderdate") < F.lit(SPLIT)))
    data.append(rows.filter(F.col("o_orderdate") >= F.lit(SPLIT)))
    return data


def _count(df, label):
    return df.agg(F.lit(label).alias("state"), F.count("*").alias("n"))


@query(
    "time_travel",
    """SELECT 'version 0' AS state, 0::BIGINT AS n UNION ALL
    SELECT 'version 1', COUNT(*) FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01' UNION ALL
    SELECT 'head', COUNT(*) FROM orders UNION ALL SELECT 'tag', COUNT(*) FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01'""",
)
def time_travel(spark, sf):
    """Reads as of versions and of a tag."""
    data = _dataset(spark, sf)
    data.point("first-load", 1)
    return (
        _count(data.read(version=0), "version 0")
        .unionByName(_count(data.read(version=1), "version 1"))
        .unionByName(_count(data.read(), "head"))
        .unionByName(_count(data.read(ref="first-load"), "tag"))
    )


@query(
    "pruned_read",
    """SELECT o_orderkey FROM orders WHERE o_orderdate >= TIMESTAMP '1998-11-20' AND o_orderdate < TIMESTAMP '1999-02-10'""",
)
def pruned_read(spark, sf):
    """Hidden partitioning: a time range becomes a partition predicate."""
    return _dataset(spark, sf).read(start=datetime(1998, 11, 20), end=datetime(1999, 2, 10)).select("o_orderkey")


@query(
    "evolved_schema",
    """SELECT COUNT(*) AS n, 0::BIGINT AS with_discount FROM orders""",
)
def evolved_schema(spark, sf):
    """A new column: rows written before it read NULL."""
    data = _dataset(spark, sf)
    data.add_column("discount_pct", "float")
    return data.read().agg(F.count("*").alias("n"), F.count("discount_pct").alias("with_discount"))


@query("version_log")
def version_log(spark, sf):
    data = _dataset(spark, sf)
    data.add_column("discount_pct", "float")
    return data.history().select("version", "parent", "operation")


@query("table_summary")
def table_summary(spark, sf):
    data = _dataset(spark, sf)
    data.add_column("discount_pct", "float")
    return data.summary().select("versions", "schemas", "layouts", "head")


@query("version_backlog")
def version_backlog(spark, sf):
    """How many versions have piled up, and whether the oldest is within seven days."""
    summary = _dataset(spark, sf).summary()
    age_ms = F.unix_millis(F.current_timestamp()) - F.col("oldest_ms")
    return summary.select("versions", (age_ms < 7 * 86_400_000).alias("oldest_is_recent"))


@query("partition_files")
def partition_files(spark, sf):
    """Files, rows and bytes per partition from the file footers."""
    return _dataset(spark, sf).partitions().select("part", "files", "rows", "bytes")


@query("file_health")
def file_health(spark, sf):
    """Number and sizes of the monthly files, and whether they are too small."""
    return V.file_health(_dataset(spark, sf).files())


@query(
    "compacted",
    """SELECT o_orderstatus, COUNT(*) AS n, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total FROM orders GROUP BY 1""",
)
def compacted(spark, sf):
    """Rewritten into larger files; the rows stay the same."""
    data = _dataset(spark, sf)
    data.compact(target_bytes=1 << 20)
    return data.read().groupBy("o_orderstatus").agg(
        F.count("*").alias("n"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("total")
    )


@query("expired_versions")
def expired_versions(spark, sf):
    """After a compaction the old versions expire and their folders go."""
    data = _dataset(spark, sf)
    data.compact()
    removed = data.expire(before_ms=1 << 62)
    left = data.log().count()
    return data.read().agg(
        F.count("*").alias("n"), F.lit(len(removed) == 2).alias("old_gone"), F.lit(left).cast("long").alias("versions_left")
    )


@query("orphan_files")
def orphan_files(spark, sf):
    """Files of a write that was never committed."""
    data = _dataset(spark, sf)
    table(spark, sf, "orders").write.parquet(f"{data.root}/data/_v=99")
    return data.orphans()


@query(
    "layout_change",
    """SELECT strftime(o_orderdate, '%Y') AS y, COUNT(*) AS n FROM orders GROUP BY 1""",
)
def layout_change(spark, sf):
    """Later versions are laid out by year; both layouts read as one table."""
    rows = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    data = V.Dataset(spark, fresh_path(spark, "dataset"))
    data.create(rows.schema, MONTHLY)
    data.append(rows.filter(F.col("o_orderdate") < F.lit(SPLIT)))
    data.set_layout({"column": "o_orderdate", "transform": "year"})
    data.append(rows.filter(F.col("o_orderdate") >= F.lit(SPLIT)))
    return data.read().groupBy(F.date_format("o_orderdate", "yyyy").alias("y")).agg(F.count("*").alias("n"))


@query(
    "delete_set",
    """SELECT 'before' AS state, COUNT(*) AS n FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)
    UNION ALL SELECT 'compacted', COUNT(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)""",
)
def delete_set(spark, sf):
    """Deletes kept as a key set and applied at read; a compaction bakes them in."""
    data = _dataset(spark, sf)
    gone = table(spark, sf, "customer").filter("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey"))
    data.delete_keys(gone)
    before = _count(data.read(), "before")
    data.compact()
    return before.unionByName(_count(data.read(), "compacted"))


@query(
    "tenant_tables",
    """SELECT c_mktsegment AS tenant, COUNT(*) AS n FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') GROUP BY 1""",
)
def tenant_tables(spark, sf):
    """A dataset laid out per tenant, read through an entitlement."""
    from tidemark.operators.joins import entitled

    data = V.Dataset(spark, fresh_path(spark, "tenants"))
    rows = table(spark, sf, "customer").withColumnRenamed("c_mktsegment", "tenant")
    data.create(rows.schema, {"column": "tenant", "transform": "identity"})
    data.append(rows)
    grants = rows.select("tenant").distinct().filter(F.col("tenant").isin("BUILDING", "MACHINERY"))
    return entitled(data.read(), grants, ["tenant"]).groupBy("tenant").agg(F.count("*").alias("n"))


def _two_layouts(spark, sf):
    """Orders in eight files at random, and sorted by customer."""
    rows = table(spark, sf, "orders")
    a, b = fresh_path(spark, "plain"), fresh_path(spark, "sorted")
    rows.repartition(8, "o_orderkey").write.parquet(a)
    V.sorted_layout(rows, F.lit("all"), ["o_custkey"], 8).write.parquet(b)
    return {"plain": a, "sorted": b}


@query("sorted_layout_skips")
def sorted_layout_skips(spark, sf):
    """Files that a customer lookup touches and the share it skips, before and after sorting."""
    out = None
    for label, path in _two_layouts(spark, sf).items():
        found = V.files_to_read(V.file_ranges(spark, path, "o_custkey"), 10, 12)
        one = found.select(F.lit(label).alias("layout"), "files", "touched", "skipped_share")
        out = one if out is None else out.unionByName(one)
    return out


@query("z_order_skips")
def z_order_skips(spark, sf):
    """Z-order on customer and price: filters on either column skip files."""
    path = fresh_path(spark, "zorder")
    V.z_ordered(table(spark, sf, "orders"), ["o_custkey", "o_totalprice"], 16).write.parquet(path)
    a = V.files_to_read(V.file_ranges(spark, path, "o_custkey"), 10, 12).withColumn("filter", F.lit("customer"))
    b = V.files_to_read(V.file_ranges(spark, path, "o_totalprice"), 1000.0, 9000.0).withColumn("filter", F.lit("price"))
    return a.unionByName(b).select("filter", "files", "touched", "skipped_share")


STATS = " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, COUNT(*) AS row_count, COUNT(*) - COUNT({c}) AS nulls, COUNT(DISTINCT {c}) AS distinct_values, CAST(MIN({c}) AS VARCHAR) AS min_value, CAST(MAX({c}) AS VARCHAR) AS max_value FROM orders"""
    for c in ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
)


@query("column_stats", STATS)
def column_stats(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    return profile(rows, exact=True).select("column_name", "row_count", "nulls", "distinct_values", "min_value", "max_value")


@query("clustering_depth")
def clustering_depth(spark, sf):
    """Overlap of the files' customer ranges, for random and sorted files."""
    out = None
    for label, path in _two_layouts(spark, sf).items():
        depth = V.clustering_depth(V.file_ranges(spark, path, "o_custkey"))
        one = depth.select(F.lit(label).alias("layout"), "max_depth", "avg_depth")
        out = one if out is None else out.unionByName(one)
    return out


@query(
    "partition_advice",
    """SELECT strftime(ts, '%Y-%m-%d') AS day, CASE WHEN COUNT(*) * 4294967296.0 > 10 * 1099511627776.0 THEN 'day + bucket(user_id, 128)'
    WHEN COUNT(*) * 4294967296.0 >= 1099511627776.0 THEN 'day' ELSE 'month' END AS advice FROM events GROUP BY 1""",
)
def partition_advice(spark, sf):
    """Granularity per day if every event stood for 4 GiB."""
    daily = events(spark, sf).groupBy(F.col("ts").cast("date").alias("day")).agg((F.count("*") * 4294967296.0).alias("b"))
    return daily.select("day", V.partition_advice(F.col("b")).alias("advice"))


@query(
    "identity_risk",
    """SELECT 'o_custkey' AS column_name, COUNT(DISTINCT o_custkey) > 1000000 AS too_many FROM orders
    UNION ALL SELECT 'o_orderstatus', COUNT(DISTINCT o_orderstatus) > 1000000 FROM orders""",
)
def identity_risk(spark, sf):
    out = V.identity_risk(table(spark, sf, "orders"), ["o_custkey", "o_orderstatus"], most=1_000_000)
    return out.select("column_name", "too_many")


@query(
    "run_files",
    "SELECT 'rows' AS what, COUNT(*) AS plain FROM events",
)
def run_files(spark, sf):
    """Row count of an event copy, taken from its file footers."""
    path = fresh_path(spark, "events")
    events(spark, sf).repartition(4).write.parquet(path)
    return data_files(spark, path).agg(F.lit("rows").alias("what"), F.sum("rows").alias("plain"))
