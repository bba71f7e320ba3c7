"""Reports whose numbers depend on written files: checked against the files themselves."""

import pytest
from pyspark.sql import functions as F

from tidemark.plans.catalog import NATIVE, ORACLES


def rows(spark, sf, name):
    return NATIVE[name](spark, sf).collect()


def test_no_constant_twins():
    for name in ("version_log", "table_summary", "version_backlog", "file_health", "orphan_files", "codec_sizes",
                 "sorted_layout_skips", "z_order_skips", "clustering_depth", "rle_size", "column_sketches", "sketch_members"):
        assert name not in ORACLES


def test_partition_files_and_health(spark, sf):
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    parts = rows(spark, sf, "partition_files")
    assert sum(r["rows"] for r in parts) == orders.count()
    assert len(parts) == orders.select(F.date_format("o_orderdate", "yyyy-MM")).distinct().count()
    assert all(r.files >= 1 and r.bytes > 100 for r in parts)
    (health,) = rows(spark, sf, "file_health")
    assert health.files == sum(r.files for r in parts) and health.needs_compaction
    assert health.min_mb <= health.avg_mb <= health.max_mb < 1


def test_layouts_skip_files(spark, sf):
    skips = {r.layout: r for r in rows(spark, sf, "sorted_layout_skips")}
    assert skips["plain"].touched == skips["plain"].files == 8
    assert skips["sorted"].touched <= 2 and skips["sorted"].skipped_share >= 0.7
    for r in rows(spark, sf, "z_order_skips"):
        assert r.skipped_share == pytest.approx(1 - r.touched / r.files) and r.skipped_share >= 0.5
    depth = {r.layout: r for r in rows(spark, sf, "clustering_depth")}
    assert depth["plain"].max_depth == 8 and depth["sorted"].max_depth <= 2


def test_sizes(spark, sf):
    n = spark.read.parquet(f"{sf}/orders.parquet").count()
    codecs = {r.codec: r for r in rows(spark, sf, "codec_sizes")}
    assert set(codecs) == {"zstd", "snappy", "gzip", "lz4_raw"} and all(r["rows"] == n and r.bytes > 1000 for r in codecs.values())
    assert codecs["zstd"].bytes < codecs["snappy"].bytes
    forms = {r.form: r for r in rows(spark, sf, "rle_size")}
    assert forms["points"]["rows"] == spark.read.parquet(f"{sf}/events.parquet").count() >= forms["runs"]["rows"] > 0
    assert forms["points"].bytes > 0 and forms["runs"].bytes > 0


def test_sketches_are_close(spark, sf):
    lines = spark.read.parquet(f"{sf}/lineitem.parquet")
    for r in rows(spark, sf, "column_sketches"):
        exact = lines.select(r.column_name).distinct().count()
        assert abs(r.distinct_values - exact) <= 0.2 * exact
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    for r in rows(spark, sf, "sketch_members"):
        exact = orders.filter(F.year("o_orderdate") == int(r.period)).select("o_custkey").distinct().count()
        assert abs(r.members - exact) <= 0.05 * exact + 1


def test_rows_are_clustered_and_sorted(spark, sf):
    laid = rows(spark, sf, "clustered_layout")
    task = {}
    for r in laid:
        assert task.setdefault(r.o_custkey, r.task) == r.task
    ordered = sorted(laid, key=lambda r: r.place)
    for a, b in zip(ordered, ordered[1:]):
        assert a.task != b.task or (a.o_custkey, a.o_orderdate) <= (b.o_custkey, b.o_orderdate)


def test_versions(spark, sf):
    log = sorted(rows(spark, sf, "version_log"), key=lambda r: r.version)
    assert [(r.version, r.parent, r.operation) for r in log] == [(0, None, "create"), (1, 0, "append"), (2, 1, "append"), (3, 2, "add_column")]
    (summary,) = rows(spark, sf, "table_summary")
    assert (summary.versions, summary.schemas, summary.layouts, summary.head) == (4, 2, 1, 3)
    (backlog,) = rows(spark, sf, "version_backlog")
    assert (backlog.versions, backlog.oldest_is_recent) == (3, True)
    assert rows(spark, sf, "orphan_files")
    (expired,) = rows(spark, sf, "expired_versions")
    assert expired.old_gone and expired.versions_left == 1
