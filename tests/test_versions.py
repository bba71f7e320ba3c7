import time
from datetime import datetime

import pytest
from pyspark.sql import functions as F

import fixtures as X
from tidemark.operators import versions as V
from tidemark.sources.monthly import register_monthly

MONTH = {"column": "order_ts", "transform": "month"}


@pytest.fixture
def lake(spark, tmp_path):
    data = V.Dataset(spark, str(tmp_path / "lake"))
    one = spark.createDataFrame(X.LAKE_BATCH_1, X.LAKE)
    data.create(one.schema, MONTH)
    data.append(one)
    return data


def second(spark):
    return spark.createDataFrame(X.LAKE_BATCH_2, X.LAKE)


def test_append_and_time_travel(spark, lake):
    mark = int(time.time() * 1000)
    time.sleep(0.05)
    lake.append(second(spark))
    assert lake.read(version=1).count() == 5 and lake.read().count() == 8
    assert lake.read(at_ms=mark).count() == 5
    assert lake.read(offset_s=-5).count() == 8
    with pytest.raises(ValueError):
        lake.read(version=9)
    months = {r.part: r.rows for r in lake.partitions().collect()}
    assert months == {"2024-01": 2, "2024-02": 2, "2024-03": 3, "2024-04": 1}
    assert lake.files().agg(F.sum("rows")).first()[0] == 8


def test_schema_evolution_and_summary(spark, lake):
    lake.append(second(spark))
    lake.add_column("discount_pct", "float")
    assert lake.read().filter("discount_pct IS NULL").count() == 8
    s = lake.summary().first()
    assert (s.schemas, s.versions, s.head) == (2, 4, 3)
    lake.append(second(spark).withColumn("discount_pct", F.lit(1.5).cast("float")))
    assert lake.read().filter("discount_pct = 1.5").count() == 3
    assert [r.operation for r in lake.history().collect()] == ["create", "append", "append", "add_column", "append"]


def test_rename_drop_reorder(spark, lake):
    lake.rename_column("product", "item")
    lake.append(second(spark).withColumnRenamed("product", "item"))
    assert lake.read().filter("item IS NOT NULL").count() == 8
    assert lake.read(version=1).columns[2] == "product"
    lake.drop_column("quantity")
    assert "quantity" not in lake.read().columns
    lake.add_column("quantity", "int")
    assert lake.read().filter("quantity IS NOT NULL").count() == 0  # old values stay gone
    names = sorted(lake.read().columns)
    lake.reorder_columns(names)
    assert lake.read().columns == names
    lake.delete_keys(spark.createDataFrame([("Mouse",)], "item string"))
    assert lake.read().count() == 7 and lake.delete_backlog().first().deleted_keys == 1
    lake.drop_column("item")
    assert lake.read().count() == 7  # the delete still applies
    lake.compact()
    assert lake.read().count() == 7 and lake.delete_backlog().count() == 0
    lake.append(second(spark).drop("product"))
    assert lake.read().count() == 10 and lake.read().filter("quantity IS NOT NULL").count() == 3


def test_time_range_prunes_folders(spark, lake):
    lake.append(second(spark))
    rows = lake.read(start=datetime(2024, 3, 5), end=datetime(2024, 4, 1))
    assert rows.count() == 2
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "_part" in plan.split("PartitionFilters")[1].split("]")[0]


def test_replayed_batch_adds_nothing(spark, lake):
    a = lake.append(second(spark), batch="b1")
    assert lake.append(second(spark), batch="b1") == a
    assert lake.read().count() == 8


def test_two_writers_collide(spark, lake):
    last = lake._last()
    lake._commit(last.version + 1, last.version, "append", [1], [], {}, lake.read().schema)
    with pytest.raises(Exception, match="(?i)already exists"):
        lake._commit(last.version + 1, last.version, "append", [1], [], {}, lake.read().schema)


def test_half_written_version_is_not_seen(spark, lake):
    second(spark).write.parquet(f"{lake.root}/data/_v=7")
    assert lake.read().count() == 5
    assert lake.orphans().count() >= 1


def test_layout_change_delete_compact_expire(spark, lake):
    lake.set_layout({"column": "customer_id", "transform": "bucket", "width": 4})
    lake.append(second(spark))
    assert lake.read().count() == 8
    lake.delete_keys(spark.createDataFrame([("C1",)], "customer_id string"))
    lake.delete_keys(spark.createDataFrame([("C2",)], "customer_id string"))
    assert lake.read().count() == 3
    lake.append(spark.createDataFrame([("O009", "C1", "Cable", 1, 5.0, datetime(2024, 5, 1))], X.LAKE))
    assert lake.read().count() == 4  # rows after the delete are new
    before = lake.read().collect()
    lake.point("keep", 1)
    lake.compact()
    assert sorted(lake.read().collect()) == sorted(before)
    assert lake.resolve().deletes == []
    removed = lake.expire(before_ms=1 << 62)
    assert removed and lake.read().count() == 4
    assert lake.read(ref="keep").count() == 5  # pinned versions survive
    assert not any(p.endswith("_v=1") for p in removed)


def test_layout_jobs(spark, tmp_path):
    rows = spark.range(4000).select("id", F.pmod(F.xxhash64("id"), F.lit(1000)).alias("a"), F.pmod(F.xxhash64(-F.col("id")), F.lit(1000)).alias("b"))
    rows.repartition(8).write.parquet(str(tmp_path / "plain"))
    V.sorted_layout(rows, F.lit("x"), ["a"], 8).write.parquet(str(tmp_path / "sorted"))
    V.z_ordered(rows, ["a", "b"], 16).write.parquet(str(tmp_path / "z"))

    def skipped(name, column):
        return V.files_to_read(V.file_ranges(spark, str(tmp_path / name), column), 10, 20).first().skipped_share

    assert skipped("plain", "a") == 0 and skipped("sorted", "a") >= 0.75
    assert skipped("z", "a") >= 0.5 and skipped("z", "b") >= 0.5
    deep = V.clustering_depth(V.file_ranges(spark, str(tmp_path / "plain"), "a")).first().max_depth
    flat = V.clustering_depth(V.file_ranges(spark, str(tmp_path / "sorted"), "a"), mode="chunked", chunks=3).first().max_depth
    assert deep == 8 and flat <= 2
    assert spark.read.parquet(str(tmp_path / "z")).exceptAll(rows).count() == 0


def test_advice(spark):
    tb = float(1 << 40)
    rows = spark.createDataFrame([(0.5 * tb,), (2 * tb,), (11 * tb,)], "b double")
    assert [r.a for r in rows.orderBy("b").select(V.partition_advice(F.col("b")).alias("a")).collect()] == ["month", "day", "day + bucket(user_id, 128)"]
    risk = V.identity_risk(spark.range(5000).select("id", (F.col("id") % 3).alias("k")), ["id", "k"], most=100)
    assert {r.column_name: r.too_many for r in risk.collect()} == {"id": True, "k": False}


def test_monthly_source_prunes(spark, tmp_path):
    register_monthly(spark)
    rows = spark.range(300).select("id", F.concat(F.lit("2024-0"), F.col("id") % 6 + 1).alias("month"))
    rows.write.partitionBy("month").option("compression", "snappy").parquet(str(tmp_path / "m"))
    src = spark.read.format("monthly").schema("id long, month string").load(f"file://{tmp_path}/m")
    assert src.count() == 300
    late = src.filter("month >= '2024-05' AND id % 2 = 0")
    assert late.count() == rows.filter("month >= '2024-05' AND id % 2 = 0").count()
    plan = late._jdf.queryExecution().executedPlan().toString()
    assert "2024-05" not in plan  # the source took the month filter
    assert "% 2" in plan  # the other one stays with Spark


def test_compaction_sorts_no_more_than_its_rows_in_a_task(spark, tmp_path):
    data = V.Dataset(spark, str(tmp_path / "many"))
    rows = spark.range(6000).select(F.col("id").alias("k"), (F.col("id") % 3).cast("string").alias("tenant"))
    data.create(rows.schema, {"column": "tenant", "transform": "identity", "sort": ["k"]})
    data.append(rows)
    data.compact(most_rows=1000)
    files = data.files().collect()
    assert len(files) >= 6 and max(r.rows for r in files) <= 1500
    assert sorted(r.k for r in data.read().collect()) == list(range(6000))
    data.compact()
    assert len(data.files().collect()) == 3
