"""Rows with a NULL key keep their group's totals, ranks and runs."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators import aggregates as A
from tidemark.operators import ranking as R
from tidemark.operators.ordered import exact_quantiles, place


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame([(None, 1, 5), (None, 2, 7), ("a", 3, 9)], "k string, id int, v int")


def test_group_totals(rows):
    got = {r.id: r.total for r in A.with_group_totals(rows, ["k"], total=F.sum("v")).collect()}
    assert got == {1: 12, 2: 12, 3: 9}


def test_median_and_quantiles(rows):
    assert {r.k: r.median for r in A.exact_median(rows, ["k"], "v").collect()} == {None: 6.0, "a": 9.0}
    assert {r.k: r.q500 for r in exact_quantiles(rows, ["k"], "v", [0.5]).collect()} == {None: 5, "a": 9}


def test_top_share(rows):
    assert sorted(r.id for r in A.top_share(rows, ["k"], "id", "v", 0.1).collect()) == [2, 3]


def test_long_runs(rows):
    runs = R.state_runs(rows, ["k"], ["id"], F.lit(1))
    assert sorted(r.id for r in R.long_run_rows(runs, 2).collect()) == [1, 2]


def test_no_key_is_never_one_task(spark):
    """Neither the scan without a key nor the keys that span chunks meet in one task."""
    data = spark.range(1000).withColumn("k", F.col("id") % 300)
    scan = place(data, [], ["id"]).running_sum(n=F.lit(1).cast("long"))
    assert scan.chunked
    lines = scan.df._jdf.queryExecution().executedPlan().toString().split("\n")
    assert not any("Coalesce 1" in line for line in lines)
    for line, below in zip(lines, lines[1:]):  # only the one row of each chunk may meet
        assert "SinglePartition" not in line or "HashAggregate(keys=[_chunk" in below
    keyed = place(data, ["k"], ["id"], mode="chunked", chunks=5).running_sum(n=F.lit(1).cast("long"))
    assert "Coalesce 1" not in keyed.df._jdf.queryExecution().executedPlan().toString()
    assert keyed.df.filter("k = 7").agg(F.max("n")).first()[0] == 4
