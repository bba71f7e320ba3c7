"""The chunked scan must equal the plain window, also with one hot key."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators.ordered import (
    exact_quantiles,
    global_ranks,
    islands,
    place,
    ranks,
    with_row_number,
)


@pytest.fixture(scope="module")
def rows(spark):
    hot = spark.range(600).select(
        F.when(F.col("id") % 3 == 0, F.lit(None).cast("string"))
        .when(F.col("id") % 3 == 1, "hot")
        .otherwise(F.concat(F.lit("k"), F.col("id") % 7))
        .alias("k"),
        F.col("id").alias("t"),
        F.when(F.col("id") % 5 == 0, None).otherwise(F.col("id") * 7 % 11).alias("v"),
    )
    return hot


def scan(rows, mode):
    o = place(rows, ["k"], ["t"], mode=mode, chunks=8)
    o = with_row_number(o).previous(pv=F.col("v"), pt=F.col("t"))
    o = o.following(nv=F.col("v")).running_sum(s=F.col("v")).latest(lv=F.col("v"))
    return islands(o, F.col("_p").eqNullSafe(F.col("v")) == F.lit(False), {"_p": F.col("v")})


def test_chunked_equals_window(rows):
    a, b = scan(rows, "window"), scan(rows, "chunked")
    assert a.df.columns == b.df.columns
    assert a.df.exceptAll(b.df).count() == 0 and b.df.exceptAll(a.df).count() == 0
    w = Window.partitionBy("k").orderBy("t")
    plain = rows.withColumn("rn", F.row_number().over(w).cast("long"))
    assert plain.exceptAll(a.df.select("k", "t", "v", "rn")).count() == 0


def test_carry_is_bounded_by_chunks(rows):
    o = place(rows, ["k"], ["t"], mode="chunked", chunks=8)
    assert o._df.select("_chunk").distinct().count() > 1
    spans = o._df.groupBy("k").agg(F.countDistinct("_chunk").alias("n"))
    assert spans.filter("n > 1").count() >= 1


@pytest.mark.parametrize("mode", ["window", "chunked"])
def test_global_ranks(rows, mode):
    data = rows.filter("v is not null")
    got = global_ranks(data, "v", ["t"], mode=mode, chunks=8)
    w = Window.orderBy(F.desc("v"))
    want = data.select(
        "t",
        F.row_number().over(Window.orderBy(F.desc("v"), "t")).cast("long").alias("row_num"),
        F.rank().over(w).cast("long").alias("rank"),
        F.dense_rank().over(w).cast("long").alias("dense_rank"),
    )
    assert want.exceptAll(got.select(*want.columns)).count() == 0


@pytest.mark.parametrize("mode", ["window", "chunked"])
def test_ranks_in_keys_put_nulls_last(rows, mode):
    got = ranks(rows, ["k"], "v", ["t"], mode=mode, chunks=8)
    w = Window.partitionBy("k").orderBy(F.desc_nulls_last("v"))
    want = rows.select(
        "k", "t",
        F.rank().over(w).cast("long").alias("rank"),
        F.dense_rank().over(w).cast("long").alias("dense_rank"),
        F.row_number().over(Window.partitionBy("k").orderBy(F.desc_nulls_last("v"), "t")).cast("long").alias("row_num"),
    )
    assert want.exceptAll(got.select(*want.columns)).count() == 0


@pytest.mark.parametrize("values", ["1", "t", "t div 60", "if(t < 300, null, t % 2)"])
def test_ranks_of_ties_over_many_chunks(spark, values):
    """One value over all chunks, none tied, runs that end at and inside chunks."""
    data = spark.range(600).selectExpr("id % 2 k", "id t").selectExpr("k", "t", f"{values} v")
    got = ranks(data, ["k"], "v", ["t"], mode="chunked", chunks=16)
    want = ranks(data, ["k"], "v", ["t"], mode="window")
    assert got.columns == want.columns and got.dtypes == want.dtypes
    assert want.exceptAll(got).count() == 0 and got.count() == 600
    w = Window.orderBy(F.desc_nulls_last("v"))
    plain = data.select("t", F.rank().over(w).cast("long").alias("rank"), F.dense_rank().over(w).cast("long").alias("dense_rank"))
    every = ranks(data, [], "v", ["t"], chunks=16)
    assert plain.exceptAll(every.select(*plain.columns)).count() == 0


@pytest.mark.parametrize("mode", ["window", "chunked"])
def test_exact_quantiles(rows, mode):
    got = exact_quantiles(rows, ["k"], "v", [0.5], mode=mode, chunks=5)
    want = rows.groupBy("k").agg(F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY v)").cast("long").alias("q500"))
    a = {r.k: r.q500 for r in got.collect()}
    b = {r.k: r.q500 for r in want.collect()}
    assert {k: v for k, v in b.items() if k in a} == a


def test_auto_mode_measures_the_largest_key(rows):
    assert not place(rows, ["k"], ["t"]).chunked
    hot = place(rows, ["k"], ["t"], hot_rows=100)
    assert hot.chunked and hot._df.select("_chunk").distinct().count() > 1
    same = with_row_number(hot).df.exceptAll(with_row_number(place(rows, ["k"], ["t"])).df)
    assert same.count() == 0


def test_cut_keeps_types_and_survives_odd_ones(spark):
    from tidemark.session import cut

    plain = spark.range(5).select("id", F.struct("id").alias("s"), F.array("id").alias("a"))
    assert cut(plain).schema == plain.schema or cut(plain).dtypes == plain.dtypes
    odd = spark.range(5).select("id", F.lit(None).alias("nothing"), F.expr("INTERVAL 1 DAY").alias("i"))
    assert cut(odd).count() == 5 and cut(odd).dtypes == odd.dtypes


def test_quantiles_of_millions_of_rows_without_keys(spark):
    """From 2.4 million rows on, the rank of the ninth decile in thousandths passes 32 bits."""
    rows = spark.range(3_000_000).select((F.col("id") % 10).alias("v"))
    got = exact_quantiles(rows, [], "v", [i / 10 for i in range(1, 10)]).first()
    assert list(got) == list(range(9))
