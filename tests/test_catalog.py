"""Every registered query against its SQL twin, and plans of the physical claims."""

import pytest

import __spark_entry__ as entry
from oracle import compare, connect
from tidemark.plans.catalog import NATIVE


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_equals_sql(spark, sf, con, name):
    assert compare(entry.queries()[name](spark, sf), con, entry.oracle_sql()[name]) is None


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.oracle_sql())))
def test_runs(spark, sf, name):
    assert entry.queries()[name](spark, sf).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(spark, sf):
    text = plan(NATIVE["march_orders"](spark, sf))
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in text
    assert "o_custkey" not in text.split("ReadSchema")[1]


def test_top_k_keeps_k_per_task(spark, sf):
    assert "TakeOrderedAndProject" in plan(NATIVE["top3_products"](spark, sf))


def test_no_python_in_the_hot_path(spark, sf):
    for name in ("nation_summary", "customer_summary", "cost_anomalies", "question_categories", "sessions"):
        text = plan(NATIVE[name](spark, sf))
        assert "ArrowEvalPython" not in text and "MapInPandas" not in text


def test_no_cross_joins(spark, sf):
    for name in ("vector_topk", "co_purchase", "record_matches", "point_in_time", "asof_events"):
        text = plan(NATIVE[name](spark, sf))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_durable_root_needs_a_shared_folder(spark, monkeypatch):
    from tidemark import session

    assert session.durable_root(spark)

    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default):
                return default

    with pytest.raises(RuntimeError):
        session.durable_root(Session())
