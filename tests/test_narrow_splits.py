"""What is shuffled and written for splits, windows and metrics is narrow."""
from datetime import datetime, timedelta

import pytest

from tidemark.plans import registry as G


@pytest.fixture(scope="module")
def orders_dir(spark, tmp_path_factory):
    """60 orders with two lines each, every second one of status F."""
    d = str(tmp_path_factory.mktemp("orders"))
    day = datetime(2020, 1, 1)
    orders = [(i, i % 7, "F" if i % 2 else "O", 10.0 * i, day + timedelta(days=i), "1-URGENT") for i in range(60)]
    spark.createDataFrame(orders, "o_orderkey LONG, o_custkey LONG, o_orderstatus STRING, o_totalprice DOUBLE, o_orderdate TIMESTAMP_NTZ, "
                          "o_orderpriority STRING").write.parquet(f"{d}/orders.parquet")
    lines = [(i, (i + j) % 5, 1, j, 2.0, 5.0 + j, 0.1 * j, 0.05, "R", "F", day) for i in range(60) for j in range(2)]
    spark.createDataFrame(lines, "l_orderkey LONG, l_partkey LONG, l_suppkey LONG, l_linenumber INT, l_quantity DOUBLE, l_extendedprice DOUBLE, "
                          "l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ").write.parquet(f"{d}/lineitem.parquet")
    spark.createDataFrame([(i, f"part {i}", f"Brand#{i}", "t", 1, 1.0) for i in range(5)],
                          "p_partkey LONG, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE").write.parquet(f"{d}/part.parquet")
    return d


def test_splits_and_windows_leave_the_strings_behind(spark, orders_dir):
    assert set(G._temporal(spark, orders_dir).columns) == {"sample_id", "label", "sample_date", "split", "cutoff"}
    assert set(G._windowed(spark, orders_dir).columns) == {"sample_id", "label", "sample_date", "window_id"}
    assert set(G._tail(spark, orders_dir).columns) == {"sample_id", "label", "sample_date", "window_id", "part"}
    assert G._temporal(spark, orders_dir).count() == 60


def test_metric_records_write_narrow_sides(spark, orders_dir):
    cv, holdout = G._metric_records(spark, orders_dir)
    sides = next(v for k, v in G.FX._CACHE.items() if k[2] == "sides" and k[3] == orders_dir)
    assert set(sides.columns) == {"sample_id", "label", "sample_date", "split", "protocol"}
    assert sides.count() == 120 and holdout.count() == 10 and cv.select("protocol").distinct().count() == 2


def test_learners_input_leaves_the_strings_behind(spark, orders_dir):
    wanted = {"sample_id", "label", "sample_date", *G.FIXTURE.log_cols, *G.FIXTURE.scale_cols}
    assert set(G._model_input(spark, orders_dir).columns) == wanted
    assert set(G._prep_input(spark, orders_dir).columns) == wanted | {"split", "cutoff"}


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_lists_and_means_are_made_once(spark):
    from pyspark.sql import functions as F
    from tidemark.functions import lists as L
    from tidemark.operators import drift as D
    s = spark.createDataFrame([("[[]]",), ("[]",), ("['a', ['b', 'c']]",), ("[null]",), ("['null']",), ("a,b",)], "v string")
    assert _plan(s.select(L.signature_count("v"))).count("split(") == _plan(s.select(L.list_from_literal("v"))).count("split(")
    assert [r[0] for r in s.select(L.signature_count("v")).collect()] == [0, 1, 3, 1, 1, 2]
    p = spark.createDataFrame([([.2, .6, None],)], "a array<double>")
    once = F.filter("a", lambda x: x.isNotNull())
    assert _plan(p.select(D.disagreement(F.col("a")))).count("filter(") == _plan(p.select(once)).count("filter(")
    got = [r[0] for r in p.select(D.disagreement(F.col("a"))).collect()]
    assert got == [pytest.approx(0.4)]
