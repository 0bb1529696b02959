import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
NAMES = [q for q in E.oracle_sql() if q.startswith("op")]


def test_one_query_for_each_operator():
    named = [q for q in E.queries() if q.startswith("op")]
    assert sorted(int(q[2:].split("_")[0]) for q in named) == list(range(1, 14))


@pytest.mark.parametrize("name", NAMES)
def test_queries_with_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = E.queries()[name](spark, SF).toPandas()
    want = con.sql(E.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    columns = sorted(got.columns)
    key = lambda df: sorted(map(repr, df[columns].astype(object).values.tolist()))
    assert key(got) == key(want)
