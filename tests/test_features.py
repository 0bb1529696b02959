import pytest
from pyspark.sql import functions as F

from tidemark.config import FeatureSpec
from tidemark.functions import features as FE
from tidemark.functions import lists as L


def one(spark, s, expr):
    return spark.createDataFrame([(s,)], "s STRING").select(expr(F.col("s")).alias("v")).first()["v"]


@pytest.mark.parametrize("s,n", [("['a', 'b', 'c']", 3), ("", 0), (None, 0), ("[unclosed", 0), ("a|b|c", 3),
                                 ("a, b", 2), ("['x',]", 1), ('["a", "b"]', 2), ("[]", 0), ("  ", 0)])
def test_list_sizes(spark, s, n):
    assert one(spark, s, L.list_size) == n


def test_list_items_and_status(spark):
    assert one(spark, "'a'| \"b\" |", L.list_from_literal) == ["a", "b"]
    assert one(spark, "[unclosed", L.parse_status) == "malformed"
    assert one(spark, None, L.parse_status) == "empty"
    assert one(spark, "['a']", L.parse_status) == "ok"


@pytest.mark.parametrize("s,v", [("['UPX v0.89.6 - v1.02']", 1), ("ACProtect 1.3x DLL", 1),
                                 ("Plain executable", 0), (None, 0), ("upx lower case", 0)])
def test_packed(spark, s, v):
    assert one(spark, s, lambda c: L.contains_any(c, FeatureSpec().packer_patterns)) == v


@pytest.mark.parametrize("s,v", [("['LoadLibraryA', 'GetProcAddress']", 1), ("['printf', 'malloc', 'free']", 0),
                                 ("[]", 0), (None, 0), ("['loadlibrarya']", 0)])
def test_dangerous(spark, s, v):
    assert one(spark, s, lambda c: L.any_member(c, FeatureSpec().dangerous_names)) == v


@pytest.mark.parametrize("s,v", [("[]", 1), (None, 0), ("", 0), ("['a', 'b']", 2), ("[['a', 'b'], 'c']", 3),
                                 ("a, b, c", 3), ("[bad", 1)])
def test_signature_count(spark, s, v):
    assert one(spark, s, L.signature_count) == v


def test_engineer_all_columns_and_anomalies(spark):
    rows = [("['k.dll', 'u.dll']", "['LoadLibraryA']", "['UPX']", "2014-06-15 12:00:00"),
            ("[]", "['printf']", None, "1969-12-31 00:00:00"),
            (None, None, "[]", "2100-01-01 00:00:00"),
            ("['a']", "[]", "x", None)]
    df = spark.createDataFrame(rows, "ImportedDlls STRING, ImportedSymbols STRING, Identify STRING, "
                                     "FormatedTimeDateStamp STRING")
    out = FE.engineer(df).collect()
    assert [r["formatted_timedatestamp_year"] for r in out] == [2014, 1969, 2100, None]
    assert [r["time_alignment_anomaly"] for r in out] == [0, 1, 1, 1]
    assert [r["n_imported_dlls"] for r in out] == [2, 0, 0, 1]
    assert [r["dll_count_anomaly"] for r in out] == [0, 1, 1, 0]
    assert [r["imports_dangerous_api"] for r in out] == [1, 0, 0, 0]
    assert [r["identify_is_packed"] for r in out] == [1, 0, 0, 0]
    assert set(FE.ENGINEERED) <= set(df.columns) | set(FE.engineer(df).columns)
    assert df.columns == ["ImportedDlls", "ImportedSymbols", "Identify", "FormatedTimeDateStamp"]


def test_engineer_missing_sources(spark):
    df = spark.createDataFrame([(1,)], "x INT")
    r = FE.engineer(df).first()
    assert r["n_imported_dlls"] == 0 and r["formatted_timedatestamp_year"] is None
    assert r["time_alignment_anomaly"] == 1 and r["dll_count_anomaly"] == 1


@pytest.mark.parametrize("n,v", [(0, 1), (5, 0), (50, 0), (150, 1)])
def test_dll_anomaly(spark, n, v):
    assert spark.range(1).select(FE.count_anomaly(F.lit(n), 100).alias("v")).first()["v"] == v


def test_literals_with_white_space_and_bare_words(spark):
    from tidemark.functions import lists as L
    cases = {"\n['a','b']": ["a", "b"], "\t[ 'a' ]\n": ["a"], "[null, true]": [], "['null', 'x,true,y']": ["null", "x,true,y"],
             "a |\tb": ["a", "b"], "[1, 2]": ["1", "2"], "['a', NaN]": []}
    df = spark.createDataFrame([(k,) for k in cases], "s STRING").select("s", L.list_from_literal("s").alias("v"))
    assert {r["s"]: r["v"] for r in df.collect()} == cases
