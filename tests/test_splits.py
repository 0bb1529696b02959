import math

import pytest
from pyspark.sql import functions as F

from tidemark.config import Roles
from tidemark.operators import splits as S
from tidemark.operators.ranking import seeded_hash, seeded_rank

R = Roles()


def counts(df):
    return {(r["split"], r["label"]): r["count"] for r in df.groupBy("split", "label").count().collect()}


def test_random_split_strata(tiny_combined):
    c = counts(S.random_split(tiny_combined, R))
    assert c[("test", 1)] == math.ceil(30 * 0.2) and c[("test", 0)] == math.ceil(20 * 0.2)
    a = S.random_split(tiny_combined, R, seed=1).filter("split = 'test'").select("sample_id").collect()
    b = S.random_split(tiny_combined, R, seed=1).filter("split = 'test'").select("sample_id").collect()
    assert sorted(a) == sorted(b)


def test_temporal_no_lookahead(tiny_combined):
    t = S.temporal_split(tiny_combined, R)
    v = S.validate_temporal(t, R).first()
    assert v["no_lookahead"]
    c = counts(t)
    assert c[("test", 1)] == 6 and c[("train", 1)] == 24
    assert c[("test", 0)] == 4


def test_temporal_errors(spark, tiny_combined):
    with pytest.raises(ValueError):
        S.temporal_split(tiny_combined.drop("sample_date"), R)
    with pytest.raises(ValueError):
        S.check_temporal_input(tiny_combined.filter("label = 0"), R)
    bad = tiny_combined.withColumn("sample_date", F.lit(None).cast("date"))
    with pytest.raises(ValueError):
        S.check_temporal_input(bad, R)


def test_window_cutoffs_monotone(tiny_combined):
    c = [r["cutoff_micros"] for r in S.window_cutoffs(tiny_combined, R, 5).orderBy("cutoff_idx").collect()]
    assert len(c) == 6 and c == sorted(c)


def test_windows_and_tail(tiny_combined):
    w = S.assign_windows(tiny_combined, R, 5)
    pos = {r["window_id"]: r["count"] for r in w.filter("label = 1").groupBy("window_id").count().collect()}
    neg = sorted(r["count"] for r in w.filter("label = 0").groupBy("window_id").count().collect())
    assert sum(pos.values()) == 30 and neg == [4, 4, 4, 4, 4]
    t = S.calibration_tail(w, R, 0.15)
    assert t.count() == 50
    cal = t.filter("part = 'calibration' AND label = 1").groupBy("window_id").count().collect()
    assert all(r["count"] >= 1 for r in cal)


def test_folds(tiny_combined):
    f = S.assign_folds(tiny_combined, R, 10)
    sizes = sorted(r["count"] for r in f.groupBy("fold").count().collect())
    assert sizes == [5] * 10


def test_seeded_rank_is_sort(spark):
    df = spark.range(3000).withColumnRenamed("id", "sample_id").withColumn("g", F.col("sample_id") % 3)
    r = seeded_rank(df, "sample_id", 7, by=["g"], out="r")
    got = {(x["g"], x["r"]): x["sample_id"] for x in r.collect()}
    rows = df.withColumn("h", seeded_hash("sample_id", 7)).collect()
    for g in range(3):
        order = sorted((x for x in rows if x["g"] == g), key=lambda x: (x["h"], x["sample_id"]))
        assert [got[(g, i)] for i in range(len(order))] == [x["sample_id"] for x in order]


def test_prevalence_sample(spark):
    df = spark.range(5000).withColumnRenamed("id", "sample_id").withColumn("label", (F.col("sample_id") % 3 == 0).cast("int"))
    s = S.prevalence_sample(df, R, 500, 0.10)
    assert s.count() == 500 and s.filter("label = 1").count() == 50


def test_bad_input_raises(spark):
    import pytest
    kind = "sample_id STRING, label INT, sample_date DATE"
    from datetime import date
    good = [("a", 1, date(2020, 1, 1)), ("b", 1, date(2020, 2, 1)), ("c", 0, None)]
    for bad, words in ((("x", 1, None), "lack a value"), (("x", None, None), "other than 0 and 1"), (("x", 2, None), "other than 0 and 1")):
        with pytest.raises(ValueError, match=words):
            S.temporal_split(spark.createDataFrame([*good, bad], kind), R)
    with pytest.raises(ValueError, match="label 1"):
        S.temporal_split(spark.createDataFrame(good[2:], kind), R)


def test_no_row_is_lost(spark):
    from datetime import date
    kind = "sample_id STRING, label INT, sample_date DATE, window_id INT"
    rows = [(f"p{i}", 1, date(2020, 1, 1 + i % 5) if i % 4 else None, i % 2) for i in range(40)]
    rows += [(f"n{i}", 0, None, i % 2) for i in range(11)] + [("u", None, None, 0)]
    df = spark.createDataFrame(rows, kind)
    assert S.random_split(df, R).count() == 52
    tail = S.calibration_tail(df.filter("label IS NOT NULL"), R, 0.15)
    assert tail.count() == 51 and tail.filter("sample_date IS NULL AND label = 1 AND part = 'calibration'").count() == 0
