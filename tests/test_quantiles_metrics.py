import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import metrics as MT
from tidemark.operators.quantiles import exact_quantiles, value_bucket, value_cells


def test_exact_quantiles(spark):
    rng = np.random.default_rng(3)
    vals = np.round(rng.normal(size=4000), 2)
    df = spark.createDataFrame([("a" if i % 2 else "b", float(v)) for i, v in enumerate(vals)], "g STRING, v DOUBLE")
    probs = [0.0, 0.05, 0.5, 0.95, 1.0]
    got = exact_quantiles(df, ["g"], "v", probs).collect()
    for r in got:
        x = np.array([v for i, v in enumerate(vals) if ("a" if i % 2 else "b") == r["g"]])
        assert r["value"] == pytest.approx(np.quantile(x, r["prob"]), abs=1e-12)


def brute_auc(s, y):
    pos = [a for a, b in zip(s, y) if b == 1]
    neg = [a for a, b in zip(s, y) if b == 0]
    tot = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    return tot / (len(pos) * len(neg))


def test_auc_ties(spark):
    rng = np.random.default_rng(5)
    s = np.round(rng.random(600), 1)
    y = (rng.random(600) < s).astype(int)
    df = spark.createDataFrame([(int(i % 2), float(a), int(b)) for i, (a, b) in enumerate(zip(s, y))],
                               "g INT, s DOUBLE, y INT")
    got = {r["g"]: r["auc"] for r in MT.auc_by_group(df, ["g"], "s", "y").collect()}
    for g in (0, 1):
        idx = [i for i in range(600) if i % 2 == g]
        assert got[g] == pytest.approx(brute_auc(s[idx], y[idx]), abs=1e-12)
    assert MT.auc_by_group(df, [], "s", "y").first()["auc"] == pytest.approx(brute_auc(s, y))


def test_confusion_spine(spark):
    df = spark.createDataFrame([(1, 1), (1, 1)], "label INT, decision INT")
    cm = {(r["label"], r["decision"]): r["n"] for r in MT.confusion_matrix(df, "label", "decision").collect()}
    assert cm == {(0, 0): 0, (0, 1): 0, (1, 0): 0, (1, 1): 2}


def test_cv_summary_and_gap(spark):
    cv = [(m, p, f, (0.97 if p == "random" else 0.65) - 0.001 * f, 0.9, 100, 10, 1.0)
          for m in ("random_forest", "xgboost") for p in ("random", "temporal") for f in range(10)]
    cvd = spark.createDataFrame(cv, "model_name STRING, protocol STRING, fold INT, auc DOUBLE, accuracy DOUBLE, "
                                    "n_train INT, n_val INT, fit_seconds DOUBLE")
    ho = spark.createDataFrame([(m, p, 0.9 if p == "random" else 0.8, 0.95 if p == "random" else 0.7, 100, 20, 1.0)
                                for m in ("random_forest", "xgboost") for p in ("random", "temporal")],
                               "model_name STRING, protocol STRING, auc DOUBLE, accuracy DOUBLE, n_train INT, "
                               "n_test INT, fit_seconds DOUBLE")
    h = MT.drift_gap_table(cvd, ho).orderBy("ord").collect()
    assert [r["model_name"] for r in h] == ["random_forest", "xgboost"]
    assert all(r["drift_gap_cv_auc"] > 0 and r["drift_gap_holdout_auc"] > 0 and r["drift_gap_holdout_acc"] > 0 for r in h)
    assert len([c for c in h[0].asDict() if c not in ("model_name", "ord")]) == 11
    s = MT.cv_summary(cvd).filter("protocol = 'random'").first()
    assert s["auc_std"] == pytest.approx(round(np.std([0.97 - 0.001 * f for f in range(10)], ddof=1), 4))
    lines = MT.render_report(MT.drift_gap_table(cvd, ho), MT.cv_summary(cvd)).orderBy("line_no").collect()
    text = [r["line"] for r in lines]
    assert [t for t in text if t.startswith("###")] == list(MT.REPORT_TITLES) and sum("| xgboost |" in t for t in text) == 4
    assert text[4:6] == [MT.REPORT_HEADS[0], "|---|---|---|---|---|---|---|"] and len({r["line_no"] for r in lines}) == len(lines)


def test_quantiles_of_repeated_odd_and_extreme_values(spark):
    groups = {"flag": [0.0] * 300 + [1.0] * 700, "signs": [-5.5, -0.0, 0.0, 3.0, 1e-300, -1e300, 2.0], "one": [4.0],
              "steps": [float(i) for i in range(1001)], "inf": [float("inf"), 1.0, -float("inf")]}
    rows = [(g, v) for g, x in groups.items() for v in x] + [("flag", None), ("flag", float("nan")), ("none", None)]
    probs = [0.0, 0.1, 0.25, 0.5, 0.975, 1.0]
    got = exact_quantiles(spark.createDataFrame(rows, "g STRING, v DOUBLE"), ["g"], "v", probs).collect()
    assert {r["g"] for r in got} == set(groups) and len(got) == len(groups) * len(probs)
    for r in got:
        if r["g"] != "inf":
            assert r["value"] == pytest.approx(np.quantile(groups[r["g"]], r["prob"]), rel=1e-12, abs=1e-12)
        assert r["n"] == len(groups[r["g"]])


def test_value_bucket_never_falls(spark):
    v = sorted([0.0, -1.0, 1.0, 0.1, 0.2, 0.5, 0.999999, 1e-310, -1e-310, 1e308, -1e308, 2.0**52, 1.0000001])
    df = spark.createDataFrame([(x,) for x in v], "x DOUBLE").select("x", value_bucket(F.col("x")).alias("b"))
    b = [r["b"] for r in df.orderBy("x").collect()]
    assert b == sorted(b) and len(set(b)) == len(b) - 1


def test_crowded_buckets_are_split_in_order(spark, monkeypatch):
    from tidemark.operators import quantiles as Q
    monkeypatch.setattr(Q, "CROWD", 64)
    rng = np.random.default_rng(3)
    micros = 1.3e15 + rng.integers(0, 10**11, 3000).astype(float)
    groups = {"micros": micros, "minus": -micros, "near one": 1 - 10.0 ** -rng.uniform(3.5, 15, 3000), "ties": np.repeat(micros[:50], 40),
              "wide": np.concatenate([micros[:200], rng.normal(0, 5, 500), [np.inf, -np.inf]])}
    rows = [(g, float(x)) for g, v in groups.items() for x in v]
    df = spark.createDataFrame(rows, "g STRING, v DOUBLE")
    cells = value_cells(df.distinct(), ["g"], "v", "b").toPandas()
    for name, of in cells.sort_values("v").groupby("g"):
        assert of["b"].is_monotonic_increasing
        if name in ("micros", "minus", "near one"):
            assert of.groupby("b").size().max() <= 64 < of.groupby(of["b"] // Q._SPLITS).size().max()
    probs = [0.0, 0.01, 0.3, 0.5, 0.9, 1.0]
    for r in exact_quantiles(df, ["g"], "v", probs).collect():
        if np.isfinite(r["value"]):
            assert r["value"] == pytest.approx(np.quantile(groups[r["g"]], r["prob"]), rel=1e-15)


def test_auc_of_crowded_scores(spark, monkeypatch):
    from tidemark.operators import quantiles as Q
    monkeypatch.setattr(Q, "CROWD", 16)
    rng = np.random.default_rng(4)
    score = np.round(1 - 10.0 ** -rng.uniform(3.5, 9, 800), 8)
    label = (rng.random(800) < 0.4).astype(int)
    pos, neg = score[label == 1], score[label == 0]
    want = np.mean((pos[:, None] > neg) + 0.5 * (pos[:, None] == neg))
    df = spark.createDataFrame([("m", float(s), int(y)) for s, y in zip(score, label)], "g STRING, s DOUBLE, y INT")
    assert MT.auc_by_group(df, ["g"], "s", "y").first()["auc"] == pytest.approx(want, rel=1e-12)
