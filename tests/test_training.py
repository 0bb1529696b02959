import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.plans import training as TR


@pytest.fixture(scope="module")
def dense(spark):
    rng = np.random.default_rng(0)
    rows = []
    for i in range(100):
        y = i % 2
        rows.append((i, y, *map(float, rng.normal(2 if y else -2, 0.8, 27))))
    cols = [f"f{j}" for j in range(27)]
    return spark.createDataFrame(rows, "sample_id INT, label INT, " + ", ".join(f"{c} DOUBLE" for c in cols)), cols


def test_presets_have_report_names():
    assert len(TR.PRESETS) == 7 and len(TR.REPORT_NAMES) == 7


FEW = {"forest": {"numTrees": 20}, "boosted_depthwise": {"maxIter": 5}, "boosted_leafwise": {"maxIter": 5}, "boosted_symmetric": {"maxIter": 5}}


@pytest.mark.parametrize("name", list(TR.PRESETS))
def test_models_fit(spark, dense, name):
    df, cols = dense
    preset = TR.PRESETS[name].with_params(**FEW[name]) if name in FEW else TR.PRESETS[name]
    train, test = df.filter("sample_id < 70"), df.filter("sample_id >= 70")
    fp, model, _ = TR.fit_model(train, preset, cols[:5], cols[5:])
    out = TR.positive_probability(model.transform(TR._assemble(fp.transform(test, keep=["label"]), fp.columns)))
    assert out.filter((F.col("p") >= 0.5).cast("int") != F.col("prediction").cast("int")).count() == 0
    scores = TR.evaluate(out.select("label", "p"))
    assert scores["auc"] > 0.9 and scores["accuracy"] > 0.85


def test_neural_net_on_unequal_classes(spark, dense):
    df, cols = dense
    train = df.filter("sample_id < 80 AND (label = 0 OR sample_id % 5 = 0)")
    fp, model, _ = TR.fit_model(train, TR.PRESETS["neural_net"], cols[:5], cols[5:])
    assert TR.evaluate(TR.score(df.filter("sample_id >= 80"), fp, model, ["label"]))["accuracy"] > 0.85


def test_a_failing_fit_is_raised_and_a_one_class_fold_skipped(spark, dense):
    df, cols = dense

    def broken(n_features, n_rows):
        raise RuntimeError("no such model")

    with pytest.raises(RuntimeError, match="no such model"):
        TR.cross_validate(df, "x", broken, cols[:5], cols[5:], "random", k=2)
    one = df.filter("label = 0 OR sample_id = 1")
    assert TR.cross_validate(one, "tree", TR.PRESETS["tree"], cols[:5], cols[5:], "random", k=3).count() == 0


def test_windowed_ensemble(spark, tiny_combined):
    df = tiny_combined.withColumn("label", F.col("label"))
    ens = TR.fit_windowed(df, TR.PRESETS["tree"], ["x"], ["y"], k=3)
    assert sum(ens.active) >= 1 and all(0.0 <= a <= 1.0 for a in ens.in_acc)
    res = TR.evaluate_ensemble(ens, df).first()
    assert res["n_test"] == 50 and 0.0 <= res["blocking_accuracy"] <= 1.0


def test_pipeline_stages_and_save(spark, tiny_combined, tmp_path):
    from pyspark.ml import Pipeline, PipelineModel
    from tidemark.plans.stages import Preprocessor, WindowedEnsemble
    pm = Pipeline(stages=[Preprocessor(["x"], ["y"])]).fit(tiny_combined)
    out = pm.transform(tiny_combined)
    assert abs(out.agg(F.avg("y")).first()[0]) < 1e-9 and out.count() == 50
    model = WindowedEnsemble("tree", ["x"], ["y"], k=3).fit(tiny_combined)
    dec = model.transform(tiny_combined.select("sample_id", "label", "x", "y"))
    assert dec.filter("verdict IS NULL").count() == 0
    model.ensemble.save(str(tmp_path / "ens"))
    again = TR.WindowedEnsemble.load(spark, str(tmp_path / "ens"))
    key = lambda df: sorted(map(tuple, df.collect()), key=repr)
    data = tiny_combined.select("sample_id", "label", "x", "y")
    assert key(again.decide(data, ["sample_id"])) == key(model.ensemble.decide(data, ["sample_id"]))
    both = Pipeline(stages=[Preprocessor(["x"], ["y"]), WindowedEnsemble("tree", ["x"], ["y"], k=3)])
    both.write().overwrite().save(str(tmp_path / "unfitted"))
    fitted = Pipeline.load(str(tmp_path / "unfitted")).fit(tiny_combined)
    fitted.write().overwrite().save(str(tmp_path / "fitted"))
    loaded = PipelineModel.load(str(tmp_path / "fitted"))
    columns = ["sample_id", "x", "probability", "verdict"]
    assert key(loaded.transform(tiny_combined).select(*columns)) == key(fitted.transform(tiny_combined).select(*columns))
    assert again.window_dates == model.ensemble.window_dates and again.active == model.ensemble.active


@pytest.mark.parametrize("bad", [2, None])
def test_balancing_other_labels_raises(tiny_combined, bad):
    with pytest.raises(ValueError, match="0 or 1"):
        TR.balance_by_resampling(tiny_combined.withColumn("label", F.when(F.col("sample_id") == "p003", F.lit(bad).cast("int")).otherwise(F.col("label"))))


def test_balance_and_batch_score(spark, tiny_combined):
    b = TR.balance_by_resampling(tiny_combined)
    c = {r["label"]: r["count"] for r in b.groupBy("label").count().collect()}
    assert c == {0: 30, 1: 30}
    ens = TR.fit_windowed(tiny_combined, TR.PRESETS["tree"], ["x"], ["y"], k=3)
    rows, metrics = TR.batch_score(ens, tiny_combined)
    m = metrics.first()
    assert rows.count() == 50 and m["tn"] + m["fp"] + m["fn"] + m["tp"] == 50
    assert m["n_allowed"] + m["n_blocked_malware"] + m["n_blocked_uncertain"] == 50
    rows2, none = TR.batch_score(ens, tiny_combined.drop("label"))
    assert none is None and rows2.count() == 50


def test_string_features_can_be_saved(spark, tmp_path):
    from tidemark.config import FIXTURE
    from tidemark.functions.features import ENGINEERED
    from tidemark.plans.stages import StringFeatures
    from tidemark.sources import fixtures as FX
    s = FX.samples(spark, "/root/testdata/sf0.001").limit(50)
    StringFeatures(FIXTURE.features).write().overwrite().save(str(tmp_path / "f"))
    out = StringFeatures.load(str(tmp_path / "f")).transform(s)
    assert set(ENGINEERED) <= set(out.columns) and out.count() == 50


def test_full_experiment_feeds_the_report(spark, tiny_combined):
    from tidemark.operators import metrics as MT
    names = ("logistic", "tree")
    cv, holdout = TR.run_experiment(tiny_combined, {n: TR.PRESETS[n] for n in names}, ["x"], ["y"], k=3)
    records = cv.collect()
    assert len(records) == 2 * 2 * 3 and all(r["n_train"] + r["n_val"] in (39, 40) for r in records)
    table = MT.drift_gap_table(cv, holdout, order=names)
    assert [r["model_name"] for r in table.orderBy("ord").collect()] == list(names)
    assert {(r["model_name"], r["protocol"]) for r in holdout.collect()} == {(n, p) for n in names for p in ("random", "temporal")}
    assert MT.render_report(table, MT.cv_summary(cv)).filter("line LIKE '| tree |%'").count() == 4
