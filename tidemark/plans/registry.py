"""Registered queries: one per operator (or tight group) of the inventory.

Each takes (spark, sf_dir) and returns a DataFrame over the whole driver
tables; ``plans/oracle.py`` holds the DuckDB twin under the same key.
Doubles that come out of aggregations are rounded to 6 decimals on both
sides so the comparison is about semantics, not summation order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import uuid
from functools import reduce

from tidemark.config import CV_FOLDS, FIXTURE
from tidemark.operators import splits as S
from tidemark.sources import fixtures as FX

R = FIXTURE.roles
QUERIES: dict = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def r6(c):
    return F.round(c, 6)


def _dated(spark, d):
    """Of the samples, what splits, windows and metrics need: they are shuffled and
    written several times over, so the strings and features stay behind."""
    return FX.samples(spark, d).select(R.id, R.label, R.date)


def _temporal(spark, d):
    return FX.reuse(spark, ("temporal", d), lambda: S.temporal_split(_dated(spark, d), R))


def _windowed(spark, d):
    def build():
        tr = _temporal(spark, d).filter(F.col("split") == "train").drop("cutoff", "split")
        return S.assign_windows(tr, R, k=5)
    return FX.reuse(spark, ("windowed", d), build)


def _tail(spark, d):
    return FX.reuse(spark, ("tail", d), lambda: S.calibration_tail(_windowed(spark, d), R, 0.15))


# --- splits ---------------------------------------------------------------
@query
def temporal_split_summary(spark: SparkSession, d: str) -> DataFrame:
    split = S.temporal_split(_dated(spark, d), R)
    cut = S.temporal_cutoff(_dated(spark, d), R).select("cutoff").scalar()
    return S.split_summary(split, R).withColumn("cutoff", cut)


@query
def temporal_split_rows(spark, d):
    return _temporal(spark, d).select("sample_id", "label", "split")


@query
def random_split_summary(spark, d):
    return S.split_summary(S.random_split(FX.samples(spark, d).select(R.id, R.label), R), R)


@query
def no_lookahead(spark, d):
    return S.validate_temporal(_temporal(spark, d), R)


@query
def window_cutoffs(spark, d):
    tr = _temporal(spark, d).filter(F.col("split") == "train")
    return S.window_cutoffs(tr, R, 5).select("cutoff_idx", F.round("cutoff_micros").cast("long").alias("cutoff_micros"))


@query
def window_assignment(spark, d):
    return _windowed(spark, d).select("sample_id", "label", "window_id")


@query
def calibration_tail(spark, d):
    return _tail(spark, d).select("sample_id", "window_id", "part")


@query
def stratified_folds(spark, d):
    return S.assign_folds(FX.samples(spark, d), R, 10).select("sample_id", "label", "fold")


@query
def prevalence_sample(spark, d):
    return S.prevalence_sample(FX.samples(spark, d), R, 500, 0.10).select("sample_id", "label", "sample_pos")


@query
def demo_per_class(spark, d):
    t = _temporal(spark, d).filter(F.col("split") == "test").drop("cutoff")
    return S.per_class_sample(t, R).select("sample_id", "label", "pick")


@query
def time_sample(spark, d):
    pos = FX.samples(spark, d).filter(F.col("label") == 1)
    return S.first_months_per_year(pos, "sample_date", 1).select("sample_id", "sample_date")


# --- string features --------------------------------------------------------
from tidemark.functions import features as FE  # noqa: E402
from tidemark.functions import lists as L  # noqa: E402
from tidemark.functions import numeric as N  # noqa: E402

SPEC = FIXTURE.features


@query
def list_parse(spark, d):
    s = FX.samples(spark, d)
    dl, sl = L.list_from_literal("imported_dlls"), L.list_from_literal("imported_symbols")
    return s.select("sample_id",
                    F.size(dl).alias("n_dlls"), F.array_join(dl, "|").alias("dlls_joined"),
                    F.size(sl).alias("n_symbols"), F.array_join(sl, "|").alias("symbols_joined"),
                    L.parse_status("imported_dlls").alias("dll_status"))


@query
def list_features(spark, d):
    e = FE.engineer(FX.samples(spark, d), SPEC)
    return e.select("sample_id", "n_imported_dlls", "n_imported_symbols", "identify_is_packed",
                    "identify_signature_count", "imports_dangerous_api", "dll_count_anomaly")


@query
def timestamp_features(spark, d):
    e = FE.engineer(FX.samples(spark, d), SPEC)
    return e.select("sample_id", "formatted_timedatestamp_year", "time_alignment_anomaly")


@query
def engineered_features(spark, d):
    e = FE.engineer(FX.samples(spark, d), SPEC)
    return e.select("sample_id", "label", *FE.ENGINEERED)


def _raw_strings(spark, d):
    o = FX.table(spark, d, "orders")
    return o.select(F.col("o_orderkey").alias("sample_id"),
                    F.col("o_totalprice").cast("string").alias("price_text"),
                    F.col("o_orderpriority").alias("priority_text"),
                    F.substring("o_orderpriority", 1, 1).alias("priority_digit"),
                    F.col("o_orderstatus").alias("status_text"))


@query
def numeric_coercion(spark, d):
    c = N.coerce_numeric(_raw_strings(spark, d), ["price_text", "priority_text", "priority_digit", "status_text"])
    return c


@query
def coercion_loss(spark, d):
    return N.coercion_loss(_raw_strings(spark, d), ["price_text", "priority_text", "priority_digit", "status_text"])


# --- profiling ----------------------------------------------------------------
from tidemark.operators import profile as P  # noqa: E402
from tidemark.operators import preprocess as M  # noqa: E402


def _daily(spark, d):
    return P.daily_counts(FX.table(spark, d, "lineitem"), "l_shipdate")


@query
def class_balance_by_day(spark, d):
    return P.class_balance_by_day(FX.samples(spark, d), "order_date", "label")


@query
def daily_counts(spark, d):
    return _daily(spark, d)


@query
def monthly_rollup(spark, d):
    m = P.monthly_rollup(_daily(spark, d))
    return m.withColumn("mean_per_day", r6("mean_per_day"))


@query
def empty_periods(spark, d):
    return P.empty_periods(_daily(spark, d))


@query
def timestamp_profile(spark, d):
    return P.timestamp_profile(FX.samples(spark, d), "formatted_ts")


@query
def numeric_describe(spark, d):
    x = P.numeric_describe(FX.samples(spark, d), FX.NUMERIC_COLS)
    return x.select("feature", "count", "null_count", *[r6(c).alias(c) for c in
                    ("mean", "std", "min", "max", "null_pct", "p05", "p50", "p95")])


PROFILE_COLS = ("sample_id", "label", "sample_date", "total_price", "n_lines", "max_discount",
                "imported_dlls", "imported_symbols", "identify", "formatted_ts")


@query
def null_report(spark, d):
    x = P.missingness(FX.samples(spark, d), PROFILE_COLS)
    return x.withColumn("null_pct", r6("null_pct"))


@query
def string_cardinality(spark, d):
    return P.string_cardinality(FX.samples(spark, d), ["imported_dlls", "imported_symbols", "identify", "formatted_ts"])


@query
def near_zero_variance(spark, d):
    s = FE.engineer(FX.samples(spark, d), SPEC)
    x = P.near_zero_variance(s, list(FX.NUMERIC_COLS) + ["dll_count_anomaly", "identify_is_packed"])
    return x.withColumn("mean", r6("mean"))


# --- preprocessing ------------------------------------------------------------
def _featured(spark, d):
    """The samples as learners and the preprocessor see them: their numeric features,
    without the strings that some are made from."""
    return FE.engineer(FX.samples(spark, d), SPEC).select(R.id, R.label, R.date, *FIXTURE.log_cols, *FIXTURE.scale_cols)


def _prep_input(spark, d):
    return FX.reuse(spark, ("prep_input", d), lambda: S.temporal_split(_featured(spark, d), R))


def _fit(spark, d):
    t = _prep_input(spark, d)
    return t, M.fit_preprocessor(t.filter(F.col("split") == "train"), FIXTURE.log_cols, FIXTURE.scale_cols)


@query
def median_impute(spark, d):
    _, fp = _fit(spark, d)
    return fp.stats_frame(spark).select("feature", r6("median").alias("median"))


@query
def scaler_stats(spark, d):
    _, fp = _fit(spark, d)
    return fp.stats_frame(spark).select("feature", *[r6(c).alias(c) for c in ("median", "mean", "std")])


@query
def log_scale_transform(spark, d):
    t, fp = _fit(spark, d)
    x = fp.transform(t.filter(F.col("split") == "test"), keep=["sample_id"])
    return x.unpivot(["sample_id"], list(fp.columns), "feature", "value").withColumn("value", r6("value"))


@query
def leakage_profile(spark, d):
    t, fp = _fit(spark, d)
    x = M.leakage_profile(fp.transform(t, keep=["split"]), fp.columns)
    return x.select("split", "feature", r6("mean").alias("mean"), r6("std").alias("std"), "n_bad")


# --- drift, metrics, decisions ---------------------------------------------------
from tidemark.operators import decision as DC  # noqa: E402
from tidemark.operators import drift as D  # noqa: E402
from tidemark.operators import metrics as MT  # noqa: E402

K = 5
PCOLS = [f"p_{i}" for i in range(K)]


def _p_of(model: "F.Column") -> "F.Column":
    return FX.pseudo_probability(FX.model_uniform(model, F.col("sample_id")), F.col("label"))


def window_meta(spark, d):
    return FX.reuse(spark, ("window_meta", d), lambda: _window_meta(spark, d))


def _window_meta(spark, d):
    """Per window — size, classes, active flag, accuracy of its own
    model on its calibration tail (in_acc) and on the temporal test side
    (recent_acc), newest date. K rows."""
    t = _temporal(spark, d)
    w, tail = _windowed(spark, d), _tail(spark, d)
    sizes = w.groupBy("window_id").agg(F.count(F.lit(1)).alias("n_rows"),
                                       F.count_if(F.col("label") == 1).alias("n_pos"),
                                       F.count_if(F.col("label") != 1).alias("n_neg"),
                                       F.max("sample_date").alias("max_date"))
    cal = tail.filter(F.col("part") == "calibration").groupBy("window_id").agg(
        MT.accuracy((_p_of(F.col("window_id")) >= 0.5).cast("int"), F.col("label")).alias("in_acc"))
    test = t.filter(F.col("split") == "test").withColumn("window_id", F.explode(F.sequence(F.lit(0), F.lit(K - 1))))
    recent = test.groupBy("window_id").agg(
        MT.accuracy((_p_of(F.col("window_id")) >= 0.5).cast("int"), F.col("label")).alias("recent_acc"))
    spine = spark.range(K).select(F.col("id").cast("int").alias("window_id"))
    m = spine.join(sizes, "window_id", "left").join(cal, "window_id", "left").join(recent, "window_id", "left")
    active = (F.coalesce("n_pos", F.lit(0)) > 0) & (F.coalesce("n_neg", F.lit(0)) > 0)
    return m.select("window_id", F.coalesce("n_rows", F.lit(0)).alias("n_rows"),
                    F.coalesce("n_pos", F.lit(0)).alias("n_pos"), F.coalesce("n_neg", F.lit(0)).alias("n_neg"),
                    active.alias("active"),
                    F.when(active, F.coalesce("in_acc", F.lit(0.0))).otherwise(F.lit(0.0)).alias("in_acc"),
                    F.coalesce("recent_acc", F.lit(0.0)).alias("recent_acc"), "max_date")


def _weights(spark, d):
    rows = D.vote_weights(window_meta(spark, d), k=K).orderBy("window_id").collect()  # K rows
    return [r["weight"] for r in rows], [r["active"] for r in rows]


def _decided(spark, d):
    w, a = _weights(spark, d)
    return DC.decide(FX.scores_wide(spark, d, K), PCOLS, w, a)


def _drift_frames(spark, d):
    e = FX.drift_events(spark, d)
    return e.filter(F.col("side") == "train"), e.filter(F.col("side") == "deploy")


@query
def psi_per_feature(spark, d):
    tr, de = _drift_frames(spark, d)
    x = D.psi(tr, de, FX.DRIFT_FEATURES)
    return x.select("feature", r6("psi").alias("psi"), "n_train", "n_deploy")


@query
def psi_average(spark, d):
    tr, de = _drift_frames(spark, d)
    return D.average_psi(D.psi(tr, de, FX.DRIFT_FEATURES)).withColumn("avg_psi", r6("avg_psi"))


@query
def psi_band(spark, d):
    tr, de = _drift_frames(spark, d)
    return D.psi(tr, de, FX.DRIFT_FEATURES).select("feature", D.psi_band(F.col("psi")).alias("band"))


@query
def window_metrics(spark, d):
    m = window_meta(spark, d)
    return m.select("window_id", "n_rows", "n_pos", "n_neg", "active", r6("in_acc").alias("in_acc"),
                    r6("recent_acc").alias("recent_acc"), "max_date")


@query
def accuracy_decay(spark, d):
    m = window_meta(spark, d)
    return m.select("window_id", r6(D.accuracy_decay(F.col("in_acc"), F.col("recent_acc"))).alias("decay"))


@query
def vote_weights(spark, d):
    return D.vote_weights(window_meta(spark, d), k=K).select("window_id", r6("weight").alias("weight"))


@query
def drift_status(spark, d):
    x = D.drift_status(window_meta(spark, d))
    return x.select(r6("newest_acc").alias("newest_acc"), r6("oldest_acc").alias("oldest_acc"),
                    r6("trend").alias("trend"), "trend_class", "per_window", "n_active")


@query
def retrain_alert(spark, d):
    x = D.retrain_alert(window_meta(spark, d))
    return x.select(*[r6(c).alias(c) for c in ("newest_acc", "mean_older", "prev_acc")], "retrain", "sharp_drop")


@query
def disagreement(spark, d):
    s = FX.scores_wide(spark, d, K)
    return s.select("sample_id", r6(D.disagreement(F.array(*PCOLS))).alias("disagreement"))


@query
def weighted_vote(spark, d):
    return _decided(spark, d).select("sample_id", r6("probability").alias("probability"))


@query
def joint_confidence(spark, d):
    return _decided(spark, d).select("sample_id", r6("confidence").alias("confidence"))


@query
def verdicts(spark, d):
    return _decided(spark, d).select("sample_id", "verdict", "is_positive_decision",
                                     F.bround("probability", 4).alias("probability"),
                                     F.bround("confidence", 4).alias("confidence"))


@query
def verdict_counts(spark, d):
    return DC.verdict_counts(_decided(spark, d))


@query
def threshold_sweep(spark, d):
    x = DC.threshold_sweep(_decided(spark, d), label="label")
    return x.withColumn("blocking_accuracy", r6("blocking_accuracy"))


@query
def confusion_matrix(spark, d):
    x = _decided(spark, d).withColumn("decision", F.col("is_positive_decision").cast("int"))
    return MT.confusion_matrix(x, "label", "decision")


def _scores_long(spark, d):
    return FX.scores_long(spark, d, K)


@query
def accuracy_by_model(spark, d):
    s = _scores_long(spark, d)
    return s.groupBy("model_id").agg(r6(MT.accuracy((F.col("p") >= 0.5).cast("int"), F.col("label"))).alias("accuracy"))


@query
def roc_auc_by_model(spark, d):
    x = MT.auc_by_group(_scores_long(spark, d), ["model_id"], "p", "label")
    return x.select("model_id", r6("auc").alias("auc"), "n_pos", "n_neg")


#: The md5 score columns, which are no models, and the report's first heading over them.
SCORE_NAMES = tuple(f"score_{i}" for i in range(K))
SCORE_TITLE = f"### Random vs temporal hold-out, {K} md5 score columns"


def _metric_records(spark, d):
    """cv and hold-out metric records for 5 score columns under both
    protocols: folds on the train side (T6), AUC/accuracy per fold (A13/A14)."""
    s = _dated(spark, d)
    names = F.element_at(F.array(*[F.lit(n) for n in SCORE_NAMES]), F.col("model_id") + 1)
    sides = FX.reuse(spark, ("sides", d), lambda: (
        S.random_split(s, R).withColumn("protocol", F.lit("random"))
        .unionByName(_temporal(spark, d).drop("cutoff").withColumn("protocol", F.lit("temporal")))))
    folds = FX.reuse(spark, ("folds", d), lambda: S.assign_folds(
        sides.filter(F.col("split") == "train"), R, 10, by=["protocol"]))
    models = F.explode(F.sequence(F.lit(0), F.lit(K - 1)))
    in_cv, held = ["model_id", "protocol", "fold"], ["model_id", "protocol"]
    # every metric comes from the counts of each score, made in one pass over the scored rows
    tr = FX.reuse(spark, ("cv_counts", d), lambda: MT.score_counts(
        folds.withColumn("model_id", models).withColumn("p", _p_of(F.col("model_id"))), in_cv, "p", "label"))
    te = FX.reuse(spark, ("holdout_counts", d), lambda: MT.score_counts(
        sides.filter(F.col("split") == "test").withColumn("model_id", models).withColumn("p", _p_of(F.col("model_id"))),
        held, "p", "label"))
    n_train = tr.filter(F.col("model_id") == 0).groupBy("protocol").agg(F.sum(F.col("_p") + F.col("_n")).alias("_nt"))
    cv = MT.auc_from_counts(tr, in_cv).join(MT.accuracy_from_counts(tr, in_cv), in_cv).join(n_train, "protocol") \
        .select(names.alias("model_name"), "protocol", "fold", "auc", "accuracy",
                (F.col("_nt") - F.col("n")).alias("n_train"), F.col("n").alias("n_val"), F.lit(0.0).alias("fit_seconds"))
    ho = MT.auc_from_counts(te, held).join(MT.accuracy_from_counts(te, held), held).join(n_train, "protocol") \
        .select(names.alias("model_name"), "protocol", "auc", "accuracy", F.col("_nt").alias("n_train"),
                F.col("n").alias("n_test"), F.lit(0.0).alias("fit_seconds"))
    return cv, ho


@query
def cv_summary(spark, d):
    cv, _ = _metric_records(spark, d)
    return MT.cv_summary(cv)


@query
def holdout_summary(spark, d):
    _, ho = _metric_records(spark, d)
    return MT.holdout_summary(ho)


@query
def drift_gap_table(spark, d):
    cv, ho = _metric_records(spark, d)
    return MT.drift_gap_table(cv, ho, order=SCORE_NAMES)


@query
def evaluation_report(spark, d):
    """A4: the report's lines; ``experiment_report`` has them for fitted models."""
    cv, ho = _metric_records(spark, d)
    return MT.render_report(MT.drift_gap_table(cv, ho, order=SCORE_NAMES), MT.cv_summary(cv), title=SCORE_TITLE)


def flagship(spark, d):
    """Verdicts for every order plus the ensemble's drift status columns."""
    st = D.drift_status(window_meta(spark, d))
    v = _decided(spark, d).select("sample_id", "label", "verdict", "is_positive_decision",
                                  F.bround("probability", 4).alias("probability"),
                                  F.bround("confidence", 4).alias("confidence"))
    return v.withColumns({"trend_class": st.select("trend_class").scalar(),
                          "n_active": st.select("n_active").scalar()})


# --- explanations ---------------------------------------------------------------
from tidemark.operators import explain as X  # noqa: E402


def _explained(spark, d):
    e = FE.engineer(_decided(spark, d), SPEC)  # X7: enrich before explaining
    return X.explain(e, FIXTURE.rules)


@query
def evidence_bullets(spark, d):
    e = _explained(spark, d)
    return e.select("sample_id", "verdict", F.size("report.why").alias("n_why"),
                    F.array_join("report.why", " || ").alias("why"))


@query
def matched_techniques(spark, d):
    e = _explained(spark, d)
    t = F.transform("report.attack_techniques", lambda s: F.concat(s["id"], F.lit(":"), s["name"]))
    return e.select("sample_id", "verdict", F.size("report.attack_techniques").alias("n_techniques"),
                    F.array_join(t, "|").alias("techniques"))


@query
def recommended_actions(spark, d):
    e = _explained(spark, d)
    return e.select("sample_id", "verdict", F.size("report.recommended_actions").alias("n_actions"),
                    F.array_join("report.recommended_actions", " || ").alias("actions"))


@query
def explanation_report(spark, d):
    e = _explained(spark, d)
    return e.select("sample_id", "verdict", F.col("report.summary").alias("summary"),
                    F.col("report.backend").alias("backend"))


# --- scans and sinks ----------------------------------------------------------------
from tidemark.session import scratch_path  # noqa: E402
from tidemark.sources import files as SRC  # noqa: E402

DAY_DIR = r"day=(\d{4}-\d{2}-\d{2})/"


def _csv_layout(spark, d):
    """Daily CSV folders of 'F' orders plus one undated folder of the rest,
    written once per scale factor into the shared checkpoint folder."""
    key = (spark.sparkContext.applicationId, FX.state(spark, d), d)
    root = _WRITTEN.get(key)
    if root is None:
        root = scratch_path(spark, "csv-" + uuid.uuid4().hex[:12])
        o = FX.table(spark, d, "orders").select(
            F.col("o_orderkey").alias("MD5"), F.col("o_totalprice").cast("string").alias("Size"),
            F.col("o_orderpriority").alias("Identify"), F.col("o_orderstatus"),
            F.to_date("o_orderdate").alias("day"))
        SRC.write_daily_csv(o.filter(F.col("o_orderstatus") == "F").drop("o_orderstatus"), root + "/by-day", "day")
        SRC.write_csv(o.filter(F.col("o_orderstatus") != "F").drop("o_orderstatus", "day"), root + "/undated")
        _WRITTEN[key] = root
    return root


_WRITTEN: dict = {}


@query
def dated_csv_scan(spark, d):
    root = _csv_layout(spark, d)
    x = SRC.read_dated_csv(spark, root + "/by-day", date_regex=DAY_DIR)
    return x.select(F.col("MD5").cast("long").alias("sample_id"), F.col("Size").cast("double").alias("size"),
                    F.col("__sample_date").alias("sample_date"), F.col("Label").alias("label"))


@query
def combined_load(spark, d):
    root = _csv_layout(spark, d)
    pos = SRC.read_dated_csv(spark, root + "/by-day", date_regex=DAY_DIR)
    neg = SRC.read_labelled_csv(spark, root + "/undated", label=0)
    x = SRC.combine_labelled(pos, neg, numeric_cols=["Size", "Identify"], keep=("MD5",))
    return x.select(F.col("MD5").cast("long").alias("sample_id"), "Size", "Identify",
                    F.col("Label").alias("label"), F.col("__sample_date").alias("sample_date"))


@query
def per_file_counts(spark, d):
    """Rows of each day's files; how many files a day has is up to the writer."""
    root = _csv_layout(spark, d)
    return SRC.per_file_counts(spark, root + "/by-day", DAY_DIR).groupBy("day").agg(F.sum("n").alias("n"))


@query
def date_filtered_scan(spark, d):
    root = _csv_layout(spark, d)
    year = lambda day: day.between(F.lit("1997-01-01").cast("date"), F.lit("1997-12-31").cast("date"))
    x = SRC.read_dated_csv(spark, root + "/by-day", year, DAY_DIR, columns=["MD5", "Size", "Identify"])
    return x.select(F.col("MD5").cast("long").alias("sample_id"), F.col("Size").cast("double").alias("size"),
                    F.col("__sample_date").alias("sample_date"))


@query
def csv_round_trip(spark, d):
    """What the CSV sink wrote, read back, for the undated folder."""
    root = _csv_layout(spark, d)
    x = SRC.read_labelled_csv(spark, root + "/undated", label=0)
    return x.select(F.col("MD5").cast("long").alias("sample_id"), F.col("Size").cast("double").alias("size"), "Identify", F.col("Label").alias("label"))


@query
def json_backfill(spark, d):
    """Records with missing and unparseable numbers and missing strings."""
    o = FX.table(spark, d, "orders")
    k = F.col("o_orderkey")
    size = F.when(k % 7 == 0, "oops").when(k % 5 != 0, F.col("o_totalprice").cast("string"))
    path = scratch_path(spark, "json-" + uuid.uuid4().hex[:12])
    o.select(k.cast("string").alias("Id"), size.alias("Size"), F.when(k % 3 != 0, F.col("o_orderpriority")).alias("Name")).write.json(path)
    x = SRC.read_records_json(spark, path, ["Id", "Size", "Entropy"], ["Name"])
    return x.select(F.col("Id").cast("long").alias("sample_id"), F.col("Size").alias("size"),
                    F.col("Entropy").alias("entropy"), F.col("Name").alias("name"))


@query
def results_sink(spark, d):
    """S9 + J6: a second write of the results keeps the parts that exist."""
    o = FX.table(spark, d, "orders").groupBy(F.col("o_orderstatus").alias("stage"), F.col("o_orderpriority").alias("protocol")).agg(
        F.count(F.lit(1)).alias("n")).withColumn("model_name", F.lit("m"))
    path = scratch_path(spark, "results-" + uuid.uuid4().hex[:12])
    SRC.write_results(o.filter("stage = 'F'"), path)
    SRC.write_results(o.withColumn("n", F.col("n") + 1000), path)
    back = spark.read.schema(o.schema).parquet(path)
    return back.select("stage", "protocol", "model_name", "n")


@query
def upload_check(spark, d):
    """Uploads, a table for each order priority, checked against the needed
    columns; those that lack some are named with what they lack, the others are read."""
    o = FX.table(spark, d, "orders")
    needed, out = ["o_orderkey", "o_totalprice", "o_orderstatus"], []
    for i, priority in enumerate(sorted(r[0] for r in o.select("o_orderpriority").distinct().collect())):  # a row per upload
        upload = o.filter(F.col("o_orderpriority") == priority).drop(*needed[:i % 3])
        try:
            SRC.check_columns(upload, needed)
            lacks = ""
        except ValueError as e:
            lacks = str(e)
        out.append(upload.agg(F.lit(priority).alias("upload"), F.lit(lacks).alias("lacks"), F.count(F.lit(1)).alias("n")))
    return _union(out)


@query
def result_parts(spark, d):
    """Results of orders by status and priority, a JSON part each, under names
    that say stage, protocol and model; files of other names are not read."""
    o = FX.table(spark, d, "orders")
    path = scratch_path(spark, "parts-" + uuid.uuid4().hex[:12])
    stage, protocol = F.when(F.col("o_orderstatus") == "F", "cv").otherwise("holdout"), F.when(F.col("o_orderkey") % 2 == 0, "random").otherwise("temporal")
    rows = o.select(stage.alias("stage"), protocol.alias("protocol"), F.translate(F.lower("o_orderpriority"), " -", "").alias("model_name"), "o_totalprice")
    parts = rows.groupBy("stage", "protocol", "model_name").agg(F.count(F.lit(1)).alias("n"), F.round(F.max("o_totalprice"), 2).alias("top"))
    SRC.write_result_parts(parts.select("stage", "protocol", "model_name", "n", "top"), path)
    SRC.write_result_parts(parts.limit(1).withColumn("stage", F.lit("draft")), path)  # no stage of an experiment
    return SRC.read_result_parts(spark, path).select("stage", F.col("file_protocol").alias("protocol"), "model_name", "n", "top")


@query
def head_rows(spark, d):
    """S13 + P12: a report of the first ten orders."""
    return SRC.head(FX.table(spark, d, "orders").select("o_orderkey", "o_orderstatus"), 10, ["o_orderkey"])


@query
def key_lookup(spark, d):
    """Samples of the orders that some line of 50 pieces asks for."""
    ids = FX.table(spark, d, "lineitem").filter(F.col("l_quantity") == 50).select(F.col("l_orderkey").alias("sample_id"))
    return SRC.lookup(FX.samples(spark, d), ids, "sample_id").select("sample_id", "label")


@query
def schema_inventory(spark, d):
    x = P.schema_inventory(FX.table(spark, d, "documents"), FX.table(spark, d, "benchmark"))
    return x.select("column", "where")


@query
def required_columns(spark, d):
    """P4 + P8: the needed columns, rows with a finite value only."""
    x = N.require_columns(FX.samples(spark, d), ["sample_id", "total_price", "max_discount"])
    return N.finite_filter(x, "max_discount")


@query
def precondition_counts(spark, d):
    """What the temporal split's input check looks at."""
    s = FX.samples(spark, d)
    S.check_temporal_input(s, R)
    return s.agg(F.count_if(F.col("label") == 1).alias("n_pos"), F.count_if((F.col("label") == 1) & F.col("sample_date").isNull()).alias("n_undated"))


# --- training (rows-only checks: results depend on the learners) --------------------
from tidemark.learn import ensemble as EN  # noqa: E402
from tidemark.learn import presets as LP  # noqa: E402
from tidemark.plans import comparison as CP  # noqa: E402
from tidemark.plans import training as TR  # noqa: E402


def _model_input(spark, d):
    return FX.reuse(spark, ("model_input", d), lambda: _featured(spark, d))


def _union(frames):
    return reduce(DataFrame.unionByName, frames)


def _learners():
    return LP.learners(len(FIXTURE.log_cols) + len(FIXTURE.scale_cols))


def _split_sides(spark, d):
    x = _model_input(spark, d)
    return {"random": FX.reuse(spark, ("random_side", d), lambda: S.random_split(x, R)),
            "temporal": FX.reuse(spark, ("temporal_side", d), lambda: S.temporal_split(x, R).drop("cutoff"))}


def comparison_records(spark, d, models=None, k=CV_FOLDS):
    """Records of all learners, folds and protocols, fitted once for all queries
    that show some of them."""
    models = _learners() if models is None else models
    return FX.reuse(spark, ("comparison", d, "-".join(models), k), lambda: CP.run_comparison(
        _split_sides(spark, d), models, FIXTURE.log_cols, FIXTURE.scale_cols, R, k))


@query
def cv_logistic(spark, d):
    """The folds of the logistic learner under both protocols."""
    cv, _ = CP.cv_and_holdout(comparison_records(spark, d, {"logistic": _learners()["logistic"]}))
    return cv


@query
def holdout_protocols(spark, d):
    """Every learner under both protocols; the hold-out alone is fitted."""
    records = FX.reuse(spark, ("holdout", d), lambda: CP.run_comparison(
        _split_sides(spark, d), _learners(), FIXTURE.log_cols, FIXTURE.scale_cols, R, folds=False))
    return CP.cv_and_holdout(records)[1]


_ENSEMBLES: dict = {}


def saved_ensembles(spark, d):
    """E8 + S11: the folders of an ensemble for each base, fitted and saved once, and
    the test side."""
    x = _prep_input(spark, d)
    key = (spark.sparkContext.applicationId, FX.state(spark, d), d)
    if key not in _ENSEMBLES:
        train, specs = x.filter(F.col("split") == "train").drop("cutoff", "split"), _learners()
        paths = {}
        for base, ens in EN.fit_windowed_trees(train, {b: specs[b] for b in LP.BASES}, FIXTURE.log_cols, FIXTURE.scale_cols, R).items():
            paths[base] = scratch_path(spark, f"ensemble-{base}-" + uuid.uuid4().hex[:12])
            ens.save(spark, paths[base])
        _ENSEMBLES[key] = paths
    return _ENSEMBLES[key], x.filter(F.col("split") == "test").drop("cutoff", "split")


@query
def ensemble_fit_score(spark, d):
    """Both bases' ensembles, fitted and scored on the test side."""
    paths, test = saved_ensembles(spark, d)
    return _union([TR.evaluate_ensemble(EN.TreeEnsemble.load(spark, path), test, R).withColumn("base", F.lit(base)) for base, path in paths.items()])


@query
def grid_search(spark, d):
    """The study's grids on the random train side, ten folds."""
    train = _split_sides(spark, d)["random"].filter(F.col("split") == "train").drop("split")
    return FX.reuse(spark, ("grid_search", d), lambda: CP.grid_search(train, LP.GRIDS, FIXTURE.log_cols, FIXTURE.scale_cols, R))


@query
def batch_scoring(spark, d):
    """For each base the saved ensemble, loaded, scores the labelled test side and
    the same rows without labels; verdict counts of both and the metrics."""
    out = []
    paths, test = saved_ensembles(spark, d)
    for base, path in paths.items():
        ens = EN.TreeEnsemble.load(spark, path)
        rows, metrics = TR.batch_score(ens, test, R)
        plain, _ = TR.batch_score(ens, test.drop(R.label), R)
        same = rows.join(plain.withColumnsRenamed({"verdict": "v", "probability": "p"}).select("sample_id", "v", "p"), "sample_id").agg(
            F.count_if((F.col("v") == F.col("verdict")) & (F.col("p") == F.col("probability"))).alias("n_same_unlabelled"))
        out.append(metrics.withColumn("n_same_unlabelled", same.scalar()).withColumn("base", F.lit(base)))
    return _union(out)


@query
def isotonic_calibration(spark, d):
    """The calibrator fitted on one model's scores, at every score."""
    from pyspark.ml.regression import IsotonicRegression
    s = FX.scores_long(spark, d, 1).select("p", F.col("label").cast("double").alias("label"))
    model = IsotonicRegression(featuresCol="p", labelCol="label", predictionCol="calibrated").fit(s)
    return model.transform(s.select("p").distinct()).select("p", r6("calibrated").alias("calibrated"))


# --- streaming (rows-only: results are the batch operators' over a stream) ---------
from pyspark.sql import types as T  # noqa: E402
from tidemark.operators.quantiles import small_frame, to_long  # noqa: E402
from tidemark.streaming import monitor as Z  # noqa: E402


def _tag(d):
    return d.strip("/").replace("/", "_")


@query
def stream_scoring(spark, d):
    """Orders arrive as a stream; each row is enriched (stream-static join
    with the lineitem rollup), scored by the K window probabilities, voted,
    decided and explained — all narrow."""
    w, a = _weights(spark, d)
    orders = Z.read_stream_table(spark, d, "orders")
    lines = FX.reuse(spark, ("order_lines", d), lambda: FX.order_lines(spark, d))  # once, not in every micro-batch
    s = FX._samples(spark, d, orders=orders, lines=lines)
    s = s.select("*", *[FX.pseudo_probability(FX.model_uniform(i, F.col("sample_id")), F.col("label")).alias(f"p_{i}")
                        for i in range(K)])
    dec = DC.decide(s, PCOLS, w, a)
    out = X.explain(FE.engineer(dec, SPEC), FIXTURE.rules).select(
        "sample_id", "verdict", F.bround("probability", 4).alias("probability"),
        F.bround("confidence", 4).alias("confidence"),
        F.col("report.summary").alias("summary"), F.size("report.why").alias("n_why"))
    return spark.read.parquet(Z.run_to_files(out, "scoring-" + _tag(d)))


@query
def stream_fitted_scoring(spark, d):
    """Z1 + E9: the test side's rows arrive as a stream and are scored by the saved
    forest ensemble, the same one and by the same expression as in ``batch_scoring``."""
    paths, test = saved_ensembles(spark, d)
    folder = FX.reuse(spark, ("stream_input", d), lambda: test)
    stream = spark.readStream.schema(folder.schema).parquet(folder.inputFiles()[0].rsplit("/", 1)[0])
    dec = EN.TreeEnsemble.load(spark, paths["forest"]).decide(stream, [R.id])
    out = dec.select(R.id, "verdict", F.bround("probability", 4).alias("probability"), F.bround("confidence", 4).alias("confidence"))
    return spark.read.parquet(Z.run_to_files(out, "fitted-scoring-" + _tag(d)))


@query
def stream_psi(spark, d):
    """Daily drift of event features against the train edges (batch
    exact quantiles of the train side), PSI per day of the whole input."""
    tr, _ = _drift_frames(spark, d)
    edges = {r["feature"]: r["edges"] for r in D.psi_edges(to_long(tr, FX.DRIFT_FEATURES)).collect()}
    edges = {k: v for k, v in edges.items() if len(v) >= 2}
    ev = Z.read_stream_table(spark, d, "events").select(
        "ts", F.col("value").cast("double").alias("value"), F.col("user_id").cast("double").alias("user_id"),
        F.get_json_object("props", "$.k").cast("double").alias("prop_k"), F.hour("ts").cast("double").alias("hour"))
    run = Z.run_windowed(spark, lambda end: Z.stream_bucket_counts(ev, "ts", edges, marker=end), "psi-" + _tag(d))
    counts = spark.read.parquet(run.path)
    ef = small_frame(spark, [(k, [float(x) for x in v]) for k, v in edges.items()],
                     T.StructType([T.StructField("feature", T.StringType()),
                                   T.StructField("edges", T.ArrayType(T.DoubleType()))]))
    tl = to_long(tr, list(edges)).filter(F.col("value").isNotNull()).join(F.broadcast(ef), "feature")
    counted = tl.select("feature", D.bucketize(F.col("value"), F.col("edges")).alias("bucket")) \
        .filter(F.col("bucket").isNotNull()).groupBy("feature", "bucket").agg(F.count(F.lit(1)).alias("tc"))
    # full spine: buckets without train rows count 0 (pct = eps), as in batch PSI
    spine = ef.select("feature", F.explode(F.sequence(F.lit(0), F.size("edges") - 2)).alias("bucket"))
    tc = spine.join(counted, ["feature", "bucket"], "left").fillna(0, ["tc"])
    res = Z.psi_from_counts(counts, tc)
    return res.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "feature",
                      r6("psi").alias("psi"), F.col("n_deploy").cast("long").alias("n_deploy"))


@query
def stream_accuracy(spark, d):
    """Z3: accuracy per 30-day window and model as labelled orders arrive."""
    o = Z.read_stream_table(spark, d, "orders").select(
        F.col("o_orderkey").alias("sample_id"), "o_orderdate",
        F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("label"))
    o = o.withColumn("model_id", F.explode(F.sequence(F.lit(0), F.lit(K - 1)))).withColumn("p", _p_of(F.col("model_id")))
    run = Z.run_windowed(spark, lambda end: Z.stream_window_accuracy(
        o, "o_orderdate", "model_id", F.col("p") >= 0.5, "label", marker=end), "accuracy-" + _tag(d))
    out = spark.read.parquet(run.path)
    return out.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"),
                      F.col("model_id").cast("int").alias("model_id"), r6("accuracy").alias("accuracy"), "n")


@query
def stream_late_labels(spark, d):
    """Z3 with labels of their own: predictions (orders) and labels (the first lines,
    known when they ship) are two streams. A label counts if it comes within 60 days;
    per 30 days and model the predictions with and without one, accuracy, and its
    decay (D1) against the 30 days before."""
    o = Z.read_stream_table(spark, d, "orders").select(F.col("o_orderkey").alias("key"), F.col("o_orderdate").alias("ts"))
    p = F.array(*[FX.pseudo_probability(FX.model_uniform(i, F.col("key")), F.lit(0)) for i in range(K)])
    lines = Z.read_stream_table(spark, d, "lineitem").filter(F.col("l_linenumber") == 1).select(
        F.col("l_orderkey").alias("key"), F.col("l_shipdate").alias("ts"), F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("label"))
    run = Z.run_windowed(spark, lambda end: Z.stream_delayed_labels(
        o.withColumn("p", p), lines, "key", "ts", "ts", within="60 days", watermark="1 day", marker=end), "late-labels-" + _tag(d))
    return Z.delayed_accuracy(spark.read.parquet(run.path), "p", "label", threshold=0.3, window="30 days").select(
        F.col("window_start").cast("timestamp_ntz").alias("window_start"), "model_id", "n", "n_labelled", "n_unlabelled",
        r6("accuracy").alias("accuracy"), r6("decay").alias("decay"))
