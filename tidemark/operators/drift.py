"""Drift signals (D1–D10): PSI, accuracy decay, disagreement, vote weights,
drift status and retrain alert.

PSI runs on the unpivoted (feature, value) form: train edges come from the
exact-quantile helper (features x (B+1) numbers, broadcast), each value is
bucketed with an array expression (no theta join), and one partial
aggregation yields features x sides x buckets counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.config import DECAY_PENALTY, PSI_BUCKETS, PSI_EPS, RECENCY_ALPHA, RETRAIN_DROP, TREND_BAND
from tidemark.functions.numeric import clip, is_finite
from tidemark.operators.quantiles import exact_quantiles, small_frame, to_long


def psi_edges(train_long: DataFrame, buckets: int = PSI_BUCKETS) -> DataFrame:
    """(feature, edges): unique train quantiles at linspace(0, 1, B+1)."""
    probs = [i / buckets for i in range(buckets + 1)]
    q = exact_quantiles(train_long, ["feature"], "value", probs)
    return q.groupBy("feature").agg(
        F.array_sort(F.collect_list(F.struct("prob_idx", "value"))).alias("_q")
    ).select("feature", F.array_distinct(F.transform("_q", lambda s: s["value"])).alias("edges"))


def bucketize(x: Column, edges: Column) -> Column:
    """Index of [e_i, e_{i+1}) holding x, last bucket closed; NULL outside."""
    last = F.size(edges) - 1
    idx = F.size(F.filter(edges, lambda e: e <= x)) - 1
    return (F.when((x < F.element_at(edges, 1)) | (x > F.element_at(edges, -1)), F.lit(None))
            .when(idx >= last, last - 1).otherwise(idx))


def psi(train: DataFrame, deploy: DataFrame, cols: Sequence[str], buckets: int = PSI_BUCKETS,
        eps: float = PSI_EPS, open_tails: bool = False) -> DataFrame:
    """D3 for every column: (feature, psi, n_train, n_deploy).

    Non-finite values are dropped; an empty side or fewer than 2 distinct
    edges gives 0. Deploy values outside the train range are not counted
    (``open_tails=True`` folds them into the end buckets instead).
    """
    spark = train.sparkSession
    tl = to_long(train, cols).filter(is_finite("value"))
    dl = to_long(deploy, cols).filter(is_finite("value"))
    edges = psi_edges(tl, buckets)
    both = tl.withColumn("side", F.lit("train")).unionByName(dl.withColumn("side", F.lit("deploy")))
    x = both.join(F.broadcast(edges), "feature", "inner")
    v = F.col("value")
    if open_tails:
        v = F.least(F.greatest(v, F.element_at("edges", 1)), F.element_at("edges", -1))
    counts = x.select("feature", "side", bucketize(v, F.col("edges")).alias("bucket")) \
        .filter(F.col("bucket").isNotNull()) \
        .groupBy("feature", "side", "bucket").agg(F.count(F.lit(1)).alias("c"))
    spine = edges.filter(F.size("edges") >= 2).select(
        "feature", F.explode(F.sequence(F.lit(0), F.size("edges") - 2)).alias("bucket"))
    tc = counts.filter(F.col("side") == "train").select("feature", "bucket", F.col("c").alias("tc"))
    dc = counts.filter(F.col("side") == "deploy").select("feature", "bucket", F.col("c").alias("dc"))
    j = spine.join(tc, ["feature", "bucket"], "left").join(dc, ["feature", "bucket"], "left") \
        .fillna(0, ["tc", "dc"])
    w = Window.partitionBy("feature")
    j = j.withColumn("tp", F.col("tc") / F.greatest(F.sum("tc").over(w), F.lit(1)) + F.lit(eps)) \
         .withColumn("dp", F.col("dc") / F.greatest(F.sum("dc").over(w), F.lit(1)) + F.lit(eps))
    per = j.groupBy("feature").agg(F.sum((F.col("dp") - F.col("tp")) * F.ln(F.col("dp") / F.col("tp"))).alias("psi"))
    ns = both.groupBy("feature").agg(F.count_if(F.col("side") == "train").alias("n_train"),
                                     F.count_if(F.col("side") == "deploy").alias("n_deploy"))
    names = small_frame(spark, [(c,) for c in cols], T.StructType([T.StructField("feature", T.StringType())]))
    out = names.join(ns, "feature", "left").join(per, "feature", "left").fillna(0, ["n_train", "n_deploy"])
    return out.select("feature", F.when((F.col("n_train") == 0) | (F.col("n_deploy") == 0), F.lit(0.0))
                      .otherwise(F.coalesce("psi", F.lit(0.0))).alias("psi"), "n_train", "n_deploy")


def psi_band(p: Column) -> Column:
    """< 0.1 none, 0.1–0.25 moderate, > 0.25 large."""
    return F.when(p < 0.1, "none").when(p <= 0.25, "moderate").otherwise("large")


def average_psi(per_feature: DataFrame) -> DataFrame:
    """Mean PSI over features (0 when there are none)."""
    return per_feature.agg(F.coalesce(F.avg("psi"), F.lit(0.0)).alias("avg_psi"),
                           F.count(F.lit(1)).alias("n_features"))


def accuracy_decay(in_acc: Column, recent_acc: Column) -> Column:
    """clip(max(0, in - recent) / in, 0, 1); divisor 1 when in <= 1e-9."""
    safe = F.when(in_acc > 1e-9, in_acc).otherwise(F.lit(1.0))
    return clip(F.greatest(F.lit(0.0), in_acc - recent_acc) / safe, 0.0, 1.0)


def disagreement(probs: Column) -> Column:
    """clip(2 * population std of an array of probabilities, 0, 1);
    NULL entries (inactive models) are left out."""
    a = F.filter(probs, lambda x: x.isNotNull())
    # the array and its mean are bound once per row; inside a lambda they would be made again for every entry
    mean = lambda v: F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x) / F.size(v)
    variance = lambda v, m: F.aggregate(v, F.lit(0.0), lambda acc, x: acc + (x - m) * (x - m)) / F.size(v)
    bound = F.transform(F.array(a), lambda v: F.struct(v.alias("v"), mean(v).alias("m")))
    var = F.get(F.transform(bound, lambda s: variance(s["v"], s["m"])), F.lit(0))
    return clip(F.lit(2.0) * F.sqrt(var), 0.0, 1.0)


def vote_weights(meta: DataFrame, k: int | None = None, alpha: float = RECENCY_ALPHA,
                 beta: float = DECAY_PENALTY, use_recent: bool = True, mask_inactive: bool = True,
                 window_col: str = "window_id") -> DataFrame:
    """D6 + D7 over the K-row window table (in_acc, recent_acc, active):
    recency * quality * penalty, normalised; uniform 1/K when the sum is not
    positive; inactive windows zeroed and the rest renormalised."""
    k_lit = F.lit(k) if k is not None else F.count(F.lit(1)).over(Window.partitionBy(F.lit(1)))
    allw = Window.partitionBy(F.lit(1))
    x = meta.withColumn("_k", k_lit)
    recency = F.exp(F.lit(-alpha) * (F.col("_k") - 1 - F.col(window_col)) / F.greatest(F.col("_k") - 1, F.lit(1)))
    penalty = F.exp(F.lit(-beta) * accuracy_decay(F.col("in_acc"), F.col("recent_acc"))) if use_recent else F.lit(1.0)
    x = x.withColumn("_raw", recency * F.col("in_acc") * penalty)
    x = x.withColumn("_sum", F.sum("_raw").over(allw))
    x = x.withColumn("weight", F.when(F.col("_sum") <= 0, F.lit(1.0) / F.col("_k")).otherwise(F.col("_raw") / F.col("_sum")))
    if mask_inactive:
        x = x.withColumn("weight", F.when(F.col("active"), F.col("weight")).otherwise(F.lit(0.0)))
        x = x.withColumn("weight", F.col("weight") / F.greatest(F.sum("weight").over(allw), F.lit(1e-12)))
    return x.drop("_k", "_raw", "_sum")


def drift_status(meta: DataFrame, band: float = TREND_BAND, window_col: str = "window_id",
                 acc_col: str = "in_acc") -> DataFrame:
    """Newest / oldest active-window accuracy, trend, its class, the
    per-window accuracies (3 decimals, oldest first) and the active count."""
    a = meta.filter(F.col("active"))
    r = a.agg(F.max_by(acc_col, window_col).alias("newest_acc"), F.min_by(acc_col, window_col).alias("oldest_acc"),
              F.array_sort(F.collect_list(F.struct(window_col, F.bround(acc_col, 3).alias("a")))).alias("_l"),
              F.count(F.lit(1)).alias("n_active"))
    trend = F.col("newest_acc") - F.col("oldest_acc")
    return r.select("newest_acc", "oldest_acc", trend.alias("trend"),
                    F.when(trend < -band, "down").when(trend > band, "up").otherwise("flat").alias("trend_class"),
                    F.array_join(F.transform("_l", lambda s: F.format_string("%.3f", s["a"])), " ").alias("per_window"),
                    "n_active")


def retrain_alert(meta: DataFrame, drop: float = RETRAIN_DROP, window_col: str = "window_id",
                  acc_col: str = "in_acc") -> DataFrame:
    """Newest accuracy below the mean of the older windows minus
    ``drop``; also flags a sharp drop against the second-newest window."""
    w = Window.partitionBy(F.lit(1)).orderBy(window_col)
    a = meta.filter(F.col("active")).select(
        window_col, acc_col,
        F.avg(acc_col).over(w.rowsBetween(Window.unboundedPreceding, -1)).alias("mean_older"),
        F.lag(acc_col).over(w).alias("prev_acc"),
        F.row_number().over(w.orderBy(F.col(window_col).desc())).alias("_rk"))
    newest = a.filter(F.col("_rk") == 1)
    return newest.select(F.col(acc_col).alias("newest_acc"), "mean_older", "prev_acc",
                         (F.col(acc_col) < F.col("mean_older") - drop).alias("retrain"),
                         ((F.col("prev_acc") - F.col(acc_col)) >= drop).alias("sharp_drop"))
