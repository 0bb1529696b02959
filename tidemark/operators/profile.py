"""Profiling / EDA reports.

Every report over many columns is one aggregation over the unpivoted
(column, value) form, not one job per column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.quantiles import exact_quantiles, small_frame, to_long
from pyspark.sql import types as T


def class_balance_by_day(df: DataFrame, date_col: str, label_col: str) -> DataFrame:
    """A5: per day, count of each class (0-filled)."""
    return (df.groupBy(F.col(date_col).alias("day"))
            .agg(F.count_if(F.col(label_col) == 0).alias("n_neg"),
                 F.count_if(F.col(label_col) == 1).alias("n_pos")))


def daily_counts(df: DataFrame, date_col: str) -> DataFrame:
    """One row per day between the first and last date, empty days 0.

    The spine is generated from a one-row (min, max) aggregate; its size is
    the number of days in the range.
    """
    d = F.to_date(F.col(date_col))
    counts = df.groupBy(d.alias("day")).agg(F.count(F.lit(1)).alias("n"))
    spine = df.agg(F.min(d).alias("lo"), F.max(d).alias("hi")) \
        .select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("day"))
    return spine.join(counts, "day", "left").select("day", F.coalesce("n", F.lit(0)).alias("n"))


def monthly_rollup(daily: DataFrame) -> DataFrame:
    """Per month — sum, mean, max and number of days of the daily counts."""
    return daily.groupBy(F.date_format("day", "yyyy-MM").alias("month")).agg(
        F.sum("n").alias("total"), F.avg("n").alias("mean_per_day"),
        F.max("n").alias("max_per_day"), F.count(F.lit(1)).alias("days"))


def empty_periods(daily: DataFrame) -> DataFrame:
    """Overall and per-year days, empty days, total rows and % empty
    (1 decimal, half-even). ``year`` is NULL on the overall row."""
    def agg(g):
        return g.agg(F.count(F.lit(1)).alias("days"), F.count_if(F.col("n") == 0).alias("empty_days"),
                     F.sum("n").alias("total"),
                     F.bround(F.lit(100.0) * F.count_if(F.col("n") == 0) / F.count(F.lit(1)), 1).alias("pct_empty"))
    per_year = agg(daily.groupBy(F.year("day").alias("year")))
    overall = agg(daily.groupBy()).select(F.lit(None).cast("int").alias("year"), "*")
    return per_year.unionByName(overall)


def timestamp_profile(df: DataFrame, col: str, fmt: str = "yyyy-MM-dd HH:mm:ss") -> DataFrame:
    """Rows, parseable values, min and max of a timestamp string column
    (wall-clock values without a zone, hence TIMESTAMP_NTZ)."""
    ts = F.try_to_timestamp(F.col(col), F.lit(fmt)).cast("timestamp_ntz")
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.count(ts).alias("n_valid"),
                  F.min(ts).alias("min_ts"), F.max(ts).alias("max_ts"))


def numeric_describe(df: DataFrame, cols: Sequence[str], probs=(0.05, 0.5, 0.95)) -> DataFrame:
    """A10: count, mean, sample std, min, exact 5/50/95 %, max, null count and
    null % per column (one aggregation + the exact-quantile helper)."""
    long = to_long(df, cols)
    base = long.groupBy("feature").agg(
        F.count("value").alias("count"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"),
        F.count_if(F.col("value").isNull()).alias("null_count"),
        (F.lit(100.0) * F.count_if(F.col("value").isNull()) / F.count(F.lit(1))).alias("null_pct"))
    q = exact_quantiles(long, ["feature"], "value", list(probs))
    names = {i: f"p{int(round(p * 100)):02d}" for i, p in enumerate(probs)}
    qw = q.groupBy("feature").pivot("prob_idx", list(names)).agg(F.first("value"))
    for i, n in names.items():
        qw = qw.withColumnRenamed(str(i), n)
    return base.join(qw, "feature", "left")


def missingness(df: DataFrame, cols: Sequence[str] | None = None, approx: bool = False) -> DataFrame:
    """Per column: type, null count, null %, distinct non-null count;
    sorted by null % descending then name. Distinct counts come from one
    (column, value) aggregation over the hashed long form."""
    cols = list(cols or df.columns)
    types = dict(df.dtypes)
    n = F.count(F.lit(1))
    nulls = df.agg(n.alias("_n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    nl = nulls.unpivot(["_n"], cols, "column", "null_count")
    # hashes of 128 bits stand for the values, which can be long, in the shuffle
    long = df.select(*[F.unhex(F.md5(F.col(c).cast("string"))).alias(c) for c in cols]).unpivot([], cols, "column", "v") \
        .filter(F.col("v").isNotNull())
    if approx:
        dist = long.groupBy("column").agg(F.approx_count_distinct("v").alias("n_distinct"))
    else:
        dist = long.distinct().groupBy("column").agg(F.count(F.lit(1)).alias("n_distinct"))
    tmap = small_frame(df.sparkSession, [(c, types[c]) for c in cols],
                       T.StructType([T.StructField("column", T.StringType()), T.StructField("dtype", T.StringType())]))
    out = nl.join(F.broadcast(tmap), "column").join(dist, "column", "left").select(
        "column", "dtype", "null_count",
        (F.lit(100.0) * F.col("null_count") / F.col("_n")).alias("null_pct"),
        F.coalesce("n_distinct", F.lit(0)).alias("n_distinct"))
    return out.orderBy(F.col("null_pct").desc(), "column")


def string_cardinality(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Non-null count, distinct count, max length and integer median
    length per string column."""
    both = df.select(*[F.when(F.col(c).isNotNull(), F.struct(F.unhex(F.md5(c)).alias("v"), F.length(c).alias("len"))).alias(c) for c in cols])
    long = both.unpivot([], list(cols), "column", "x").filter(F.col("x").isNotNull()).select("column", "x.*")
    base = long.groupBy("column").agg(F.count(F.lit(1)).alias("non_null"),
                                      F.count_distinct("v").alias("n_distinct"), F.max("len").alias("max_len"))
    med = exact_quantiles(long, ["column"], "len", [0.5]) \
        .select("column", F.col("value").cast("int").alias("median_len"))
    return base.join(med, "column", "left").orderBy(F.col("n_distinct").desc(), "column")


def near_zero_variance(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """P10: a column is near-zero-variance when it has at most one distinct
    non-null value (min <=> max, no distinct count needed); mean reported
    for the rest (the shortlist)."""
    long = to_long(df, cols)
    return long.groupBy("feature").agg(
        (F.min("value").eqNullSafe(F.max("value"))).alias("near_zero_variance"),
        F.avg("value").alias("mean"))


def schema_inventory(left: DataFrame, right: DataFrame) -> DataFrame:
    """Shared / left-only / right-only columns with their types."""
    spark = left.sparkSession
    sch = T.StructType([T.StructField("column", T.StringType()), T.StructField("type", T.StringType())])
    lt = small_frame(spark, left.dtypes, sch).withColumnRenamed("type", "left_type")
    rt = small_frame(spark, right.dtypes, sch).withColumnRenamed("type", "right_type")
    j = lt.join(rt, "column", "full")
    return j.select("column", F.when(F.col("left_type").isNull(), "right_only")
                    .when(F.col("right_type").isNull(), "left_only").otherwise("shared").alias("where"),
                    "left_type", "right_type").orderBy("where", "column")
