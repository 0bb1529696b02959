"""Exact, linearly interpolated quantiles per group — without one task
holding a whole group.

For a group of n values and probability p the answer is
``x[lo] + (x[hi] - x[lo]) * frac`` with ``h = (n-1)p``, ``lo = floor(h)``,
``hi = min(lo+1, n-1)`` (numpy's default, DuckDB ``quantile_cont``).

How the order statistics ``x[k]`` are found, alike at every size:

1. values are counted by (group, value), combined before the shuffle, so ties
   of any number are one row;
2. every value falls into a bucket that grows with it (``value_cells``: about
   a thousand for each power of two, and where many different values crowd in
   one, a second split by the distance from its ends); running sums over a
   group's buckets, a table bounded by the buckets there are, tell which ones
   hold a wanted rank;
3. running sums over the distinct values of those buckets alone pick ``x[k]``.

All of it is one lazy plan; the driver sees no intermediate result.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: Buckets for each power of two of a value's size.
BUCKETS_PER_OCTAVE = 1024
#: Beyond the exponents of doubles on both sides.
_EXPONENTS = 1100.0
#: Different values of one bucket beyond which it is split again.
CROWD = 4_096
#: Above twice the greatest ``value_bucket``.
_SPLITS = 1 << 23


def small_frame(spark, rows, schema: T.StructType) -> DataFrame:
    """A driver-side table of bounded size as a local relation, so that its
    statistics are known."""
    arrow = to_arrow_schema(schema)
    columns = list(zip(*rows)) if rows else [()] * len(schema.fields)
    return spark.createDataFrame(pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow), schema)


def value_bucket(x: Column) -> Column:
    """A whole number that never falls as ``x`` grows: by sign and logarithm."""
    size = F.floor((F.least(F.log2(F.abs(x)), F.lit(_EXPONENTS)) + _EXPONENTS) * BUCKETS_PER_OCTAVE).cast("long") + 1
    return F.when(x > 0, size).when(x < 0, -size).otherwise(F.lit(0).cast("long"))


def value_cells(counts: DataFrame, keys: Sequence[str], value: str, out: str) -> DataFrame:
    """``counts`` (a row per group and value) with a whole number ``out`` that
    never falls as ``value`` grows, fine enough that few values share one.

    It is ``value_bucket``, and within a bucket of more than ``CROWD`` values the
    ``value_bucket`` of the distance from its nearer end. So dates in
    microseconds, which share a bucket for days, are cut into thousands, and so
    are scores that approach 1. A group with a null key stays unsplit.
    """
    keys, x = list(keys), F.col(value)
    coarse = counts.withColumn(out, value_bucket(x))
    crowded = coarse.groupBy(*keys, out).agg(F.count(F.lit(1)).alias("_d"), F.min(x).alias("_low"), F.max(x).alias("_high")) \
        .where((F.col("_d") > CROWD) & (F.col("_high") > F.col("_low"))).drop("_d")
    up, down = x - F.col("_low"), F.col("_high") - x
    split = F.when(up <= down, value_bucket(up)).otherwise(_SPLITS - value_bucket(down))
    return coarse.join(crowded, [*keys, out], "left").select(
        *counts.columns, (F.col(out) * F.lit(_SPLITS) + F.coalesce(split, F.lit(0).cast("long"))).alias(out))


def exact_quantiles(long: DataFrame, keys: Sequence[str], value: str, probs: Sequence[float], times: str | None = None) -> DataFrame:
    """(keys..., prob_idx, prob, n, value) for each group and probability.

    ``long`` holds one value per row (NULL / NaN rows are ignored), which counts as
    often as the column ``times`` says, if there is one. Groups with no values give
    no rows.
    """
    keys = list(keys)
    counts = long.select(*keys, F.col(value).cast("double").alias("_x"), (F.col(times) if times else F.lit(1)).alias("_t")) \
        .filter(F.col("_x").isNotNull() & ~F.isnan("_x")) \
        .groupBy(*keys, "_x").agg((F.sum("_t") if times else F.count(F.lit(1))).alias("_c"))
    counts = value_cells(counts, keys, "_x", "_b")

    whole = Window.partitionBy(*keys)
    before = whole.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    hist = counts.groupBy(*keys, "_b").agg(F.sum("_c").alias("_c")).select(
        *keys, "_b", "_c", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_off"), F.sum("_c").over(whole).alias("_n"))
    last = F.col("_n") - 1
    ranks = []
    for i, p in enumerate(probs):
        lo = F.floor(last * F.lit(float(p))).cast("long")
        ranks += [F.struct(F.lit(i).alias("i"), F.lit(k).alias("k"), r.alias("rank")) for k, r in ((0, lo), (1, F.least(lo + 1, last)))]
    inside = F.filter(F.array(*ranks), lambda r: (r["rank"] >= F.col("_off")) & (r["rank"] < F.col("_off") + F.col("_c")))
    wanted = hist.select(*keys, "_b", "_off", "_n", inside.alias("_r")).filter(F.size("_r") > 0)

    within = Window.partitionBy(*keys, "_b").orderBy("_x")
    found = counts.join(wanted, [*keys, "_b"]).select(
        *keys, "_x", "_n", "_r", "_c", (F.col("_off") + F.sum("_c").over(within)).alias("_end"))
    hit = F.filter("_r", lambda r: (r["rank"] < F.col("_end")) & (r["rank"] >= F.col("_end") - F.col("_c")))
    picked = found.select(*keys, "_x", "_n", F.explode(hit).alias("_r"))
    both = picked.groupBy(*keys, F.col("_r.i").alias("prob_idx")).agg(
        F.max("_n").alias("n"), F.max(F.when(F.col("_r.k") == 0, F.col("_x"))).alias("_a"),
        F.max(F.when(F.col("_r.k") == 1, F.col("_x"))).alias("_z"))
    prob = F.element_at(F.array(*[F.lit(float(p)) for p in probs]), F.col("prob_idx") + 1)
    h = (F.col("n") - 1) * F.col("prob")
    frac = h - F.floor(h)
    return both.withColumn("prob", prob).select(
        *keys, "prob_idx", "prob", "n",
        F.when((frac == 0) | (F.col("_a") == F.col("_z")), F.col("_a"))
        .otherwise(F.col("_a") + (F.col("_z") - F.col("_a")) * frac).alias("value"))


def to_long(df: DataFrame, cols: Sequence[str], keys: Sequence[str] = (),
            name: str = "feature", value: str = "value") -> DataFrame:
    """Unpivot numeric columns to (keys..., feature, value) — one aggregation
    can then serve every column."""
    return df.select(*keys, *[F.col(c).cast("double").alias(c) for c in cols]) \
        .unpivot(list(keys), list(cols), name, value)
