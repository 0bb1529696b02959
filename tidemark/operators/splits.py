"""Random and time-aware splits, windows, folds and samples.

All splits add a column instead of returning two frames, so one plan feeds
both sides. Sizes follow the study: ``ceil`` per class for random test sides,
``round half even`` for the temporal test size, and the whole cutoff day goes
to test (``date < cutoff`` is train).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.config import Roles, SEED, TEST_FRACTION
from tidemark.operators.quantiles import exact_quantiles
from tidemark.operators.ranking import seeded_hash, seeded_rank


def _require(df: DataFrame, *cols: str) -> None:
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"no column named {', '.join(missing)}")


def _ts_micros(c: Column) -> Column:
    """Micros since epoch for DATE / TIMESTAMP / TIMESTAMP_NTZ alike (UTC)."""
    return F.unix_micros(F.to_timestamp(c.cast("timestamp_ntz").cast("string")))


def random_split(df: DataFrame, roles: Roles = Roles(), fraction: float = TEST_FRACTION,
                 seed: int = SEED, out: str = "split") -> DataFrame:
    """Stratified by label (null labels are a class of their own); per class
    the first ``ceil(n*fraction)`` rows in seeded order are 'test'."""
    _require(df, roles.label, roles.id)
    r = seeded_rank(df, roles.id, seed, by=[roles.label], out="_r")
    n_test = F.ceil(F.col("_r_n") * F.lit(fraction))
    return r.withColumn(out, F.when(F.col("_r") < n_test, "test").otherwise("train")).drop("_r", "_r_n")


def temporal_cutoff(df: DataFrame, roles: Roles = Roles(), fraction: float = TEST_FRACTION) -> DataFrame:
    """T2 (first half): one-row frame (cutoff, n_pos, n_pos_test).

    The cutoff is the date at 0-based position ``n - max(round_half_even(n*f),
    1)`` among the positives. Running counts over calendar days find its day;
    if the role has a time of day, running counts within that day find it.
    """
    date = F.col(roles.date)
    pos = df.filter((F.col(roles.label) == 1) & date.isNotNull())
    days = pos.groupBy(F.to_date(date).alias("d")).agg(F.count(F.lit(1)).alias("c"))
    cum = days.select("d", "c", F.sum("c").over(Window.orderBy("d")).alias("cum"),  # one row per calendar day
                      F.sum("c").over(Window.partitionBy(F.lit(1))).alias("n_pos"))
    n_test = F.greatest(F.bround(F.col("n_pos") * F.lit(fraction), 0).cast("long"), F.lit(1))
    day = cum.withColumn("n_pos_test", n_test).filter(F.col("cum") > F.col("n_pos") - F.col("n_pos_test")).groupBy().agg(
        F.min("d").alias("d"), F.min(F.col("cum")).alias("cum"), F.min_by("c", "d").alias("c"),
        F.first("n_pos").alias("n_pos"), F.first("n_pos_test").alias("n_pos_test"))
    times = pos.groupBy(date.alias("t")).agg(F.count(F.lit(1)).alias("k"))
    within = times.join(F.broadcast(day), F.to_date("t") == F.col("d")).withColumn(
        "upto", F.col("cum") - F.col("c") + F.sum("k").over(Window.partitionBy("d").orderBy("t")))
    return within.filter(F.col("upto") > F.col("n_pos") - F.col("n_pos_test")).groupBy("n_pos", "n_pos_test").agg(
        F.min("t").alias("cutoff")).select("cutoff", "n_pos", "n_pos_test")


def check_temporal_input(df: DataFrame, roles: Roles = Roles()) -> None:
    """Raise unless there are positives, all of them dated, and every label
    is 0 or 1 (one aggregation action)."""
    _require(df, roles.label, roles.date)
    label, date = F.col(roles.label), F.col(roles.date)
    row = df.agg(F.count_if(label == 1).alias("pos"), F.count_if((label == 1) & date.isNull()).alias("undated"),
                 F.count_if(~F.coalesce(label.isin(0, 1), F.lit(False))).alias("other")).first()
    if row["other"]:
        raise ValueError(f"{row['other']} rows have a label other than 0 and 1")
    if not row["pos"]:
        raise ValueError("no row has label 1, so there are no dates to split by")
    if row["undated"]:
        raise ValueError(f"{row['undated']} rows of label 1 lack a value in {roles.date!r}")


def temporal_split(df: DataFrame, roles: Roles = Roles(), fraction: float = TEST_FRACTION,
                   seed: int = SEED, out: str = "split", validate: bool = True) -> DataFrame:
    """Positives by date (whole cutoff day -> test); negatives (undated)
    split at random with the same fraction. Adds ``out`` and ``cutoff``. Input
    that cannot be split by date raises, unless it has been checked before
    (``validate=False``).

    The cutoff is a one-row aggregate joined back (no driver round trip); the
    optimizer broadcasts it.
    """
    _require(df, roles.label, roles.date, roles.id)
    if validate:
        check_temporal_input(df, roles)
    cut = temporal_cutoff(df, roles, fraction).select("cutoff").scalar()
    neg = random_split(df.filter(F.col(roles.label) == 0), roles, fraction, seed, out)
    pos = (df.filter(F.col(roles.label) == 1)
           .withColumn(out, F.when(F.col(roles.date) < cut, "train").otherwise("test")))
    return pos.unionByName(neg).withColumn("cutoff", cut)


def split_summary(split_df: DataFrame, roles: Roles = Roles(), split_col: str = "split") -> DataFrame:
    """Counts per side and class, one row per side."""
    return (split_df.groupBy(split_col)
            .agg(F.count(F.lit(1)).alias("n"),
                 F.count_if(F.col(roles.label) == 1).alias("n_pos"),
                 F.count_if(F.col(roles.label) == 0).alias("n_neg")))


def validate_temporal(split_df: DataFrame, roles: Roles = Roles(), split_col: str = "split") -> DataFrame:
    """No look-ahead — max(train date) < cutoff <= min(test date), positives only."""
    pos = split_df.filter(F.col(roles.label) == 1)
    return pos.agg(
        F.max(F.when(F.col(split_col) == "train", F.col(roles.date))).alias("max_train_date"),
        F.min(F.when(F.col(split_col) == "test", F.col(roles.date))).alias("min_test_date"),
        F.first("cutoff", ignorenulls=True).alias("cutoff"),
    ).withColumn("no_lookahead",
                 (F.col("max_train_date") < F.col("cutoff")) & (F.col("cutoff") <= F.col("min_test_date")))


def window_cutoffs(df: DataFrame, roles: Roles = Roles(), k: int = 5) -> DataFrame:
    """K+1 linearly interpolated quantiles of positive dates, as micros.

    Exact quantiles over the counts of distinct dates, whose ties are combined
    before the shuffle; a role with a time of day works alike.
    Returns one row per cutoff: (cutoff_idx, cutoff_micros).
    """
    pos = df.filter((F.col(roles.label) == 1) & F.col(roles.date).isNotNull())
    q = exact_quantiles(pos.select(_ts_micros(F.col(roles.date)).alias("m")), [], "m", [i / k for i in range(k + 1)])
    return q.select(F.col("prob_idx").alias("cutoff_idx"), F.col("value").alias("cutoff_micros"))


def cutoffs_array(cutoffs: DataFrame) -> DataFrame:
    """One-row frame holding the cutoff micros as a sorted array."""
    return cutoffs.agg(F.array_sort(F.collect_list(F.struct("cutoff_idx", "cutoff_micros"))).alias("_c")) \
        .select(F.transform("_c", lambda s: s["cutoff_micros"]).alias("cutoffs"))


def assign_windows(df: DataFrame, roles: Roles = Roles(), k: int = 5, seed: int = SEED,
                   cutoffs: DataFrame | None = None, out: str = "window_id") -> DataFrame:
    """T4: positives -> window whose [lo, hi) holds the date (last window
    closed); undated negatives -> seeded order cut into K near-equal chunks,
    the first ``n mod K`` chunks one row longer.

    The interval lookup is an array expression over the broadcast cutoffs,
    not a theta join.
    """
    if cutoffs is None:
        cutoffs = window_cutoffs(df, roles, k)
    x = df.withColumn("cutoffs", cutoffs_array(cutoffs).select("cutoffs").scalar())
    m = _ts_micros(F.col(roles.date)).cast("double")
    interior = F.slice("cutoffs", 2, k - 1)
    pos_w = F.least(F.size(F.filter(interior, lambda c: c <= m)), F.lit(k - 1))
    pos = x.filter(F.col(roles.label) == 1).withColumn(out, pos_w.cast("int")).drop("cutoffs")
    neg = seeded_rank(x.filter(F.col(roles.label) != 1).drop("cutoffs"), roles.id, seed, out="_r")
    n, r = F.col("_r_n"), F.col("_r")
    q, rem = F.floor(n / k), F.pmod(n, F.lit(k))
    big = rem * (q + 1)
    chunk = F.when(r < big, F.floor(r / (q + 1))).otherwise(rem + F.floor(F.try_divide(r - big, q)))
    neg = neg.withColumn(out, chunk.cast("int")).drop("_r", "_r_n")
    return pos.unionByName(neg)


def calibration_tail(windowed: DataFrame, roles: Roles = Roles(), fraction: float = 0.15,
                     seed: int = SEED, window_col: str = "window_id", out: str = "part") -> DataFrame:
    """T5: per window, the newest ``max(round(n_pos*f), 1)`` positives and a
    seeded ``round(n_neg*f)`` negatives are 'calibration', the rest 'fit'.

    Positives are ordered newest-first; ties on the boundary day are broken
    in seeded order (the original sort was unstable, ours is deterministic).
    Only the (window, day) histogram is windowed; rows of the one boundary
    day per window are ranked with the bucketed ``seeded_rank``, so a day
    holding most of the rows is still spread over many tasks.
    """
    pos = windowed.filter(F.col(roles.label) == 1)
    days = pos.groupBy(window_col, F.col(roles.date).alias("_d")).agg(F.count(F.lit(1)).alias("_c"))
    w_newer = Window.partitionBy(window_col).orderBy(F.col("_d").desc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    w_tot = Window.partitionBy(window_col)
    days = days.select(window_col, "_d", "_c", F.coalesce(F.sum("_c").over(w_newer), F.lit(0)).alias("_newer"),
                       F.sum("_c").over(w_tot).alias("_npos"))
    days = days.withColumn("_ncal", F.greatest(F.bround(F.col("_npos") * F.lit(fraction), 0), F.lit(1)))
    days = days.withColumnsRenamed({"_d": "_day", window_col: "_win"})
    p = pos.join(days, (F.col(window_col) == F.col("_win")) & F.col(roles.date).eqNullSafe(F.col("_day"))).drop("_day", "_win")
    # undated positives count as the oldest ones
    whole_in = F.col("_newer") + F.col("_c") <= F.col("_ncal")
    whole_out = F.col("_newer") >= F.col("_ncal")
    settled = p.filter(whole_in | whole_out).withColumn(
        out, F.when(whole_in, "calibration").otherwise("fit"))
    straddle = seeded_rank(p.filter(~(whole_in | whole_out)), roles.id, seed, by=[window_col, roles.date], out="_r")
    straddle = straddle.withColumn(
        out, F.when(F.col("_newer") + F.col("_r") < F.col("_ncal"), "calibration").otherwise("fit")
    ).drop("_r", "_r_n")
    extra = ["_c", "_newer", "_npos", "_ncal"]
    p = settled.drop(*extra).unionByName(straddle.drop(*extra))
    neg = seeded_rank(windowed.filter(F.col(roles.label) != 1), roles.id, seed, by=[window_col], out="_r")
    neg = neg.withColumn(out, F.when(F.col("_r") < F.bround(F.col("_r_n") * F.lit(fraction), 0), "calibration")
                         .otherwise("fit")).drop("_r", "_r_n")
    return p.unionByName(neg)


def assign_folds(df: DataFrame, roles: Roles = Roles(), k: int = 10, seed: int = SEED,
                 out: str = "fold", by: Sequence[str] = ()) -> DataFrame:
    """Stratified folds — rank within label (and ``by``) in seeded
    order, mod k."""
    r = seeded_rank(df, roles.id, seed, by=[*by, roles.label], out="_r")
    return r.withColumn(out, F.pmod(F.col("_r"), F.lit(k)).cast("int")).drop("_r", "_r_n")


def _smallest(df: DataFrame, roles: Roles, counts: dict, seed: int) -> DataFrame:
    """The first ``counts[label]`` rows of each listed label in seeded order, with
    their hash in ``_h`` and their 0-based place in ``_r``. Every task passes on
    no more rows of a label than asked for, so nothing else is shuffled."""
    hashed = df.withColumn("_h", F.coalesce(seeded_hash(roles.id, seed), F.lit("")))
    parts = []
    for label, n in counts.items():
        first = hashed.filter(F.col(roles.label) == label).orderBy("_h", roles.id).limit(n)
        parts.append(first.withColumn("_r", (F.row_number().over(Window.partitionBy(roles.label).orderBy("_h", roles.id)) - 1).cast("long")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def prevalence_sample(df: DataFrame, roles: Roles = Roles(), n: int = 500, rate: float = 0.10,
                      seed: int = SEED) -> DataFrame:
    """Exactly ``round(n*rate)`` positives and ``n - that`` negatives,
    without replacement, in seeded (shuffled) order — a sampling operator, so
    the limit is the feature. Adds ``sample_pos`` (0-based order)."""
    n_pos = int(round(n * rate))
    picked = _smallest(df, roles, {1: n_pos, 0: n - n_pos}, seed)
    w = Window.orderBy("_h2")
    # at most n rows reach this window by construction
    return (picked.withColumn("_h2", F.md5(F.concat(F.lit(f"{seed}:shuffle:"), F.col(roles.id).cast("string"))))
            .withColumn("sample_pos", F.row_number().over(w) - 1)
            .drop("_r", "_h", "_h2"))


def per_class_sample(df: DataFrame, roles: Roles = Roles(), counts: dict | None = None,
                     seed: int = SEED, label_names: dict | None = None) -> DataFrame:
    """A fixed number of rows per class (default 3 positives, 2 negatives)
    in seeded order, with ``pick`` = 0-based position inside the class and,
    when ``label_names`` is given, a ``label_name`` column."""
    picked = _smallest(df, roles, counts or {1: 3, 0: 2}, seed).withColumnRenamed("_r", "pick").drop("_h")
    if label_names:
        m = F.create_map(*[x for k, v in label_names.items() for x in (F.lit(k), F.lit(v))])
        picked = picked.withColumn("label_name", m[F.col(roles.label)])
    return picked


def first_months_per_year(df: DataFrame, date_col: str, months: int = 1) -> DataFrame:
    """Keep rows from the first ``months`` months (having data) of each year.

    The (year, month) table is tiny; it is ranked and semi-joined back.
    """
    ym = df.select(F.year(date_col).alias("_y"), F.month(date_col).alias("_m")).distinct()
    keep = ym.withColumn("_rk", F.dense_rank().over(Window.partitionBy("_y").orderBy("_m"))) \
        .filter(F.col("_rk") <= months).drop("_rk")
    x = df.withColumn("_y", F.year(date_col)).withColumn("_m", F.month(date_col))
    return x.join(F.broadcast(keep), ["_y", "_m"], "left_semi").drop("_y", "_m")
