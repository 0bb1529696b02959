"""Seeded order and exact ranks without a global sort.

``seeded_hash`` gives every row a reproducible pseudo-random position,
``md5('<seed>:<id>')`` — the same bytes in Spark and DuckDB.

``seeded_rank`` turns it into an exact 0-based rank within groups, the
scalable way: a histogram over the first hex characters of the hash gives
each bucket its offset, and the final ``row_number`` only orders rows *inside*
one bucket. Since the hash is uniform, a group holding a third of all rows is
spread over 65,536 independent sorts instead of one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Leading hex digits of a bucket, and of the coarse buckets that hold them.
DIGITS, COARSE = 4, 2


def seeded_hash(id_col: str | Column, seed: int) -> Column:
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.md5(F.concat(F.lit(f"{seed}:"), c.cast("string")))


def hash_uniform(h: Column) -> Column:
    """First 8 hex digits of a hash as a number in [0, 1]."""
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("double") / F.lit(4294967295.0)


def seeded_rank(df: DataFrame, id_col: str, seed: int, by: Sequence[str] = (),
                out: str = "_rank", keep_hash: str | None = None) -> DataFrame:
    """Add ``out`` = 0-based rank of each row within ``by`` in seeded order
    (ties broken by id). Also adds ``<out>_n`` = size of the group. Rows whose
    ``by`` columns are null form groups like any others.

    The input is read twice: for a partial aggregation to at most
    ``|by| x 16^DIGITS`` counts, and for one exchange on (by, bucket) that the
    offsets join and the in-bucket window share. Offsets are running sums in
    two steps, so that no task sees more than 256 counts of a group at once.
    """
    by = list(by)
    h, b, a = "_h_" + out, "_b_" + out, "_a_" + out
    x = df.withColumn(h, F.coalesce(seeded_hash(id_col, seed), F.lit(""))).withColumn(b, F.substring(h, 1, DIGITS))
    counts = x.groupBy(*by, b).agg(F.count(F.lit(1)).alias("_c")).withColumn(a, F.substring(b, 1, COARSE))
    upto = lambda w, o: w.orderBy(o).rowsBetween(Window.unboundedPreceding, -1)
    total = lambda w: F.coalesce(F.sum("_c").over(w), F.lit(0))
    fine = counts.select(*by, a, b, total(upto(Window.partitionBy(*by, a), b)).alias("_fine"))
    coarse = counts.groupBy(*by, a).agg(F.sum("_c").alias("_c"))
    coarse = coarse.select(*by, a, total(upto(Window.partitionBy(*by), a)).alias("_coarse"),
                           F.sum("_c").over(Window.partitionBy(*by)).alias(out + "_n"))
    offsets = _join(fine, coarse, by, a).withColumn("_off", F.col("_fine") + F.col("_coarse")).drop("_fine", "_coarse", a)
    joined = _join(x, offsets, by, b)
    w_in = Window.partitionBy(*by, b).orderBy(h, id_col)
    res = joined.withColumn(out, F.col("_off") + F.row_number().over(w_in) - 1).drop("_off", b)
    if keep_hash:
        return res.withColumnRenamed(h, keep_hash)
    return res.drop(h)


def _join(left: DataFrame, right: DataFrame, by: Sequence[str], key: str) -> DataFrame:
    """Inner join on ``by`` (null equals null) and ``key``; ``right`` gives its other columns."""
    names = {c: f"_right_{c}" for c in [*by, key]}
    right = right.withColumnsRenamed(names)
    same = F.col(key) == F.col(names[key])
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(names[c]))
    return left.join(right, same).drop(*names.values())
