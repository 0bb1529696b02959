"""Numeric helpers and column-level coercion (F10–F14, P1–P4, P8, NaN rule).

Rule: NaN is turned into NULL where data enters (``nan_to_null``), so
comparisons such as ``entropy >= 7.5`` keep their meaning (Spark orders NaN
above every number).
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def nan_to_null(col: str | Column) -> Column:
    c = _c(col)
    return F.when(F.isnan(c), F.lit(None).cast("double")).otherwise(c)


def is_finite(col: str | Column) -> Column:
    c = _c(col)
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf")))


def log1p_safe(col: str | Column) -> Column:
    """non-finite or negative -> 0, then log1p."""
    c = _c(col).cast("double")
    return F.log1p(F.when(is_finite(c) & (c >= 0), c).otherwise(F.lit(0.0)))


def clip(col: str | Column, lo: float, hi: float) -> Column:
    """clip into [lo, hi]."""
    return F.least(F.greatest(_c(col), F.lit(lo)), F.lit(hi))


def drop_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Drop those of ``names`` that exist."""
    return df.drop(*[n for n in names if n in df.columns])


def coerce_numeric(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Unparseable -> NULL (``try_cast``; a plain cast throws under ANSI),
    NaN -> NULL."""
    present = [c for c in cols if c in df.columns]
    return df.withColumns({c: nan_to_null(F.expr(f"try_cast(`{c}` AS DOUBLE)")) for c in present})


def coercion_loss(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Per column, how many non-null values became NULL on coercion;
    only columns that lost something. One aggregation for all columns."""
    aggs = [F.count_if(F.col(c).isNotNull() & nan_to_null(F.expr(f"try_cast(`{c}` AS DOUBLE)")).isNull())
            .alias(c) for c in cols]
    wide = df.agg(*aggs)
    long = wide.unpivot([], list(cols), "column", "n_lost")
    return long.filter(F.col("n_lost") > 0)


def require_columns(df: DataFrame, needed: Sequence[str]) -> DataFrame:
    """Select the needed columns, naming every missing one."""
    missing = sorted(set(needed) - set(df.columns))
    if missing:
        raise ValueError(f"no column named {', '.join(missing)}")
    return df.select(*needed)


def finite_filter(df: DataFrame, col: str) -> DataFrame:
    """Keep rows whose value is finite (not NULL, NaN or +-inf)."""
    return df.filter(is_finite(col))
