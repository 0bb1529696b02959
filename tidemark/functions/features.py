"""Engineered features (F5, F7–F9) and the enrichment step.

``engineer`` adds all eight columns in one projection; the parsed lists are
computed in an inner ``select`` so each string is parsed once per row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.config import ENGINEERED_FEATURES, FeatureSpec
from tidemark.functions import lists as L


def timestamp_year(col: str | Column, formats=FeatureSpec.timestamp_formats) -> Column:
    """year of the first format that parses; NULL if none does."""
    c = F.col(col) if isinstance(col, str) else col
    c = F.trim(c)
    return F.year(F.coalesce(*[F.try_to_timestamp(c, F.lit(f)) for f in formats])).cast("int")


def year_anomaly(year: Column, lo: int, hi: int) -> Column:
    """1 if the year is missing or outside [lo, hi]."""
    return F.when(year.isNull() | ~year.between(lo, hi), 1).otherwise(0)


def count_anomaly(n: Column, many: int) -> Column:
    """F8: 1 if the count is 0 or above ``many``."""
    return F.when((n == 0) | (n > many), 1).otherwise(0)


ENGINEERED = ENGINEERED_FEATURES


def engineer(df: DataFrame, spec: FeatureSpec = FeatureSpec()) -> DataFrame:
    """add the eight engineered columns; a missing source column gives 0
    (year NULL, hence time anomaly 1 and — with 0 DLLs — count anomaly 1).
    The input columns are kept unchanged."""
    cols = set(df.columns)
    has = {k: getattr(spec, k) in cols for k in ("dlls", "symbols", "identify", "timestamp")}
    inner = df
    lists = {out: getattr(spec, k) for k, out in (("dlls", "_dll_list"), ("symbols", "_sym_list")) if has[k]}
    inner = inner.withColumns({f"{out}_text": L.stripped(c) for out, c in lists.items()})
    inner = inner.withColumns({out: L.list_from_literal(f"{out}_text", is_stripped=True) for out in lists})
    zero = F.lit(0)
    n_dlls = F.size("_dll_list") if has["dlls"] else zero
    n_syms = F.size("_sym_list") if has["symbols"] else zero
    year = timestamp_year(spec.timestamp, spec.timestamp_formats) if has["timestamp"] else F.lit(None).cast("int")
    names = F.array(*[F.lit(n) for n in spec.dangerous_names])
    danger = (F.coalesce(F.arrays_overlap(F.array_compact("_sym_list"), names), F.lit(False)).cast("int")
              if has["symbols"] else zero)
    out = inner.withColumns({
        "n_imported_dlls": n_dlls.cast("int"),
        "n_imported_symbols": n_syms.cast("int"),
        "identify_is_packed": L.contains_any(spec.identify, spec.packer_patterns) if has["identify"] else zero,
        "identify_signature_count": L.signature_count(spec.identify) if has["identify"] else zero,
        "formatted_timedatestamp_year": year,
        "imports_dangerous_api": danger,
    })
    out = out.withColumns({
        "time_alignment_anomaly": year_anomaly(F.col("formatted_timedatestamp_year"), spec.year_min, spec.year_max),
        "dll_count_anomaly": count_anomaly(F.col("n_imported_dlls"), spec.dll_many),
    })
    return out.drop(*lists, *[f"{c}_text" for c in lists])
