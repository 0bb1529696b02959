"""Helpers shared by the operators of this package."""

from __future__ import annotations

import sys
import types

import pyspark.sql.functions as F
from pyspark.sql import Column, DataFrame, SparkSession

from tidemark.session import materialize

#: ASCII upper and lower case, for lower-casing A-Z alone.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def col(name: str) -> Column:
    """A column by its exact name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, all other characters as they are."""
    return F.translate(text, UPPER, LOWER)


def written(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write an intermediate to the cluster's shared folder and read it back.

    Later steps read files instead of recomputing, also after an executor is
    lost, and row numbers made by non-deterministic functions stay fixed.
    """
    return materialize(df, f"llm-{name}", compression)


def worker_cache(key, make):
    """What ``make()`` returned when this Python worker was first asked for
    ``key``. Workers outlive tasks; code pickled by value does not."""
    held = sys.modules.setdefault("_llm_worker_cache", types.ModuleType("_llm_worker_cache")).__dict__
    if key not in held:
        held[key] = make()
    return held[key]
