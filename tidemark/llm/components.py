"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

import pyspark.sql.functions as F
from pyspark.sql import DataFrame

from .common import written


def connected_components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of the links ``a, b``; the root is the
    smallest node of the component.

    Each round links every node's larger neighbours to its smallest one, then
    every node's smaller-or-equal ones to the smallest of those (large and small
    star). Rounds are logarithmic in practice, all state stays in written
    tables, and only a count reaches the driver. Minima are combined before each
    shuffle; a hub's links meet in a join, which Spark splits when skewed.
    """
    edges = written(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    while True:
        # large star: of all neighbours, larger ones get the smallest
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: smaller neighbours and the node itself get the smallest
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(
            F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select(
            "e.u", "e.v").where("u <> v").distinct()
        after = written(small, "links")
        changed = after.join(edges, ["u", "v"], "left_anti").limit(1).count() + (after.count() != edges.count())
        edges = after
        if not changed:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
