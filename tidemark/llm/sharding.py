"""Uniform shuffling into shards of exact sizes (operator 3).

A random permutation of all rows is drawn in four steps, none of which needs a
global sort:

1. every source partition permutes its rows locally;
2. a communication matrix says how many rows each partition sends to each shard.
   Its law, given the partitions' and the shards' sizes, is multivariate
   hypergeometric. It is drawn exactly over a binary tree of the partitions:
   a node's shard counts are split between its two halves, one shard after the
   other, by inverting the hypergeometric distribution function. All nodes of a
   level are rows of one table, so the driver sees none of the matrix;
3. rows are exchanged: the first rows of a partition's order go to shard 0, and
   so on;
4. every shard permutes what it received. The order is that of a second hash;
   a shard is cut into hash ranges, whose counts give each range its first slot,
   so that one shard of any size is numbered by many tasks.

All steps are DataFrame operations. Texts are read once, and only ids, sizes and
checksums are written and moved. Once the local order is written, all that
follows depends on that table alone, also if executors are lost.
"""

from __future__ import annotations

import math

import pyspark.sql.functions as F
from pyspark.sql import Column, DataFrame, Window

from .common import col, written

#: Rows that one hash range of a shard holds, about.
RANGE_ROWS = 20_000
#: Standard deviations around the mode beyond which a hypergeometric law has no
#: weight that a double could show.
SPREAD = 10


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _hypergeometric(u: Column, take: Column, good: Column, total: Column) -> Column:
    """How many of ``take`` rows drawn from ``total`` are among the ``good``:
    the smallest count whose distribution function exceeds ``u``.

    Weights start at 1 at the lower end of the law's range and follow from the
    ratio of neighbouring probabilities; a first sum normalises the second.
    """
    mean = take * good / total
    spread = F.sqrt(F.greatest(mean * (1 - good / total) * (total - take) / F.greatest(total - 1, F.lit(1)), F.lit(0.0)))
    low = F.greatest(F.lit(0).cast("long"), take + good - total, F.floor(mean - SPREAD * spread).cast("long") - SPREAD)
    high = F.least(take, good, F.ceil(mean + SPREAD * spread).cast("long") + SPREAD)
    ratio = lambda k: (good - k) * 1.0 * (take - k) / ((k + 1) * 1.0 * (total - good - take + k + 1))

    def within(b):
        counts = F.sequence(b["low"], b["high"])
        whole = F.aggregate(counts, F.struct(F.lit(1.0).alias("w"), F.lit(0.0).alias("sum")), lambda a, k: F.struct(
            (a["w"] * ratio(k)).alias("w"), (a["sum"] + a["w"]).alias("sum")), lambda a: a["sum"])
        return _let(whole * u, lambda aim: F.aggregate(
            counts, F.struct(F.lit(1.0).alias("w"), F.lit(0.0).alias("sum"), b["low"].alias("k")), lambda a, k: F.struct(
                (a["w"] * ratio(k)).alias("w"), (a["sum"] + a["w"]).alias("sum"),
                F.when(a["sum"] + a["w"] <= aim, F.least(k + 1, b["high"])).otherwise(a["k"]).alias("k")), lambda a: a["k"]))

    return F.when(total <= 0, F.lit(0).cast("long")).otherwise(_let(F.struct(low.alias("low"), high.alias("high")), within))


def _uniform(seed: int, *parts: Column) -> Column:
    """A number in [0, 1) that depends on the seed and the parts."""
    return F.pmod(F.shiftright(F.xxhash64(F.lit(seed), *parts), 11), F.lit(1 << 53)) / float(1 << 53)


def _split(caps: Column, take: Column, total: Column, seed: int, node: Column) -> Column:
    """Shard counts of the ``take`` rows of a node's left half, out of the
    node's shard counts ``caps``, which sum to ``total``."""
    start = F.struct(take.alias("take"), total.alias("total"), F.array().cast("array<bigint>").alias("drawn"))

    def step(a, s):
        good = F.get(caps, s)
        return _let(_hypergeometric(_uniform(seed, node, s), a["take"], good, a["total"]), lambda k: F.struct(
            (a["take"] - k).alias("take"), (a["total"] - good).alias("total"), F.concat(a["drawn"], F.array(k)).alias("drawn")))

    return F.aggregate(F.sequence(F.lit(0), F.size(caps) - 1), start, step, lambda a: a["drawn"])


def communication_matrix(sizes: DataFrame, capacities: list[int], seed: int) -> DataFrame:
    """``part, counts``: how many rows each partition (``part`` from 0, ``n``)
    sends to each shard. Rows and columns have exactly the sizes asked for."""
    top = (sizes.agg(F.max("part")).first()[0] or 0) + 1
    depth = max(1, math.ceil(math.log2(top)) if top > 1 else 1)
    # rows below every node of every level; node 1 is the root, node 2n and 2n + 1 are the halves of n
    leaf = F.col("part") + F.lit(1 << depth)
    totals = written(sizes.select(F.explode(F.transform(F.sequence(F.lit(0), F.lit(depth)), lambda up: F.floor(
        leaf / F.pow(F.lit(2), up)).cast("long"))).alias("node"), "n").groupBy("node").agg(F.sum("n").alias("n")), "shard-totals")
    nodes = totals.where("node = 1").select("node", "n", F.array(*[F.lit(c).cast("long") for c in capacities]).alias("caps"))
    for _ in range(depth):
        left = totals.where("node % 2 = 0").select((F.col("node") / 2).cast("long").alias("node"), F.col("n").alias("left"))
        halves = nodes.join(left, "node", "left").withColumn("left", F.coalesce("left", F.lit(0).cast("long")))
        drawn = halves.select("node", "n", "left", "caps", _split(F.col("caps"), F.col("left"), F.col("n"), seed, F.col("node")).alias("drawn"))
        nodes = written(drawn.select(F.explode(F.array(
            F.struct((F.col("node") * 2).alias("node"), F.col("left").alias("n"), F.col("drawn").alias("caps")),
            F.struct((F.col("node") * 2 + 1).alias("node"), (F.col("n") - F.col("left")).alias("n"),
                     F.zip_with("caps", "drawn", lambda c, d: c - d).alias("caps")))).alias("x")).select("x.*").where("n > 0"), "shard-nodes")
    return nodes.select((F.col("node") - F.lit(1 << depth)).alias("part"), F.col("caps").alias("counts"))


def shuffle_into_shards(docs: DataFrame, shards: int, seed: int = 11, id_col: str = "doc_id", text_col: str = "text",
                        range_rows: int = RANGE_ROWS) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot``, a row per input row.

    Shard sizes differ by at most one row, the first shards being the larger
    ones; slots of a shard run from 0 without gaps. Every assignment of rows to
    places is equally likely, up to the quality of the hashes, so equal texts
    and repeated rows are placed apart like any others. ``size`` is the UTF-8
    length plus 1 (a null text: 1, with checksum null). Null ids are kept. The
    draw depends on the seed, on the rows and on how the input is partitioned.
    An empty table gives no rows.
    """
    size = (F.coalesce(F.octet_length(col(text_col)), F.lit(0)) + 1).cast("long")
    rows = docs.select(col(id_col).alias("doc_id"), size.alias("size"), F.crc32(col(text_col)).alias("text_crc32"))
    # the numbers that follow the local sort hold the partition (upper bits) and the place in it
    local = written(rows.sortWithinPartitions(F.rand(seed), "doc_id").select(
        "*", F.monotonically_increasing_id().alias("place")), "shard-rows")
    part, rank = F.shiftright("place", 33), F.col("place").bitwiseAND((1 << 33) - 1)
    sizes = local.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    total = local.count()
    capacities = [total // shards + (s < total % shards) for s in range(shards)]
    matrix = communication_matrix(sizes, capacities, seed)
    # the shard of a row: how many running sums of its partition's counts its rank has passed
    ends = F.transform(F.sequence(F.lit(1), F.lit(shards)), lambda s: F.aggregate(
        F.slice("counts", 1, s), F.lit(0).cast("long"), lambda a, c: a + c))
    sent = local.select("*", part.alias("part"), rank.alias("rank")).join(matrix.select("part", ends.alias("ends")), "part").select(
        "doc_id", "size", "text_crc32", F.size(F.filter("ends", lambda e: e <= F.col("rank"))).alias("shard"),
        F.xxhash64(F.lit(seed + 1), "place").alias("order"), "place")
    pieces = max(1, math.ceil(total / shards / range_rows))
    piece = F.floor(_unsigned_share("order") * pieces).cast("int")
    received = sent.withColumn("piece", piece)
    counts = received.groupBy("shard", "piece").agg(F.count("*").alias("n"))
    first = counts.withColumn("first", F.sum("n").over(Window.partitionBy("shard").orderBy("piece")) - F.col("n")).drop("n")
    within = F.row_number().over(Window.partitionBy("shard", "piece").orderBy("order", "place")) - 1
    return received.withColumn("within", within).join(first, ["shard", "piece"]).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("first") + F.col("within")).cast("long").alias("slot"))


def _unsigned_share(name: str) -> Column:
    """A hash as a share of its range, growing with its signed order."""
    return (F.shiftright(name, 11) + F.lit(1 << 52)) / float(1 << 53)
