"""Mixing sources to target weights by entropy balancing (operator 12).

Every source gets a target of words. Each document gets a rate ``r``, the number
of times that the mix should hold it, between 0 and ``MOST``. Among all rates
that meet the targets, those are wanted that stay closest to taking each document
once, by relative entropy: the minimum of ``sum r ln r - r + 1`` subject to
``sum size * r = target`` for each source and to the bound. Its solution is an
exponential tilt, ``r = min(MOST, exp(lambda * size))`` with one ``lambda`` per
source, which is the maximum of the concave dual. Newton iterations find it: each
one sums the words of all documents at the present tilt, and their derivative, by
source, in one distributed aggregation over the counts of (source, size). A step
that leaves the bracket of the root is replaced by the middle of the bracket.

Rates become whole copies by systematic rounding: a source's documents are put in
order of falling size, equal sizes by a hash of their ids, and a document gets one
copy more whenever the running sum of the rates' fractions passes a half. Any
first k documents then have at most half a copy too many or too few, so that a
source's words miss its target by half a document at most (and a rounding error
of the sums). No order is global: running sums over size buckets, sizes and
hash ranges give each document its place.

All steps are DataFrame operations. Texts are read once, for their sizes.
"""

from __future__ import annotations

import pyspark.sql.functions as F
from pyspark.sql import Column, DataFrame, Window

from tidemark.operators.quantiles import value_bucket

from .common import col, written

BLANKS = " \t\n\x0b\x0c\r"
#: Weights of the sources in code point order, repeating.
WEIGHTS = (5, 2, 1)
#: The mix's words as a share of all words.
SHARE = 1.5
#: How often a document, and so a source, may be taken at most.
MOST = 2.0
#: Documents of one hash range, about.
RANGE_ROWS = 20_000
#: Relative error of a source's words at which its iterations end, and how many there may be.
PRECISION, ITERATIONS = 1e-10, 200


def word_count(text: Column) -> Column:
    """Runs of other than blanks; 0 for null."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(trimmed == "", 0).otherwise(F.size(F.split(trimmed, r"[\x20\x09-\x0D]+"))).cast("long")


def source_targets(sources: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """Adds ``number`` (the sources' places in code point order, null last, from
    0), ``weight``, ``target`` and ``full`` to ``source, source_size``.

    Targets split ``share`` of all words by weight. A source's target is at most
    ``most`` times its words; what is beyond goes to the others by weight, until
    none is above (then it is ``full``).
    """
    by = F.col("source").asc_nulls_last()
    placed = written(sources.repartitionByRange(by).sortWithinPartitions(by).select("*", F.monotonically_increasing_id().alias("place")),
                     "mix-sources")
    part = F.shiftright("place", 33)
    first = placed.groupBy(part.alias("part")).agg(F.count("*").alias("n")).select(  # a row per partition
        "part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("first"))
    number = F.col("first") + F.col("place").bitwiseAND((1 << 33) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("number") % len(weights) + 1).cast("int"))
    numbered = written(placed.withColumn("part", part).join(F.broadcast(first), "part").withColumn("number", number)
                       .withColumn("weight", weight).drop("place", "part", "first"), "mix-numbered")
    most_words = most * F.col("source_size")
    goal = share * float(numbered.agg(F.sum("source_size")).first()[0] or 0)
    rest, left, n_full = goal, numbered.agg(F.sum("weight")).first()[0] or 1.0, 0
    while True:  # the level rises, so sources only ever become full
        full = rest * F.col("weight") / left > most_words
        n, taken, open_ = numbered.agg(F.count_if(full), F.sum(F.when(full, most_words)), F.sum(F.when(~full, F.col("weight")))).first()
        if n == n_full or not open_:
            break
        rest, left, n_full = goal - (taken or 0.0), open_, n
    return numbered.withColumn("full", full).withColumn(
        "target", F.when(F.col("full"), most_words).otherwise(rest * F.col("weight") / left))


def tilted_rate(most: float = MOST) -> Column:
    """A document's rate from its source's ``tilt`` and ``scale`` and its size."""
    return F.least(F.lit(most), F.exp(F.least(F.col("tilt") * F.col("size") / F.col("scale"), F.lit(50.0))))


def entropy_balance(counts: DataFrame, targets: DataFrame, most: float = MOST, precision: float = PRECISION,
                    iterations: int = ITERATIONS) -> DataFrame:
    """``number, tilt, scale`` for each source that is neither full nor without
    words: the dual's solution in units of the source's mean size (``scale``).

    ``counts`` has ``number, size, n``; ``targets`` is of ``source_targets``.
    Raises if a source does not get to its target.
    """
    words = counts.where("size > 0")
    none = F.lit(None).cast("double")
    mean = words.groupBy("number").agg((F.sum(F.col("size") * F.col("n")) / F.sum("n")).alias("scale"))
    state = written(targets.where("NOT full AND source_size > 0").join(mean, "number").select(
        "number", "target", "scale", F.lit(0.0).alias("tilt"), none.alias("low"), none.alias("high"), F.lit(False).alias("done")), "mix-dual")
    for _ in range(iterations):
        rate, size = tilted_rate(most), F.col("n") * F.col("size")
        slope = F.when(rate < most, size * F.col("size") / F.col("scale") * rate).otherwise(0.0)
        sums = words.join(state.where("NOT done").select("number", "tilt", "scale"), "number").groupBy("number").agg(
            F.sum(size * rate).alias("words"), F.sum(slope).alias("slope"))
        x = state.join(sums, "number", "left").withColumn("over", F.col("words") - F.col("target"))
        x = x.withColumn("low", F.when(F.col("over") < 0, F.col("tilt")).otherwise(F.col("low"))).withColumn(
            "high", F.when(F.col("over") > 0, F.col("tilt")).otherwise(F.col("high")))
        newton = F.when(F.col("slope") > 0, F.col("tilt") - F.col("over") / F.col("slope"))
        inside = newton.isNotNull() & (F.col("low").isNull() | (newton > F.col("low"))) & (F.col("high").isNull() | (newton < F.col("high")))
        wider = F.greatest(F.lit(1.0), F.abs("tilt"))
        away = F.when(F.col("low").isNull(), F.col("tilt") - wider).when(F.col("high").isNull(), F.col("tilt") + wider).otherwise(
            (F.col("low") + F.col("high")) / 2)
        done = F.col("done") | (F.abs("over") <= precision * F.col("target")) | (F.col("high") - F.col("low") <= 1e-15 * F.abs("tilt"))
        done = F.coalesce(done, F.lit(False))
        state = written(x.select("number", "target", "scale", F.when(done, F.col("tilt")).when(inside, newton).otherwise(away).alias("tilt"),
                                 "low", "high", done.alias("done")), "mix-dual")
        if state.where("NOT done").isEmpty():
            return state.select("number", "tilt", "scale")
    raise ArithmeticError("the iterations have not met all targets")


def _places(cells: DataFrame, range_rows: int) -> DataFrame:
    """Adds ``before``, the sum of the fractions of a source's larger documents,
    and ``pieces``, the hash ranges of a size, to ``number, size, n, fraction``."""
    cells = cells.withColumn("bucket", -value_bucket(F.col("size").cast("double"))).withColumn("f", F.col("n") * F.col("fraction"))
    upto = lambda w: F.coalesce(F.sum("f").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    coarse = cells.groupBy("number", "bucket").agg(F.sum("f").alias("f")).select(
        "number", "bucket", upto(Window.partitionBy("number").orderBy("bucket")).alias("coarse"))
    fine = cells.withColumn("fine", upto(Window.partitionBy("number", "bucket").orderBy(F.desc("size"))))
    return fine.join(coarse, ["number", "bucket"]).withColumn("before", F.col("coarse") + F.col("fine")).withColumn(
        "pieces", F.ceil(F.col("n") / range_rows)).drop("bucket", "f", "coarse", "fine")


def mix_sources(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST, seed: int = 12, id_col: str = "doc_id",
                text_col: str = "text", source_col: str = "source", range_rows: int = RANGE_ROWS) -> DataFrame:
    """``doc_id, source, size, source_size, target, rate, copies, taken``, a row
    per input row: ``copies`` is how often the mix holds the document, ``taken``
    its words times that.

    Null, empty and blank texts have no words. Null sources are one source, the
    last. Rows equal in id, source and size are told apart by nothing, and any of
    them may get the copies of another; null ids are ids like others. The result
    depends on the seed and the rows alone, not on how they are partitioned.
    Further columns are not read. An empty table gives no rows.
    """
    sized = written(docs.select(col(id_col).alias("doc_id"), col(source_col).alias("source"), word_count(col(text_col)).alias("size")), "mix-sizes")
    counted = written(sized.groupBy("source", "size").agg(F.count("*").alias("n")), "mix-counts")
    targets = written(source_targets(counted.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).cast("long").alias("source_size")),
                                     weights, share, most), "mix-targets")
    names = targets.select("number", F.col("source").alias("name"))
    counts = written(counted.join(names, F.col("source").eqNullSafe(F.col("name"))).select("number", "size", "n"), "mix-numbered-counts")
    tilts = entropy_balance(counts, targets, most)
    rated = counts.join(targets.select("number", "full"), "number").join(tilts, "number", "left").select(
        "number", "size", "n", F.when(F.col("full"), F.lit(most)).otherwise(F.coalesce(tilted_rate(most), F.lit(1.0))).alias("rate"))
    whole = F.floor("rate")
    cells = written(_places(rated.withColumn("fraction", F.col("rate") - whole), range_rows), "mix-cells")

    # rows equal in source, size and id are one row with their number, until the end
    h = F.xxhash64(F.lit(seed), "doc_id")
    share_of = (F.shiftright(h, 11) + F.lit(1 << 52)) / float(1 << 53)  # grows with the hash
    groups = sized.groupBy("source", "size", "doc_id").agg(F.count("*").alias("m")).join(
        names, F.col("source").eqNullSafe(F.col("name"))).drop("name").join(cells, ["number", "size"]).withColumn(
        "h", h).withColumn("piece", F.floor(share_of * F.col("pieces")))
    # the join may deal rows by source and size, of which one may hold a third of all rows: ranges are what tasks get
    groups = groups.repartition("number", "size", "piece")
    ranges = groups.groupBy("number", "size", "piece").agg(F.sum("m").alias("m"))
    first = ranges.select("number", "size", "piece", (F.sum("m").over(
        Window.partitionBy("number", "size").orderBy("piece")) - F.col("m")).alias("first"))
    within = F.sum("m").over(Window.partitionBy("number", "size", "piece").orderBy("h", "doc_id").rowsBetween(Window.unboundedPreceding, 0)) - F.col("m")
    ranked = groups.withColumn("within", within).join(first, ["number", "size", "piece"])
    place = F.col("first") + F.col("within") + F.col("j")
    up = lambda k: F.floor(F.col("before") + k * F.col("fraction") + 0.5)
    extra = F.when(F.col("fraction") > 0, F.least(F.lit(1), up(place + 1) - up(place))).otherwise(0)
    rows = ranked.withColumn("j", F.explode(F.sequence(F.lit(0).cast("long"), F.col("m") - 1))).select(
        "doc_id", "source", "size", "number", "rate", (whole + extra).cast("long").alias("copies"))
    return rows.join(targets.select("number", "source_size", "target"), "number").select(
        "doc_id", "source", "size", "source_size", "target", "rate", "copies", (F.col("copies") * F.col("size")).alias("taken"))
