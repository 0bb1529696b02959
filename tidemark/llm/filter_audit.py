"""How document filters interact (operator 13).

Which filters a document fails does not depend on their order, so one row of
five flags for each document holds all that any order of the filters does.

The two filters on words come from a sparse document-term matrix:

1. every task packs its documents into shards of compressed sparse rows: row
   ends, column numbers and counts, with a dictionary of the shard's own words;
   what the filters on characters say is noted with each document;
2. the shards' dictionaries are merged into one global dictionary, which numbers
   each distinct word of the corpus from 0 without gaps. Only a shard's distinct
   words are shuffled, once, never the words of its documents;
3. each shard's column numbers are replaced by global ones, which completes the
   matrix. A row's sum is the document's number of words, and
   the number of its nonzero entries that of its distinct words.

The other flags travel with the documents in their shards. Counts for each part and set of failed filters, at most 2^5 for each part, are all that the
report over the orders needs.
"""

from __future__ import annotations

from array import array
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyspark.sql.functions as F
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window

from .common import UPPER, col, written

#: Bytes of text after which a shard is closed. A longer text is a shard of its own.
SHARD_BYTES = 16 << 20
#: Words of shards that a task numbers before it passes their numbers on.
PACKED_ROWS = 1 << 20
#: Of the written shards, which are large tables of numbers.
CODEC = "zstd"
FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
#: What a document fails by: few words, few distinct ones, capitals, symbols.
MIN_WORDS, MIN_DISTINCT, MAX_CAPITALS, SYMBOLS = 50, 65, 5, b"#$%&*|"
#: Bytes that continue a character in UTF-8: a text has as many characters as other bytes.
CONTINUED = bytes(range(0x80, 0xC0))

def csr_shards(rows: DataFrame, measure=None, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Shards of the document-term matrix of ``place, doc, text`` with their own
    dictionaries: a name, the documents (``doc``, any struct), ``measure(text)`` of
    each (a small number; ``text`` as bytes), row ends, column numbers and counts as
    little-endian arrays, and the words by column. Null texts have no words.
    ``place`` tells rows apart."""
    kind = rows.schema["doc"].dataType.simpleString()

    def run(batches):
        held = {}

        def start():
            number = defaultdict()
            number.default_factory = number.__len__  # a word that is new gets the next number
            held.update(name=None, docs=[], marks=bytearray(), ends=array("q", [0]), columns=array("i"), counts=array("i"), words=number, size=0)

        def close():
            docs = pa.concat_arrays(held["docs"])
            binary = lambda x: pa.array([bytes(x)], pa.binary())
            out = pa.RecordBatch.from_arrays([
                pa.array([held["name"]], pa.int64()), pa.ListArray.from_arrays(pa.array([0, len(docs)], pa.int32()), docs),
                *(binary(held[c]) for c in ("marks", "ends", "columns", "counts")), pa.array([list(held["words"])], pa.list_(pa.binary()))],
                ["shard", "docs", "marks", "ends", "columns", "counts", "words"])
            start()
            return out

        start()
        for b in batches:
            first = 0  # of the batch's documents that this shard gets
            for i, text in enumerate(b.column(2)):
                text = text.as_py() or b""
                if held["name"] is not None and held["size"] + len(text) > shard_bytes:
                    if i > first:
                        held["docs"].append(b.column(1).slice(first, i - first))
                    yield close()
                    first = i
                if held["name"] is None:
                    held["name"] = b.column(0)[i].as_py()
                seen = Counter(text.split())  # bytes are split at blank, tab, newline, vertical tab, form feed, return
                held["columns"].extend(map(held["words"].__getitem__, seen))
                held["counts"].extend(seen.values())
                held["ends"].append(len(held["columns"]))
                held["marks"].append(measure(text) if measure else 0)
                held["size"] += len(text)
            if b.num_rows > first:
                held["docs"].append(b.column(1).slice(first))
        if held["name"] is not None:
            yield close()

    return rows.select("place", "doc", F.col("text").cast("binary").alias("text")).mapInArrow(
        run, f"shard long, docs array<{kind}>, marks binary, ends binary, columns binary, counts binary, words array<binary>")


def numbered_words(own: DataFrame) -> DataFrame:
    """Numbers for the words of the shards' dictionaries (``shard, column, word``).

    Equal words meet in one partition, sorted, where each distinct one gets the next
    place. Returns, for some columns of a shard at a time, ``part, shard, n, columns,
    places``: the partition, its number of distinct words so far, and the columns
    with their words' places. A word has at most one row per shard."""

    def run(batches):
        part, place, last, held = TaskContext.get().partitionId(), -1, None, []

        def packed():
            shard, column, places = (np.concatenate(x) for x in zip(*held))
            held.clear()
            order = np.argsort(shard, kind="stable")
            shard, column, places = shard[order], column[order], places[order]
            starts = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1]]))
            ends = [*starts[1:], len(shard)]
            cells = [pa.array([x[a:z].astype(k).tobytes() for a, z in zip(starts, ends)], pa.binary()) for x, k in ((column, "<i4"), (places, "<i8" if place >> 31 else "<i4"))]
            n = len(starts)
            return pa.RecordBatch.from_arrays([pa.array(np.full(n, part, "i4")), pa.array(shard[starts]), pa.array(np.full(n, place + 1)), *cells],
                                              ["part", "shard", "n", "columns", "places"])

        for b in batches:
            if not b.num_rows:
                continue
            words = b.column(2)
            new = np.ones(len(words), bool)
            new[1:] = pc.not_equal(words.slice(1), words.slice(0, len(words) - 1)).to_numpy(zero_copy_only=False)
            new[0] = last is None or words[0].as_py() != last
            places, last = place + np.cumsum(new), words[-1].as_py()
            place = int(places[-1])
            held.append((b.column(0).to_numpy(), b.column(1).to_numpy(), places))
            if sum(len(x) for _, _, x in held) > PACKED_ROWS:
                yield packed()
        if held:
            yield packed()

    dealt = own.select("shard", "column", "word").repartition("word").sortWithinPartitions("word")
    return dealt.mapInArrow(run, "part int, shard long, n long, columns binary, places binary")


def document_term_matrix(rows: DataFrame, measure=None, shard_bytes: int = SHARD_BYTES) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The matrix of ``place, doc, text`` in two tables that share the column
    ``shard``, and its dictionary, ``word, id``.

    A row of the first holds a shard's documents, row ends and counts (see
    ``csr_shards``), one of the second its entries' global word numbers, ``ids``
    (little-endian, 4 bytes each, or 8 where ``wide``). Both are written. Numbers run
    from 0 without gaps: a word's place within its partition, after the words of the
    partitions before.
    """
    shards = written(csr_shards(rows, measure, shard_bytes), "audit-shards", CODEC)
    numbered = written(numbered_words(shards.select("shard", F.posexplode("words").alias("column", "word"))), "audit-words", CODEC)
    sizes = {r["part"]: r["n"] for r in numbered.groupBy("part").agg(F.max("n").alias("n")).collect()}  # a row per partition
    first, n_words = {}, 0
    for part in sorted(sizes):
        first[part], n_words = n_words, n_words + sizes[part]
    wide = n_words >= 1 << 31

    def ids_of(found: pa.Table):
        """A shard's word numbers by column."""
        parts = [(np.frombuffer(c, "<i4"), np.frombuffer(p, f"<i{len(p) * 4 // len(c)}") + first[part])
                 for part, c, p in zip(*(found[x].to_pylist() for x in ("part", "columns", "places")))]
        ids = np.zeros(sum(len(c) for c, _ in parts), "<i8")
        for columns, numbers in parts:
            ids[columns] = numbers
        return ids

    def entries(shard: pa.Table, found: pa.Table) -> pa.Table:
        ids = ids_of(found)[np.frombuffer(shard["columns"][0].as_py(), "<i4")].astype("<i8" if wide else "<i4")
        return pa.table({"shard": shard["shard"], "ids": pa.array([ids.tobytes()], pa.binary()), "wide": pa.array([wide])})

    def dictionary(shard: pa.Table, found: pa.Table) -> pa.Table:
        return pa.table({"word": shard["words"].combine_chunks().flatten(), "id": pa.array(ids_of(found))})

    # a shard and what belongs to it: both are bounded by the shard's bytes
    found = numbered.select("shard", "part", "columns", "places").groupBy("shard")
    ids = shards.select("shard", "columns").groupBy("shard").cogroup(found).applyInArrow(entries, "shard long, ids binary, wide boolean")
    words = shards.select("shard", "words").groupBy("shard").cogroup(found).applyInArrow(dictionary, "word binary, id long").distinct()
    return shards.select("shard", "docs", "marks", "ends", "counts"), written(ids, "audit-matrix", CODEC), words


def word_totals(matrix: DataFrame) -> DataFrame:
    """``doc, mark, n_words, n_distinct``: row sums and nonzero counts, from the
    matrix' first table."""
    kind = matrix.schema["docs"].dataType.elementType.simpleString()

    def run(batches):
        for b in batches:
            for docs, marks, ends, counts in zip(*b.columns):
                ends = np.frombuffer(ends.as_py(), "<i8")
                running = np.concatenate([[0], np.cumsum(np.frombuffer(counts.as_py(), "<i4"), dtype="<i8")])
                yield pa.RecordBatch.from_arrays([docs.values, pa.array(np.frombuffer(marks.as_py(), "u1").astype("i4")),
                                                  pa.array(np.diff(running[ends])), pa.array(np.diff(ends))], ["doc", "mark", "n_words", "n_distinct"])

    return matrix.select("docs", "marks", "ends", "counts").mapInArrow(run, f"doc {kind}, mark int, n_words long, n_distinct long")


def _marks(text: bytes) -> int:
    """1 for capitals, 2 for symbols, or their sum."""
    points = len(text.translate(None, CONTINUED))
    capitals = len(text) - len(text.translate(None, UPPER.encode()))
    return (100 * capitals > MAX_CAPITALS * points) + 2 * (len(text) != len(text.translate(None, SYMBOLS)))


def failed_filters(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source",
                   shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """``doc_id, part, n_words, n_distinct, failed``, a row per input row.
    ``failed`` has a bit for each filter, A's the lowest.

    A null text is an empty one, and a null part the empty string. A document
    fails E if an equal text has a smaller id: of rows equal in id and text none
    is the smaller, and null ids are neither smaller nor larger than others.
    Further columns are not read. An empty table gives no rows.
    """
    text = F.coalesce(col(text_col), F.lit(""))
    doc = F.struct(col(id_col).alias("doc_id"), F.coalesce(col(part_col).cast("string"), F.lit("")).alias("part"),
                   F.unhex(F.sha2(text, 256)).alias("digest"))
    rows = docs.select(F.monotonically_increasing_id().alias("place"), doc.alias("doc"), text.alias("text"))
    matrix, _, _ = document_term_matrix(rows, _marks, shard_bytes)
    flags = written(word_totals(matrix).select("doc.*", "mark", "n_words", "n_distinct"), "audit-flags")
    first = flags.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).where("n > 1").select("digest", "first")
    fails = [F.col("n_words") < MIN_WORDS, 100 * F.col("n_distinct") < MIN_DISTINCT * F.col("n_words"),
             F.col("mark").bitwiseAND(1) > 0, F.col("mark").bitwiseAND(2) > 0, F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False))]
    return flags.join(first, "digest", "left").select(
        "doc_id", "part", "n_words", "n_distinct", sum((f.cast("int") * (1 << i) for i, f in enumerate(fails)), F.lit(0)).alias("failed"))


def _cells(flagged: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, n, good, toxic``: for each part, counts by set of failed filters."""
    rated = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    counted = flagged.select("doc_id", "part", "failed").join(rated, "doc_id", "left").groupBy("part", "failed").agg(
        F.count("*").alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic"))
    sets = range(1 << len(FILTERS))
    of = lambda name, s: F.sum(F.when(F.col("failed") == s, F.col(name)).otherwise(0))
    return counted.groupBy("part").agg(*[F.array(*[of(name, s) for s in sets]).alias(name) for name in ("n", "good", "toxic")])


def audit(flagged: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, filter_order, step, kept, removed, redundant, unique_fails,
    good_lost, toxic_lost, shapley``: a row for each part, order of the filters
    and step.

    ``flagged`` is what ``failed_filters`` returns. ``labels`` has ``doc_id,
    quality, toxic``; a document is good (toxic) if any row of its id says so.
    """
    cells = _cells(flagged, labels)
    orders = F.explode(F.array(*[F.lit(o) for o in ORDERS]))
    steps = cells.select("*", orders.alias("filter_order")).select(
        "*", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("step"))
    number = lambda i: F.instr(F.lit(FILTERS), F.substring("filter_order", i, F.lit(1))) - 1
    # the filters before this step as a set, and this step's own
    before = F.aggregate(F.sequence(F.lit(1), F.lit(len(FILTERS))), F.lit(0), lambda a, i: F.when(
        i < F.col("step"), a + F.pow(F.lit(2), number(i)).cast("int")).otherwise(a))
    steps = steps.select("*", before.alias("before"), F.pow(F.lit(2), number(F.col("step"))).cast("int").alias("own"))
    sets = F.sequence(F.lit(0), F.lit((1 << len(FILTERS)) - 1))

    def total(counts: str, where, weight=None) -> Column:
        value = lambda s: F.get(F.col(counts), s) if weight is None else F.get(F.col(counts), s) * weight(s)
        return F.aggregate(sets, F.lit(0).cast("long"), lambda a, s: F.when(where(s), a + value(s)).otherwise(a))

    holds, passed = (lambda s: s.bitwiseAND(F.col("own")) != 0), (lambda s: s.bitwiseAND(F.col("before")) == 0)
    removed = lambda s: holds(s) & passed(s)
    # of the orders, the filter comes first among the k that a document fails in one of k
    share = lambda s: (F.lit(len(ORDERS)) / F.bit_count(s)).cast("long")
    return steps.select(
        "part", "filter_order", "step",
        total("n", lambda s: ~holds(s) & passed(s)).alias("kept"), total("n", removed).alias("removed"),
        total("n", lambda s: holds(s) & ~passed(s)).alias("redundant"),
        total("n", lambda s: s == F.col("own")).alias("unique_fails"), total("good", removed).alias("good_lost"),
        total("toxic", removed).alias("toxic_lost"), total("n", holds, share).alias("shapley"))
