"""Benchmark decontamination by word windows (operator 5).

Benchmark items are cut into windows of ``WINDOW`` words (a shorter item is one
window). A filter over the windows' first words, of bounded size, is a literal
in the plan: for most document positions one hash and one or two lookups in it
are all. Positions that pass give their whole window as text, which a hash join
verifies against the benchmark's windows, numbered texts without their items: a
broadcast join up to ``BROADCAST_BYTES`` of them, a shuffled one beyond. Which
items a document holds follows from its distinct window numbers in a shuffled
join, so a window that many items share travels as one number until then.

All steps are DataFrame operations. Documents are scanned once; what is written
and shuffled are windows that passed the filter.
"""

from __future__ import annotations

import pyspark.sql.functions as F
from pyspark.sql import Column, DataFrame

from .common import ascii_lower, col, written

WINDOW = 10
#: Leading words of a window that the filter knows.
LEAD = 3
#: Greatest size of the filter in bytes (a larger benchmark lets more positions pass).
MAX_SLOTS = 1 << 20
#: Greatest size of the windows for a broadcast join.
BROADCAST_BYTES = 64 << 20
#: What separates words in lower-cased text: ASCII that is no digit or letter.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Words of a text after lower-casing A-Z; an empty array for null."""
    words = F.filter(F.split(ascii_lower(text), SEPARATORS), lambda w: w != "")
    return F.coalesce(words, F.array().cast("array<string>"))


def benchmark_windows(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text",
                      window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """Two written tables. ``win_id, win, n, lead``: distinct windows, numbered, as
    text, their lengths and the hash of their first words. ``win_id, item``: the
    ids (as strings) of the items that hold them. Items without words, or with a
    null id, have none."""
    items = benchmark.select(col(id_col).cast("string").alias("item"), words_of(col(text_col)).alias("words")).where(
        "item IS NOT NULL AND size(words) > 0")
    size = F.least(F.size("words"), F.lit(window))
    held = items.select("item", F.explode(F.transform(
        F.sequence(F.lit(0), F.size("words") - size), lambda i: F.slice("words", i + 1, size))).alias("w")).select(
        "item", F.array_join("w", " ").alias("win"), F.size("w").alias("n"),
        _lead("w", F.lit(0), F.least(F.size("w"), F.lit(LEAD))).alias("lead"))
    wins = written(held.select("win", "n", "lead").distinct().withColumn("win_id", F.monotonically_increasing_id()), "benchmark-windows")
    return wins, written(held.select("item", "win").distinct().join(wins, "win").select("win_id", "item"), "benchmark-items")


def _lead(words, i: Column, n: Column) -> Column:
    """Hash of the ``n`` <= LEAD words from ``i`` on."""
    return F.xxhash64(n, *[F.when(n > k, F.get(words, i + k)).otherwise("") for k in range(LEAD)])


def _slot(lead: Column, slots: int, probe: int) -> Column:
    """Place of a hash in the filter, from 1, for one of its two probes."""
    return (F.pmod(F.shiftright(lead, 31 * probe), F.lit(slots)) + 1).cast("int")


def _filter_bytes(leads: DataFrame, slots: int) -> bytes:
    """One byte for each slot: ``1`` where a probe of a ``lead`` hash falls."""
    found = leads.select(F.explode(F.array(*[_slot(F.col("lead"), slots, k) for k in (0, 1)])).alias("id")).distinct()
    cells = leads.sparkSession.range(1, slots + 1).join(found.withColumn("m", F.lit("1")), "id", "left").agg(
        F.array_sort(F.collect_list(F.struct("id", F.coalesce("m", F.lit("0")).alias("m")))).alias("cells"))
    return cells.select(F.array_join(F.transform("cells", lambda c: c["m"]), "")).first()[0].encode()


def find_windows(docs: DataFrame, wins: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Two tables. ``doc_id, doc_key, n_words``, a row per input row; and ``doc_id,
    doc_key, i, n, win_id``: every place (word ``i``, from 0) where a window of
    ``wins`` stands. ``doc_key`` is a hash of the text."""
    # as many rows as windows have lengths
    facts = wins.groupBy("n").agg(F.count("*").alias("k"), F.sum(F.octet_length("win") + 64).alias("bytes")).collect()
    total = sum(r["k"] for r in facts)
    slots = min(MAX_SLOTS, max(1 << 12, 1 << (32 * total).bit_length()))
    leads = sorted({min(r["n"], LEAD) for r in facts})
    seen = F.lit(_filter_bytes(wins.select("lead"), slots))

    rows = docs.select(col(id_col).alias("doc_id"), F.xxhash64(col(text_col)).alias("doc_key"), words_of(col(text_col)).alias("words"))

    def passing(n: int) -> Column:
        """Positions whose first ``n`` words the filter has seen."""
        def test(i):
            lead = _lead("words", i, F.lit(n))
            first, second = (F.substring(seen, _slot(lead, slots, k), F.lit(1)) == F.lit(b"1") for k in (0, 1))
            return first & second
        at = F.filter(F.sequence(F.lit(0), F.size("words") - n), test)
        return F.when(F.size("words") >= n, at).otherwise(F.array().cast("array<int>"))

    def spans(n: int) -> Column:
        """Windows of ``n`` words, as text, at the passing positions."""
        at = F.filter(F.col(f"pass{min(n, LEAD)}"), lambda i: i + n <= F.size("words"))
        return F.transform(at, lambda i: F.struct(i.alias("i"), F.lit(n).alias("n"), F.array_join(F.slice("words", i + 1, n), " ").alias("win")))

    passed = rows.select("*", *[passing(n).alias(f"pass{n}") for n in leads])
    none = F.array().cast("array<struct<i:int,n:int,win:string>>")
    found = F.concat(none, *[spans(r["n"]) for r in sorted(facts)])
    scanned = written(passed.select("doc_id", "doc_key", F.size("words").cast("long").alias("n_words"), found.alias("found")), "benchmark-scan")

    known = wins.select("win", "win_id")
    if sum(r["bytes"] for r in facts) <= BROADCAST_BYTES:
        known = F.broadcast(known)
    places = scanned.where(F.size("found") > 0).select("doc_id", "doc_key", F.explode("found").alias("f")).select(
        "doc_id", "doc_key", "f.*").join(known, "win").select("doc_id", "doc_key", "i", "n", "win_id")
    return scanned.drop("found"), places


def find_hits(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              window: int = WINDOW) -> DataFrame:
    """``doc_id, doc_key, n_words, hit_words, items``, a row per input row.

    ``hit_words`` holds the sorted numbers (from 0) of the words inside any
    occurrence of a benchmark window, ``items`` the sorted item ids with
    occurring windows; both are empty for clean documents. ``doc_key`` is a hash
    of the text: rows equal in id and text are one document and get one result.
    Null and empty texts have no words and no hits; an empty benchmark hits
    nothing. Other columns are not read.
    """
    wins, holders = benchmark_windows(benchmark, window=window)
    scanned, places = find_windows(docs, wins, id_col, text_col)
    one = ["doc_id", "doc_key"]
    places = written(places, "benchmark-places")
    words = places.groupBy(*one).agg(F.collect_set(F.struct("i", "n")).alias("places")).select(
        *one, F.array_sort(F.array_distinct(F.flatten(F.transform("places", lambda p: F.sequence(p["i"], p["i"] + p["n"] - 1))))).alias("hit_words"))
    items = places.select(*one, "win_id").distinct().join(holders, "win_id").groupBy(*one).agg(
        F.array_sort(F.collect_set("item")).alias("items"))

    def same(side: DataFrame, name: str) -> tuple[DataFrame, Column]:
        side = side.withColumnsRenamed({c: f"{name}_{c}" for c in one})
        return side, F.col("doc_id").eqNullSafe(F.col(f"{name}_doc_id")) & (F.col("doc_key") == F.col(f"{name}_doc_key"))

    return scanned.join(*same(words, "word"), "left").join(*same(items, "item"), "left").select(
        *one, "n_words", F.coalesce("hit_words", F.array().cast("array<int>")).alias("hit_words"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def report(docs: DataFrame, benchmark: DataFrame, **names) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated``."""
    n_hit = F.size("hit_words").cast("long")
    return find_hits(docs, benchmark, **names).select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def remove_documents(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     window: int = WINDOW) -> DataFrame:
    """The rows of ``docs``, all columns, that hold no benchmark window."""
    wins, _ = benchmark_windows(benchmark, window=window)
    _, places = find_windows(docs, wins, id_col, text_col)
    bad = places.select(F.col("doc_id").alias("bad id"), F.col("doc_key").alias("bad key")).distinct()
    rows = docs.select(F.struct(*[col(c) for c in docs.columns]).alias("doc"), F.xxhash64(col(text_col)).alias("key"), col(id_col).alias("id"))
    same = F.col("id").eqNullSafe(F.col("`bad id`")) & (F.col("key") == F.col("`bad key`"))
    return rows.join(bad, same, "left_anti").select("doc.*")
