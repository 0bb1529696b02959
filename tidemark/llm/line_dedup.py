"""Line dedup over overlapping three-line windows (operator 10).

Three consecutive lines with text (blanks around them do not count, blank lines
are passed over) make a window. A window seen twice or more in the corpus stays
where it comes first, by document id and line. Every line that a later
occurrence covers is removed; overlapping occurrences merge. Blank lines stay.

All steps are DataFrame operations. Windows are written once, without text.
Counting combines hashes before the shuffle, so a window that a third of all
documents share reaches the reducer as one row per task, and the join that finds
the later occurrences has only repeated windows on its small side.
"""

from __future__ import annotations

import pyspark.sql.functions as F
from pyspark.sql import Column, DataFrame

from .common import col, written

LINES = 3
#: White space around a line; a line of nothing else is blank.
BLANKS = " \t\x0b\x0c\r"


def _document_key(text: Column) -> Column:
    return F.xxhash64(text)


def line_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, doc_key, lines, h1, h2``: every window with the numbers of its
    lines and a 128-bit hash of their text."""
    filled = F.filter(
        F.transform(F.split(F.col("t"), "\n"), lambda line, i: F.struct(i.alias("i"), F.btrim(line, F.lit(BLANKS)).alias("s"))),
        lambda x: x["s"] != "")

    def window(j):
        part = [F.get("filled", j + k) for k in range(LINES)]
        words = [p["s"] for p in part]
        return F.struct(F.array(*[p["i"] for p in part]).alias("lines"), F.xxhash64(*words).alias("h1"),
                        F.xxhash64(F.lit(LINES), *reversed(words)).alias("h2"))

    rows = docs.select(col(id_col).alias("doc_id"), col(text_col).alias("t")).where("t IS NOT NULL").select(
        "doc_id", _document_key(F.col("t")).alias("doc_key"), filled.alias("filled"))
    return rows.where(F.size("filled") >= LINES).select(
        "doc_id", "doc_key", F.explode(F.transform(F.sequence(F.lit(0), F.size("filled") - LINES), window)).alias("w")
    ).select("doc_id", "doc_key", "w.lines", "w.h1", "w.h2")


def repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, doc_key, removed``: the sorted numbers of lines to remove, for
    documents that have any."""
    windows = written(line_windows(docs, id_col, text_col), "line-windows")
    place = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "doc_key", F.get("lines", F.lit(0)).alias("line"))
    first = windows.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min(place).alias("first")).where("n > 1").drop("n")
    later = windows.join(first, ["h1", "h2"]).where(place > F.col("first"))
    return later.groupBy("doc_id", "doc_key").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("lines")))).alias("removed"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All rows and columns of ``docs`` with lines removed from the text, as a
    struct ``doc`` with the old columns, and ``kept_text, n_lines, n_removed``.

    A null text stays null, with no lines; an empty one has one (blank) line. A
    document all of whose lines go keeps its row and blank lines. Null ids come
    after all others; rows with one id are ordered by a hash of their text. Rows
    equal in id and text count as one document and get the same result. The
    struct keeps columns of any name apart from the new ones.
    """
    removed = repeated_lines(docs, id_col, text_col).select(
        F.col("doc_id").alias("r_id"), F.col("doc_key").alias("r_key"), "removed")
    rows = docs.select(F.struct(*[col(c) for c in docs.columns]).alias("doc"), col(id_col).alias("id"), col(text_col).alias("t"),
                       _document_key(col(text_col)).alias("key"))
    joined = rows.join(removed, F.col("id").eqNullSafe(F.col("r_id")) & (F.col("key") == F.col("r_key")), "left")
    lines = joined.select("doc", "t", "removed", F.split("t", "\n").alias("lines"))
    numbers = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("removed"))
    kept = F.array_join(F.transform(numbers, lambda i: F.get("lines", i)), "\n")
    return lines.select(
        "doc", F.when(F.col("removed").isNull(), F.col("t")).otherwise(kept).alias("kept_text"),
        F.when(F.col("t").isNull(), 0).otherwise(F.size("lines")).cast("long").alias("n_lines"),
        F.coalesce(F.size("removed"), F.lit(0)).cast("long").alias("n_removed"))
