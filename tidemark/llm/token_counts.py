"""Token counts without token ids (operator 4).

A piece vocabulary with byte fallback never joins certain neighbouring
characters. Cutting a text there gives pre-tokens whose piece counts add up to
the text's. So each distinct pre-token is counted once for the whole corpus,
and documents only join those counts to their own pre-token frequencies:

1. count every pre-token of the corpus, combined within each task before the
   shuffle, and count the pieces of each distinct one;
2. the most frequent short pre-tokens, a bounded number of bounded length
   (``HOT_ENTRIES``, ``HOT_LENGTH``) picked by a frequency threshold, go to every
   task. They cover most of the text;
3. a second pass sums a document's hot pre-tokens in place. Its other
   pre-tokens are joined by a shuffle, whatever their number and length.

The library reads the character U+2581 as a blank, and so does this module.
"""

from __future__ import annotations

import re
import string
from collections import Counter

import pyarrow as pa
import pyspark.sql.functions as F
from pyspark.sql import DataFrame, Window

from .common import col, worker_cache, written

#: Pre-tokens whose counts are sent to every task, and the characters that the
#: longest of them may have: with about 100 bytes for each entry, 80 MB at most.
HOT_ENTRIES, HOT_LENGTH = 400_000, 24
#: Distinct pre-tokens, and characters of text, that a task counts before it
#: passes its counts on. What it holds is never more than those characters.
FLUSH_ENTRIES, FLUSH_CHARACTERS = 600_000, 128 << 20
#: The library's own sign for a blank, which texts may hold too.
BLANK_SIGN = "\u2581"


def _library(path: str):
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=path)


def boundary_pattern(path: str) -> str:
    """An expression for pre-tokens, derived from the vocabulary.

    A pre-token starts at a run of blanks, at a newline, or where a letter or
    digit meets a punctuation mark that no piece has next to a letter or digit.
    Raises if the model changes texts, or has pieces across those places.
    """
    model = _library(path)
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())
              if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
    chars = set("".join(pieces))
    probe = " AÄﬁ  ①x "
    if model.encode(probe, out_type=str) and model.decode(model.encode(probe)) != probe:
        raise ValueError("the model normalises texts; pre-tokens can't be counted apart")
    if any(re.search("[^▁]▁|\n| ", p) for p in pieces):
        raise ValueError("the vocabulary has pieces across blanks or newlines")
    odd = {c for c in chars if c.isalnum() and not c.isalpha() and c not in string.digits}
    plain = {c for c in chars if c.isalnum()} - odd
    marks = {c for c in chars | set(string.punctuation) if not c.isalnum() and c not in "▁_"}
    for p in pieces:
        for a, b in zip(p, p[1:]):
            marks -= {b} if a in plain else set()
            marks -= {a} if b in plain else set()
    letter = "[^\\W_" + re.escape("".join(sorted(odd))) + "]"
    if not marks:
        return "\n| *[^ \n]+| +"
    mark = "[" + re.escape("".join(sorted(marks))) + "]"
    return f"\n| *{letter}+(?={mark}|[ \n]|$)| *{mark}+(?={letter}|[ \n]|$)| *[^ \n]+| +"


def opened(text: str) -> str:
    """A text as the library sees it: a blank before it, and its sign for a
    blank read as one."""
    return " " + text.replace(BLANK_SIGN, " ")


def count_pieces(model, pretoken: str) -> int:
    """Pieces of one pre-token inside a text. The library puts a blank before
    what it encodes; a newline shields the pre-tokens that have none."""
    if pretoken[0] == " " and pretoken.strip(" "):
        return len(model.encode(pretoken[1:]))
    return len(model.encode("\n" + pretoken)) - 2


def pretoken_frequencies(docs: DataFrame, pattern: str, text_col: str = "text") -> DataFrame:
    """``pretoken, n`` over the whole corpus."""

    def run(batches):
        found = re.compile(pattern).findall
        held: Counter[str] = Counter()
        seen = 0
        for b in batches:
            for t in b.column(0):
                if text := t.as_py():
                    held.update(found(opened(text)))
                    seen += len(text)
                    if len(held) > FLUSH_ENTRIES or seen > FLUSH_CHARACTERS:
                        yield from flush(held)
                        seen = 0
        yield from flush(held)

    def flush(held):
        keys, values = list(held), list(held.values())
        held.clear()
        for at in range(0, len(keys), 20_000):
            yield pa.RecordBatch.from_arrays([pa.array(keys[at:at + 20_000], pa.string()),
                                              pa.array(values[at:at + 20_000], pa.int64())], ["pretoken", "n"])

    parts = docs.select(col(text_col).alias("text")).mapInArrow(run, "pretoken string, n long")
    return parts.groupBy("pretoken").agg(F.sum("n").alias("n"))


def with_pieces(frequencies: DataFrame, model_path: str) -> DataFrame:
    """Adds ``pieces`` to ``pretoken, n``: each distinct pre-token, once."""

    def run(batches):
        model = worker_cache(("pieces", model_path), lambda: _library(model_path))
        for b in batches:
            pieces = [count_pieces(model, t) for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(pieces, pa.int32())], ["pretoken", "n", "pieces"])

    return frequencies.mapInArrow(run, "pretoken string, n long, pieces int")


def _hot(counted: DataFrame, entries: int):
    """The short pre-tokens from the lowest frequency step on at which at most
    ``entries`` of them remain, as a dictionary, and that frequency."""
    step = F.floor(F.log2("n") * 8).cast("int")
    counted = counted.where(F.length("pretoken") <= HOT_LENGTH)
    steps = counted.groupBy(step.alias("step")).agg(F.count("*").alias("k"), F.min("n").alias("low"))
    down = steps.withColumn("upto", F.sum("k").over(Window.orderBy(F.desc("step"))))
    low = down.where(F.col("upto") <= entries).agg(F.min("low")).first()[0]
    if low is None:
        return {}, 1 << 62
    rows = counted.where(F.col("n") >= low).select("pretoken", "pieces").toArrow()
    return dict(zip(rows.column(0).to_pylist(), rows.column(1).to_pylist())), low


def count_tokens(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text",
                 hot_entries: int = HOT_ENTRIES) -> DataFrame:
    """``doc_id, n_bytes, n_tokens`` with one row per input row.

    A null or empty text has no bytes and no tokens. Repeated rows and null ids
    are counted each on its own, since rows are told apart by their place and
    not by their id. Further columns of ``docs`` are not read.
    """
    spark = docs.sparkSession
    pattern = boundary_pattern(model_path)
    counted = written(with_pieces(pretoken_frequencies(docs, pattern, text_col), model_path), "pretokens")
    hot, low = _hot(counted, hot_entries)
    shared = spark.sparkContext.broadcast(hot)

    def run(batches):
        found, get = re.compile(pattern).findall, shared.value.get
        for b in batches:
            kinds = [*(c.type for c in b.columns[:3]), pa.string(), pa.int64()]
            lines = []

            def out():
                columns = zip(*lines) if lines else [()] * len(kinds)
                return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

            for row, doc, size, text in zip(*(c.to_pylist() for c in b.columns[:3]), b.column(3)):
                total, rare = 0, []
                for p in found(opened(t)) if (t := text.as_py()) else ():
                    if (k := get(p)) is not None:
                        total += k
                    else:
                        rare.append(p)
                lines.append((row, doc, size, None, total))
                lines += [(row, None, None, p, n) for p, n in Counter(rare).items()]
                if len(lines) > 50_000:
                    yield out()
                    lines = []
            yield out()

    names = ["row", "doc_id", "n_bytes", "pretoken", "tokens"]
    placed = docs.select(F.monotonically_increasing_id().alias("row"), col(id_col).alias("doc_id"),
                         F.coalesce(F.octet_length(col(text_col)), F.lit(0)).cast("long").alias("n_bytes"),
                         col(text_col).alias("text"))
    kind = placed.schema["doc_id"].dataType.simpleString()
    parts = written(placed.mapInArrow(
        run, f"row long, doc_id {kind}, n_bytes long, pretoken string, tokens long"), "token-parts")
    rare = parts.where("pretoken IS NOT NULL").join(
        counted.where((F.col("n") < low) | (F.length("pretoken") > HOT_LENGTH)).select("pretoken", "pieces"), "pretoken").select(
        "row", "doc_id", "n_bytes", (F.col("tokens") * F.col("pieces")).alias("tokens"))
    known = parts.where("pretoken IS NULL").select("row", "doc_id", "n_bytes", "tokens")
    return known.unionByName(rare).groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), F.max("n_bytes").alias("n_bytes"),
        F.sum("tokens").alias("n_tokens")).drop("row")
