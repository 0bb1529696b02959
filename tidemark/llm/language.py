"""Language identification by word-first backoff (operator 7).

A word that training knows scores each language by its log frequency there. An
unknown word is scored by the longest character n-grams of it that training
knows, from five characters down to one. Scores add up over all words of the
whole text.

The model is fitted on a bounded sample: labelled documents pass a hash
threshold so that about ``SAMPLE_DOCS`` of each language remain, and tables keep
the ``TOP_WORDS`` and ``TOP_GRAMS`` most frequent entries of each language and
length. Every label is a language. The broadcast model holds an entry's counts
in the languages that have it and a floor for the others, so it is bounded by the
number of languages, not by its square, whatever the corpus. Prediction shuffles
nothing.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyspark.sql.functions as F
from pyspark.sql import DataFrame, Window

from .common import col

#: Labelled documents of a language that a model is fitted on, about.
SAMPLE_DOCS = 4_000
#: Words, and character n-grams of each length, kept for each language.
TOP_WORDS, TOP_GRAMS = 20_000, 8_000
LONGEST = 5
UNKNOWN = "und"
#: Unknown words that a task remembers before it starts anew, about 300 bytes each.
MEMO_ENTRIES = 60_000
#: Entries of a text that are looked up at once.
ENTRIES_AT_ONCE = 4_096
_WORD = r"[^\W\d_]+"


def held_out(id_col: str = "doc_id"):
    """True for the quarter of documents that no model learns from; false for
    null ids, which are not learned from either."""
    return F.coalesce(F.crc32(col(id_col).cast("string")) % 4 == 2, F.lit(False))


def _grams(word: str, n: int) -> list[str]:
    marked = f"^{word}$" if n > 1 else word
    return [marked[i:i + n] for i in range(len(marked) - n + 1)]


@dataclass
class Model:
    """Log frequencies, smoothed by half a count for each entry of any language:
    ``rows[n]`` maps an entry (n = 0: a word, else an n-gram) to its row. The
    cells ``start[row]`` to ``start[row + 1]`` name the languages that have it
    (``language``) and what they have above their ``floor[n]`` (``gain``)."""

    languages: list[str]
    prior: np.ndarray
    rows: list[dict[str, int]]
    floor: np.ndarray
    start: np.ndarray
    language: np.ndarray
    gain: np.ndarray


def label_counts(labelled: DataFrame) -> pa.Table:
    """``lang, k`` of all labels: a row for each language of the model."""
    return labelled.groupBy("lang").agg(F.count("*").alias("k")).toArrow()


def sample_of(labelled: DataFrame, counts: pa.Table, docs_per_language: int = SAMPLE_DOCS) -> DataFrame:
    """About ``docs_per_language`` rows of each ``lang`` of ``id, text, lang``,
    by a hash of the id. Texts stay where they are read: the shares, a row for
    each label, go to them."""
    share = labelled.sparkSession.createDataFrame(counts).select("lang", (docs_per_language / F.col("k")).alias("share"))
    place = F.pmod(F.xxhash64("id"), F.lit(1 << 30)) / float(1 << 30)
    return labelled.join(F.broadcast(share), "lang").where(place < F.col("share")).select("text", "lang")


def fit(labelled: DataFrame, docs_per_language: int = SAMPLE_DOCS, top_words: int = TOP_WORDS,
        top_grams: int = TOP_GRAMS, longest: int = LONGEST) -> Model:
    """Fit on ``id, text, lang``; rows with a null or empty text or a null lang
    teach nothing. An empty table gives a model without languages."""
    labelled = labelled.where("text <> '' AND lang IS NOT NULL")
    whole = label_counts(labelled)
    rows = sample_of(labelled, whole, docs_per_language)

    def run(batches):
        words = re.compile(_WORD).findall
        for b in batches:
            by_lang: dict[str, Counter[str]] = {}
            for text, lang in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                by_lang.setdefault(lang, Counter()).update(words(text.lower()))
            for lang, count in by_lang.items():
                sums = [(0, w, k) for w, k in count.items()]
                for n in range(1, longest + 1):
                    of: Counter[str] = Counter()
                    for w, k in count.items():
                        for g in _grams(w, n):
                            of[g] += k
                    sums += [(n, g, k) for g, k in of.items()]
                if not sums:
                    continue
                size, entry, k = zip(*sums)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(sums), pa.string()), pa.array(size, pa.int32()),
                     pa.array(entry, pa.string()), pa.array(k, pa.int64())], ["lang", "n", "entry", "k"])

    counts = rows.mapInArrow(run, "lang string, n int, entry string, k long").groupBy("lang", "n", "entry").agg(
        F.sum("k").alias("k"))
    # the whole counts of the sample are a bounded table, and so is each window
    best = Window.partitionBy("lang", "n").orderBy(F.desc("k"), "entry")
    total = F.sum("k").over(Window.partitionBy("lang", "n"))
    kept = counts.withColumn("total", total).withColumn("rank", F.row_number().over(best)).where(
        F.col("rank") <= F.when(F.col("n") == 0, top_words).otherwise(top_grams)).drop("rank").toArrow()
    languages = sorted(kept["lang"].unique().to_pylist())
    at = {lang: i for i, lang in enumerate(languages)}
    tables: list[dict[str, int]] = [{} for _ in range(longest + 1)]
    totals = np.zeros((longest + 1, len(languages)))
    row, language, size = np.empty(len(kept), np.int64), np.empty(len(kept), np.int32), 0
    done = 0
    for b in kept.to_batches(100_000):
        for lang, n, entry, total in zip(*(b[c].to_pylist() for c in ("lang", "n", "entry", "total"))):
            r = tables[n].setdefault(entry, size)
            size += r == size
            row[done], language[done] = r, at[lang]
            totals[n, at[lang]] = total
            done += 1
    # half a count for each entry that any language has, so that a language of a few words is no likelier
    # to have said a word it doesn't know
    types = np.array([len(t) for t in tables])[:, None]
    floor = np.log(0.5 / (totals + 0.5 * np.maximum(types, 1)))
    order = np.argsort(row, kind="stable")
    start = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=size))])
    docs = dict(zip(whole["lang"].to_pylist(), whole["k"].to_pylist()))
    prior = np.array([docs[lang] for lang in languages], float)
    return Model(languages, np.log(prior / prior.sum()) if languages else prior, tables, floor, start, language[order],
                 np.log(2 * kept["k"].to_numpy() + 1.0)[order])


def predict(docs: DataFrame, model: Model, keep: list[str], text_col: str = "text") -> DataFrame:
    """The columns ``keep`` with ``lang_pred``, ``score`` and ``n_known``, one row per input row.

    A text that is null or has no letter, and any text under a model without
    languages, is ``und`` with score 0. Equal scores go to the language that
    sorts first. ``score`` is the winner's share of the geometric means of the
    word likelihoods, between 0 and 1. ``n_known`` counts the words that the model knows
    or knows n-grams of; without any, only the prior speaks for ``lang_pred``. Rows are judged each on its own, so
    repeated rows get equal results; other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(
        (model.languages, model.prior, model.rows, model.floor, model.start, model.language, model.gain))

    def run(batches):
        languages, prior, rows, floor, start, language, gain = shared.value
        known, words, memo = rows[0].get if rows else None, re.compile(_WORD).findall, {}

        def unknown(word):
            for n in range(len(rows) - 1, 0, -1):
                hit = [r for g in _grams(word, n) if (r := rows[n].get(g)) is not None]
                if hit:
                    return n, tuple(hit)
            return 0, ()

        def judge(text):
            found = words(text.lower()) if text and languages else []
            if not any(c.isalpha() for w in found for c in w):
                return UNKNOWN, 0.0, 0
            sure, rest, sizes, seen = [], [], [], [0] * len(rows)
            for w in found:
                if (r := known(w)) is not None:
                    sure.append(r)
                else:
                    if w not in memo:
                        if len(memo) >= MEMO_ENTRIES:
                            memo.clear()
                        memo[w] = unknown(w)
                    n, hit = memo[w]
                    if hit:
                        rest += hit
                        sizes.append(len(hit))
                        seen[n] += 1
            seen[0] = len(sure)
            entries = np.array(sure + rest, np.int64)
            sizes = np.array(sizes, np.int64)
            weight = np.concatenate([np.ones(len(sure)), np.repeat(1 / sizes, sizes)])
            total = prior + np.array(seen) @ floor
            for i in range(0, len(entries), ENTRIES_AT_ONCE):
                some = entries[i:i + ENTRIES_AT_ONCE]
                first, k = start[some], start[some + 1] - start[some]
                cells = np.repeat(first - np.cumsum(k) + k, k) + np.arange(k.sum())
                total += np.bincount(language[cells], gain[cells] * np.repeat(weight[i:i + ENTRIES_AT_ONCE], k), len(languages))
            mean = total / max(1, sum(seen))
            best = int(np.argmax(total))
            return languages[best], float(1 / np.exp(mean - mean[best]).sum()), sum(seen)

        for whole in batches:
            for i in range(0, whole.num_rows, 256):
                b = whole.slice(i, 256)
                pred, score, n_known = zip(*map(judge, b.column(at).to_pylist()))
                yield pa.RecordBatch.from_arrays([*b.columns[:len(keep)], pa.array(pred, pa.string()),
                                                  pa.array(score, pa.float64()), pa.array(n_known, pa.int64())],
                                                 [*keep, "lang_pred", "score", "n_known"])

    at = keep.index(text_col) if text_col in keep else len(keep)
    frame = docs.select(*[col(c) for c in keep], *([] if text_col in keep else [col(text_col).alias("text to judge")]))
    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in frame.schema[:len(keep)])
    return frame.mapInArrow(run, f"{kinds}lang_pred string, score double, n_known long")


def training_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``id, text, lang`` of what may be learned from."""
    return docs.where(col(id_col).isNotNull() & ~held_out(id_col)).select(
        col(id_col).alias("id"), col(text_col).alias("text"), col(lang_col).alias("lang"))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of all documents under a model
    fitted on those that are not held out."""
    model = fit(training_rows(docs, id_col, text_col, lang_col))
    frame = docs.select(col(id_col).alias("doc_id"), held_out(id_col).alias("held_out"), col(text_col).alias("text"))
    return predict(frame, model, ["doc_id", "held_out"]).drop("n_known")
