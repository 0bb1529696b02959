"""A cleaning pipeline over the documents table.

Each stage takes what the one before kept and writes; its decisions take
effect. ``run`` applies all of them, cutting lineage after each by a table in
the cluster's shared folder.
"""

from __future__ import annotations

import public_tokenizers
import pyspark.sql.functions as F
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import bpe, decontaminate, language, line_dedup, simhash
from tidemark.llm.common import read_table, written

#: Column order of the documents table, which all stages but the last keep.
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the model knows; null texts, texts without a
    letter and texts none of whose words the model knows, not even by a character,
    go. (A low score is no reason: documents of mixed languages, or full of codes,
    score low too.) Columns are unchanged."""
    model = language.fit(language.training_rows(docs))
    judged = language.predict(docs, model, COLUMNS)
    return judged.where((F.col("lang_pred") != language.UNKNOWN) & (F.col("n_known") > 0)).select(*COLUMNS)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines of repeated windows; ``n_chars`` follows the text."""
    done = line_dedup.dedup_lines(docs)
    return done.select("doc.doc_id", F.col("kept_text").alias("text"), "doc.lang", "doc.source",
                       F.when(F.col("n_removed") > 0, F.length("kept_text")).otherwise(F.col("doc.n_chars")).cast("long").alias("n_chars"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group, the one with the smallest id."""
    return simhash.keep_one(docs).select(*COLUMNS)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    return decontaminate.remove_documents(docs, read_table(spark, sf_dir, "benchmark"))


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of what is left, as digests: ``doc_id, n_tokens, ids_sha256,
    decoded_sha256``."""
    return bpe.digests(bpe.round_trip(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN))


STAGES = [
    ("language_id", language_stage),
    ("line_dedup", line_stage),
    ("simhash_near_dedup", near_duplicate_stage),
    ("benchmark_decontamination", benchmark_stage),
    ("byte_bpe", token_stage),
]

#: SQL can't express the fitted language model; tests hold the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
