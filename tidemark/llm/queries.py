"""The registered queries of this package; one per operator, over whole tables."""

from __future__ import annotations

import pyspark.sql.functions as F
from pyspark.sql import DataFrame, SparkSession

from . import (bpe, decontaminate, filter_audit, language, lexical_search, licenses, line_dedup, mixing, quality, sharding, simhash,
               substring_dedup, token_counts)
from .common import read_table


def _tokenizer(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without bytes inside 100-byte strings that start earlier too."""
    done = substring_dedup.remove_repeats(read_table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"])
    return done.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                       F.sha2("kept", 256).alias("kept_sha256"))


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document under the multilingual 50k vocabulary, and the
    bytes they decode to, as digests."""
    import public_tokenizers
    return bpe.digests(bpe.round_trip(
        read_table(spark, sf_dir, "documents"), _tokenizer("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN))


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts of every document and the verdict of the certified rules."""
    return quality.judge(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of documents by SimHash."""
    groups = simhash.group_documents(read_table(spark, sf_dir, "documents"))
    return groups.select("doc_id", simhash.hex_digits().alias("fingerprint"), "component_id")


SHARDS = 8


def op3_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A uniform shuffle of all documents into shards of equal row counts."""
    placed = sharding.shuffle_into_shards(read_table(spark, sf_dir, "documents"), SHARDS)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


#: Documents with more tokens are over the limit.
TOKEN_LIMIT = 4096


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document under the 32k piece vocabulary."""
    counts = token_counts.count_tokens(read_table(spark, sf_dir, "documents"), _tokenizer("piece_bpe_32k.model"))
    return counts.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document inside windows of the benchmark."""
    return decontaminate.report(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


#: Phrases that are always looked for, with their labels.
BASE_PHRASES = [("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc")]


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licenses that documents name, by all signature rules."""
    return licenses.label_documents(licenses.scan_licenses(read_table(spark, sf_dir, "documents"), BASE_PHRASES))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from three quarters of them."""
    return language.identify(read_table(spark, sf_dir, "documents"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without lines of repeated windows."""
    done = line_dedup.dedup_lines(read_table(spark, sf_dir, "documents"))
    return done.select("doc.doc_id", "n_lines", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


#: Documents that each benchmark item gets.
BEST = 20


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that share most with each benchmark item."""
    found = lexical_search.ranked_search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), BEST)
    return found.select("item.item_id", "rank", "doc_id", "score")


def op12_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often a mix of one and a half times the words takes each document."""
    mixed = mixing.mix_sources(read_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", "rate", "copies")


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every order of five filters removes, for each source."""
    return filter_audit.audit(filter_audit.failed_filters(read_table(spark, sf_dir, "documents")), read_table(spark, sf_dir, "labels"))


QUERIES = {
    "op1_quality_rules": op1_quality_rules,
    "op2_simhash": op2_simhash,
    "op3_shards": op3_shards,
    "op4_token_counts": op4_token_counts,
    "op5_decontaminate": op5_decontaminate,
    "op6_license_scan": op6_license_scan,
    "op7_language_id": op7_language_id,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_byte_bpe": op9_byte_bpe,
    "op10_line_dedup": op10_line_dedup,
    "op11_lexical_search": op11_lexical_search,
    "op12_mixing": op12_mixing,
    "op13_filter_audit": op13_filter_audit,
}
