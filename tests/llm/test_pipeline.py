import hashlib

import corpus_pipeline
import numpy as np
import public_tokenizers
import tiktoken

import __spark_entry__

from tidemark.llm import bpe, language, line_dedup, simhash

from .conftest import passage
from .test_decontaminate import brute as benchmark_hits
from .test_line_dedup import brute as lines_left
from .test_simhash import groups, reference

SF = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    frames = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        assert k == len(corpus_pipeline.STAGES) - 1 or out.columns == columns
        out.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        frames.append({r.doc_id: r for r in docs.collect()})
    source = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    first, lines, near, clean, tokens = frames
    assert first == {i: r for i, r in source.items() if any(c.isalpha() for c in r.text or "")}
    cut = lines_left(sorted((i, r.text) for i, r in first.items()))
    assert {i: r.text for i, r in lines.items()} == {i: t for i, (_, _, t) in cut.items()}
    assert all(r.n_chars == len(r.text) for i, r in lines.items() if cut[i][1])
    fp = {i: reference(r.text) for i, r in lines.items()}
    root = groups(set(fp.values()), lambda a, b: (a ^ b).bit_count() <= 2)
    smallest = {}
    for i in sorted(lines):
        smallest.setdefault(root[fp[i]], i)
    assert near == {i: lines[i] for i in smallest.values()}
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    hits = {i for i, _, hit, _ in benchmark_hits([(i, r.text) for i, r in near.items()], items) if hit}
    assert hits and clean == {i: r for i, r in near.items() if i not in hits}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={}, mergeable_ranks=bpe.load_ranks(
        public_tokenizers.path("byte_bpe_multi_50k.tiktoken")))
    for i, r in clean.items():
        ids = np.array(library.encode_ordinary(r.text), "<u4")
        want = (len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(r.text.encode()).hexdigest())
        assert tuple(tokens[i])[1:] == want
    assert set(tokens) == set(clean)
    assert __spark_entry__.queries()["pipeline"](spark, SF).count() == len(tokens)


def test_nulls_ties_and_empty_tables(spark):
    kind = "doc_id long, text string, lang string, source string, n_chars long"
    text = passage(1, 80)
    rows = [(None, None, None, None, None), (1, None, "en", None, None), (2, "", "en", "s", 0), (3, text, "en", "s", None),
            (3, text, "en", "s", None), (3, text, "en", "t", None), (None, text, None, None, 1), (None, passage(2, 50), "en", None, 1)]
    for docs in (spark.createDataFrame(rows, kind), spark.createDataFrame([], kind)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, SF)
            assert docs.columns == corpus_pipeline.COLUMNS
        left = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert left == []
    docs = spark.createDataFrame(rows, kind)
    assert language.predict(docs, language.fit(language.training_rows(docs)), ["doc_id"]).count() == len(rows)
    assert line_dedup.dedup_lines(docs).count() == len(rows)
    kept = sorted((r.doc_id is None, r.doc_id or 0, r.source or "") for r in simhash.keep_one(docs).collect())
    assert kept == [(False, 1, ""), (False, 3, "s"), (True, 0, "")]
