import math
import random
import re
from collections import Counter

import numpy as np
import pyspark.sql.functions as F
import pytest

from tidemark.llm import lexical_search as ls

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def lowered(text):
    return re.findall(TERM, "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k=20):
    """``docs``: (id, text); a list of (item, rank, id, score)."""
    texts = [(i, lowered(t)) for i, t in docs]
    texts = [(i, w) for i, w in texts if w]
    n_docs, n_terms = len(texts), sum(len(w) for _, w in texts)
    df = Counter(t for _, w in texts for t in set(w))
    out = []
    for item, text in items:
        q = Counter(lowered(text))
        scored = []
        for i, w in texts:
            tf, m = Counter(w), 100 - 25 + 25 * len(w) * n_docs // n_terms
            s = sum(n * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1000000000 * tf[t] // (1000 * tf[t] + 12 * m)) for t, n in q.items())
            if s > 0:
                scored.append((-s, i is None, i or 0))
        out += [(item, r, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(scored)[:k], 1)]
    return out


@pytest.fixture(scope="module")
def corpus(spark):
    r = random.Random(4)
    words = [f"w{i}" for i in range(400)] + ["Ähre", "ähre", "x2"]
    text = lambda n: " ".join(r.choice(words[:1 + int(400 * r.random() ** 2)] + words[-3:]) for _ in range(n))
    docs = [(i, text(r.randint(0, 60))) for i in range(500)]
    docs += [(500 + i, "Same text, again: w3 w399.") for i in range(60)] + [(None, "w3 w399 w399"), (7, "w398 again"), (7, "w398 again"), (990, None), (991, text(20_000))]
    items = [(i, text(r.randint(1, 30)) if i % 4 else docs[i][1]) for i in range(37)] + [(3, "W3 w3, again-same"), (40, ""), (None, "w399"), (41, None), (42, "unseen")]
    return docs, items, spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")


@pytest.mark.parametrize("blocks, share", [(128 << 10, 64), (300, 3)])
def test_search_is_exact(corpus, monkeypatch, blocks, share):
    docs, items, df, idf = corpus
    monkeypatch.setattr(ls, "TREE_DOCUMENTS", 200)
    got = ls.ranked_search(df.repartition(3).withColumn("n", F.lit("x")).withColumn("score", F.lit(1)).withColumn("item", F.lit(2)),
                           idf.withColumn("rank", F.lit(1)).withColumn("number", F.lit(1)), block_bytes=blocks, probe_share=share)
    have = [(r["item"].item_id, r["rank"], r.doc_id, r.score) for r in got.collect()]
    assert sorted(have, key=repr) == sorted(brute(docs, items), key=repr)


def test_batches_are_pruned():
    """Whole leaves are left out where bounds can't reach the floors, and no result changes."""
    r = random.Random(1)
    topics = [[f"t{k}w{i}" for i in range(30)] for k in range(20)]
    docs = [(i, " ".join(r.choice(topics[i % 20]) for _ in range(40))) for i in range(2000)]
    items = [(i, " ".join(r.choice(topics[i % 5]) for _ in range(8))) for i in range(40)]
    block = ls.Block([(i, t.encode()) for i, t in items])
    counted = [Counter(block.vocabulary[w] for w in ls.terms(t.encode()) if w in block.vocabulary) for _, t in docs]
    ends = np.concatenate([[0], np.cumsum([len(c) for c in counted])]).astype("i8")
    ids, tf = (np.array([x for c in counted for x in f(c)], "i8") for f in (dict.keys, dict.values))
    weights = np.full(len(block.vocabulary), 1000)
    best = ls.Best(5, [0] * 40)
    scored = ls.search_tree(ls.ItemTree(block.items, weights), best, [i for i, _ in docs], ends, ids, 1_000_000 * tf // (tf + 1))
    assert scored < 0.25 * len(docs) * len(items)
    for i, (t, n) in enumerate(block.items):
        all_ = [(-sum(1000 * q * (1_000_000 * c[x] // (c[x] + 1)) for x, q in zip(t.tolist(), n.tolist()) if x in c), False, d) for (d, _), c in zip(docs, counted)]
        assert best.rows[i] == sorted(x for x in all_ if x[0] < 0)[:5]


def test_empty_tables(spark, odd, empty, texts):
    none = spark.createDataFrame([], "item_id long, text string")
    assert ls.ranked_search(odd, none).count() == 0
    items = spark.createDataFrame([(1, "again word"), (2, None)], "item_id long, text string")
    assert ls.ranked_search(empty, items).count() == 0
    got = [(r["item"].item_id, r["rank"], r.doc_id, r.score) for r in ls.ranked_search(odd, items).collect()]
    assert sorted(got, key=repr) == sorted(brute([(i, t) for i, t, _ in texts], [(1, "again word"), (2, None)]), key=repr)
