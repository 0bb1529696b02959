import math
import zlib
from collections import Counter

import numpy as np
import pyspark.sql.functions as F

from tidemark.llm import sharding


def test_exact_sizes_and_gapless_slots(spark, odd, empty, texts):
    docs = odd.select("doc_id", "text").unionByName(spark.range(500).select((F.col("id") + 100).alias("doc_id"), F.col("id").cast("string").alias("text"))).repartition(5)
    got = sharding.shuffle_into_shards(docs, 8, range_rows=10).collect()
    n = len(texts) + 500
    assert len(got) == n
    by = {}
    for r in got:
        by.setdefault(r.shard, []).append(r.slot)
    assert [len(by[s]) for s in range(8)] == [n // 8 + (s < n % 8) for s in range(8)]
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    want = Counter((i, len((t or "").encode()) + 1, None if t is None else zlib.crc32(t.encode())) for i, t, _ in texts)
    have = Counter((r.doc_id, r["size"], r.text_crc32) for r in got if r.doc_id is None or r.doc_id < 100)
    assert have == want
    assert sharding.shuffle_into_shards(empty, 8).count() == 0


def test_hypergeometric_law(spark):
    c = lambda x: F.lit(x).cast("long")
    n = 20_000
    k = spark.range(n).select(sharding._hypergeometric(sharding._uniform(5, F.col("id")), c(30), c(40), c(100)).alias("k")).toPandas().k
    share = np.bincount(k, minlength=31) / n
    exact = np.array([math.comb(40, i) * math.comb(60, 30 - i) / math.comb(100, 30) for i in range(31)])
    assert np.abs(share - exact).max() < 0.012
    edge = spark.range(50).select(*[sharding._hypergeometric(sharding._uniform(1, F.col("id")), c(a), c(b), c(t)).alias(f"k{j}") for j, (a, b, t) in enumerate(
        [(0, 5, 9), (9, 5, 9), (4, 0, 9), (4, 9, 9), (0, 0, 0), (10**9, 10**9, 2 * 10**9 + 1)])]).distinct().collect()
    assert {tuple(r)[:5] for r in edge} == {(0, 5, 0, 4, 0)}


def test_matrix_has_exact_margins(spark):
    sizes = {0: 10, 2: 33, 4: 7, 5: 50, 11: 1}
    frame = spark.createDataFrame(list(sizes.items()), "part long, n long")
    m = {r.part: r.counts for r in sharding.communication_matrix(frame, [34, 34, 33], 3).collect()}
    assert {p: sum(c) for p, c in m.items()} == sizes
    assert np.sum(list(m.values()), axis=0).tolist() == [34, 34, 33]


def test_every_place_is_equally_likely(spark):
    """Shards of the first of 12 rows over many seeds."""
    docs = spark.range(12).select(F.col("id").alias("doc_id"), F.lit("same").alias("text")).repartition(3)
    seen = Counter()
    for seed in range(24):
        seen.update((r.doc_id, r.shard) for r in sharding.shuffle_into_shards(docs, 2, seed).collect())
    assert all(2 <= seen[i, s] <= 22 for i in range(12) for s in range(2))
