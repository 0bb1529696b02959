import math
import random
from collections import Counter, defaultdict

import pyspark.sql.functions as F
import pytest

from tidemark.llm import mixing


def corpus(spark, n=3000):
    r, rows = random.Random(5), []
    for i in range(n):
        source = r.choices(["b", "Z", "a", "é", None, "c"], [9, 9, 1, 1, 1, 1])[0]
        rows.append((i, " ".join(["w"] * int(math.exp(r.random() * 6))) if i % 50 else None, source))
    rows += [(n, "w " * 5_000, "b"), (n + 1, "one", "tiny"), (n + 2, "", "empty"), (n + 3, "\t w\x0bw\x85w ", "tiny")]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, source string")


def filled(size, weights=(5, 2, 1)):
    """Targets by handing out the excess again and again."""
    names = sorted((s for s in size if s is not None), key=lambda s: [ord(c) for c in s]) + [s for s in size if s is None]
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    goal, full = 1.5 * sum(size.values()), set()
    while True:
        rest = goal - sum(2 * size[s] for s in full)
        t = {s: 2.0 * size[s] if s in full else rest * w[s] / sum(w[x] for x in size if x not in full) for s in size}
        if not (more := {s for s in size if t[s] > 2 * size[s]}):
            return t
        full |= more


def solved(docs, target):
    """The tilt of one source by bisection."""
    f = lambda x: sum(s * min(2.0, math.exp(min(x * s, 50))) for s in docs)
    low, high = -50.0, 50.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if f(mid) < target else (low, mid)
    return low


def test_rates_solve_the_dual_and_copies_meet_the_targets(spark):
    rows, df = corpus(spark)
    got = mixing.mix_sources(df.repartition(5), range_rows=50).collect()
    words = {i: len([w for w in (t or "").replace("\t", " ").replace("\x0b", " ").split(" ") if w]) for i, t, _ in rows}
    size = defaultdict(int)
    for i, _, s in rows:
        size[s] += words[i]
    target = filled(size)
    assert Counter(r.doc_id for r in got) == Counter(list(words))
    by = defaultdict(list)
    for r in got:
        assert r["size"] == words[r.doc_id] and r.source_size == size[r.source] and math.isclose(r.target, target[r.source], rel_tol=1e-12, abs_tol=1e-9)
        assert r.taken == r.copies * r["size"] <= 2 * r["size"] and abs(r.copies - r.rate) < 1
        by[r.source].append(r)
    assert any(target[s] == 2 * size[s] for s in size) and any(target[s] < size[s] for s in size)
    for s, docs in by.items():
        if target[s] == 2 * size[s]:
            assert all(r.copies == 2 for r in docs if r["size"])
            continue
        tilt = solved([r["size"] for r in docs], target[s])
        assert all(math.isclose(r.rate, min(2.0, math.exp(min(tilt * r["size"], 50))), rel_tol=1e-6) for r in docs if r["size"])
        loose = [r["size"] for r in docs if 0.001 < r.rate % 1 < 0.999]
        assert abs(sum(r.taken for r in docs) - target[s]) <= max(loose, default=0) / 2 + 1e-3 * target[s]


def test_partitions_do_not_matter(spark, rows):
    _, df = corpus(spark, 600)
    assert rows(mixing.mix_sources(df.repartition(7)).drop("rate")) == rows(mixing.mix_sources(df.coalesce(1), range_rows=20).drop("rate"))


def test_repeated_and_null_ids_and_ties(spark):
    docs = [(None if i % 3 else 7, "a b c", "x" if i % 2 else None) for i in range(400)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string").withColumn("size", F.lit("s")).withColumn("n", F.lit(1))
    got = mixing.mix_sources(df, range_rows=10).collect()
    assert Counter((r.doc_id, r.source) for r in got) == Counter((i, s) for i, _, s in docs)
    assert all(abs(sum(r.taken for r in got if r.source == s) - next(r.target for r in got if r.source == s)) <= 3 for s in ("x", None))


def test_odd_rows_and_empty_tables(odd, empty, texts):
    got = mixing.mix_sources(odd).collect()
    assert Counter(r.doc_id for r in got) == Counter(t[0] for t in texts)
    assert mixing.mix_sources(empty).count() == 0


@pytest.mark.parametrize("text", [None, "", " \n"])
def test_sources_without_words(spark, text):
    got = mixing.mix_sources(spark.createDataFrame([(1, text, "a"), (2, text, None)], "doc_id long, text string, source string")).collect()
    assert sorted((r.doc_id, r["size"], r.target, r.taken) for r in got) == [(1, 0, 0.0, 0), (2, 0, 0.0, 0)]
