import re
from itertools import permutations

import numpy as np
import pyspark.sql.functions as F
import pytest

from tidemark.llm import filter_audit as fa


def flags(rows):
    """Failed filters of ``(doc_id, text, part)`` by reading them one by one."""
    out = []
    for i, t, part in rows:
        t = t or ""
        w = re.findall(r"[^ \t-\r]+", t)
        smaller = [j for j, u, _ in rows if (u or "") == t and j is not None and i is not None and j < i]
        out.append((i, part or "", "".join(x for x, f in zip("ABCDE", (
            len(w) < 50, 100 * len(set(w)) < 65 * len(w), 100 * len(re.findall("[A-Z]", t)) > 5 * len(t),
            bool(re.search("[#$%&*|]", t)), bool(smaller))) if f)))
    return out


def brute(rows, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    out, flagged = [], flags(rows)
    for part in {p for _, p, _ in flagged}:
        docs = [(i, f) for i, p, f in flagged if p == part]
        removed = {}
        for o in permutations("ABCDE"):
            left = docs
            for step, x in enumerate(o, 1):
                gone = [d for d in left if x in d[1]]
                left = [d for d in left if x not in d[1]]
                removed[o, step] = (len(left), len(gone), sum(x in f for _, f in docs) - len(gone), sum(f == x for _, f in docs),
                                    sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone))
        for (o, step), got in removed.items():
            x = o[step - 1]
            out.append((part, "".join(o), step, *got, sum(v[1] for (p, s), v in removed.items() if p[s - 1] == x)))
    return out


LABELS = [(4, 1, 0), (4, 0, 1), (5, 1, None), (11, None, 1), (None, 1, 1), (13, 1, 1), (99, 1, 1), (14, 0, 0)]


@pytest.mark.parametrize("shard_bytes", [1, 500, 4 << 20])
def test_audit_is_what_every_order_removes(spark, odd, rows, shard_bytes):
    docs = odd.withColumn("part", F.col("x")).withColumn("n", F.lit(1)).withColumn("failed", F.lit(0)).withColumn("shard", F.lit("s"))
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int").withColumn("part", F.lit("p"))
    data = [(r.doc_id, r.text, r.source) for r in odd.collect()]
    flagged = fa.failed_filters(docs, shard_bytes=shard_bytes)
    sets = [(i, p, "".join(x for b, x in enumerate("ABCDE") if f >> b & 1)) for i, p, f in rows(flagged, "doc_id", "part", "failed")]
    assert sorted(sets, key=repr) == sorted(flags(data), key=repr)
    assert rows(fa.audit(flagged, labels)) == sorted(brute(data, LABELS), key=repr)


def test_matrix_holds_every_word_under_its_global_number(spark, odd):
    docs = odd.select(F.monotonically_increasing_id().alias("place"), F.struct("doc_id", "text").alias("doc"), "text")
    matrix, entries, words = fa.document_term_matrix(docs, shard_bytes=300)
    number = {bytes(r.word): r.id for r in words.collect()}
    assert sorted(number.values()) == list(range(len(number)))
    seen = 0
    for m in matrix.join(entries, "shard").collect():
        ends, ids, counts = np.frombuffer(m.ends, "<i8"), np.frombuffer(m.ids, "<i8" if m.wide else "<i4"), np.frombuffer(m.counts, "<i4")
        for d, a, b in zip(m.docs, ends, ends[1:]):
            want = {}
            for w in (d.text or "").encode().split():
                want[number[w]] = want.get(number[w], 0) + 1
            assert dict(zip(ids[a:b].tolist(), counts[a:b].tolist())) == want
            seen += 1
    assert seen == odd.count() and matrix.count() > 3


def test_empty_tables(spark, odd, empty):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert fa.audit(fa.failed_filters(empty), none).count() == 0
    got = fa.audit(fa.failed_filters(odd), none).agg(F.max("good_lost"), F.max("toxic_lost"), F.count("*")).first()
    assert tuple(got) == (0, 0, 600 * 2)
