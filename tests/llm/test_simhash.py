import random
import re

import pytest
import xxhash

from tidemark.llm import simhash
from tidemark.llm.components import connected_components


def reference(t):
    w = re.findall("[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    shingles = [" ".join(w[k:k + 3]) for k in range(max(1, len(w) - 2))] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def groups(values, near):
    root = {v: v for v in values}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    vs = sorted(root)
    for i, a in enumerate(vs):
        for b in vs[i + 1:]:
            if near(a, b):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {v: find(v) for v in vs}


def test_fingerprints(odd, texts):
    got = sorted((r.doc_id is None, r.doc_id or 0, r.fp & (1 << 64) - 1) for r in simhash.fingerprints(odd).collect())
    assert got == sorted((i is None, i or 0, reference(t)) for i, t, _ in texts)


@pytest.mark.parametrize("paired", [0, 3, 32])
def test_links_connect_what_is_within_two_bits(spark, paired):
    r = random.Random(paired)
    values = {0}
    for _ in range(12):  # crowds around centres, all over the 64 bits and inside a few of them
        c = r.getrandbits(64)
        bits = [r.randrange(64) for _ in range(8)]
        for _ in range(40):
            v = c
            for _ in range(r.randint(0, 4)):
                v ^= 1 << r.choice(bits if r.random() < 0.7 else range(64))
            values.add(v)
    signed = {v: v - (1 << 64) if v >> 63 else v for v in values}
    want = groups(values, lambda a, b: (a ^ b).bit_count() <= 2)
    links = simhash.links(spark.createDataFrame([(v,) for v in signed.values()], "fp long"), paired)
    found = {x.node: x.root for x in connected_components(links).collect()}
    got = {v: found.get(s, s) for v, s in signed.items()}
    by_root, by_want = {}, {}
    for v in values:
        by_root.setdefault(got[v], set()).add(v)
        by_want.setdefault(want[v], set()).add(v)
    assert sorted(map(sorted, by_root.values())) == sorted(map(sorted, by_want.values()))


def test_chain_keys_cover_every_pair():
    chains = simhash._chains()
    for a in range(64):
        for b in range(a, 64):
            x = (1 << a) | (1 << b)
            assert any(not x & k and (x & m).bit_count() <= 1 for k, m in chains)


def test_groups_of_odd_rows(odd, empty, texts):
    got = simhash.group_documents(odd).collect()
    assert len(got) == len(texts)
    fps = {i: reference(t) for i, t, _ in texts if i is not None}
    assert {r.component_id for r in got if r.fp == 0} == {0}
    same = [r.component_id for r in got if r.doc_id in (3, 4)]
    assert same == [3, 3, 3] and fps[3] == fps[4]
    assert simhash.group_documents(empty).count() == 0 and simhash.keep_one(empty).count() == 0


def test_one_of_each_group_stays(odd):
    groups_ = {r.root for r in simhash.group_documents(odd).collect()}
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns
    ids = [r.doc_id for r in kept.collect()]
    assert len(ids) == len(groups_) and {0, 3, 6} <= set(ids) and not {1, 2, 4} & set(ids)


def test_components_of_a_long_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(60)]
    star = [(1000, 1000 + i) for i in range(1, 200)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(path + star, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(61)} | {1000 + i: 1000 for i in range(200)}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
