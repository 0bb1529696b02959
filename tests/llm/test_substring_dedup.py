import random

import numpy as np
import pytest

from tidemark.llm import substring_dedup as sd

from .conftest import passage


def brute(docs):
    """(id, text) in order; equal rows are one document."""
    seen, out = {}, {}
    for name in dict.fromkeys(docs):
        t = (name[1] or "").encode()
        gone = bytearray(len(t))
        for p in range(len(t) - 99):
            if seen.setdefault(t[p:p + 100], (name, p)) != (name, p):
                gone[p:p + 100] = b"\1" * 100
        spans, p = [], 0
        while p < len(t):
            if gone[p]:
                q = p
                while q < len(t) and gone[q]:
                    q += 1
                spans.append((p, q))
                p = q
            p += 1
        out[name] = (len(t), spans, bytes(b for b, g in zip(t, gone) if not g))
    return out


def corpus():
    r = random.Random(4)
    parts = [passage(i, 14) for i in range(30)]
    docs = []
    for i in range(80):
        text = " ".join(r.choice(parts) if r.random() < 0.5 else passage(500 + 50 * i + k, 10) for k in range(r.randint(1, 9)))
        docs.append((i, text))
    docs += [(80, docs[3][1]), (81, docs[3][1]), (82, "z" * 700), (83, "xy" * 400), (84, "ß" * 90), (85, docs[7][1][5:] + "!"),
             (86, None), (87, ""), (88, "q" * 99), (89, "q" * 100), (90, "q" * 101)]
    return docs


@pytest.mark.parametrize("crowd, chunk", [(8000, 20), (1, 20), (8000, 9)])
def test_against_brute_force(spark, monkeypatch, crowd, chunk):
    monkeypatch.setattr(sd, "CROWD", crowd)
    monkeypatch.setattr(sd, "_CHUNK_BITS", chunk)
    docs = corpus()
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    want = {name[0]: v for name, v in brute(docs).items()}
    got = {r.doc_id: (r.n_bytes, [(s.start, s.end) for s in r.spans], bytes(r.kept)) for r in sd.remove_repeats(frame).collect()}
    assert got == want


def test_odd_rows(odd, empty, texts):
    got = sd.remove_repeats(odd).collect()
    assert len(got) == len(texts) and sd.remove_repeats(empty).count() == 0
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    assert by[3][0].spans == [] and all(bytes(r.kept) == b"" for r in by[4])
    assert bytes(by[7][0].kept) == b"" and by[6][0].spans == []
    assert by[12][0].spans[0].start == 1 and len(bytes(by[12][0].kept)) == 1


def test_intervals_over_the_transform():
    r = random.Random(1)
    for _ in range(20):
        base = bytes(r.choice(b"ab") for _ in range(40))
        parts = [base[r.randrange(10):30 + r.randrange(10)] + bytes(r.choice(b"abc") for _ in range(r.randrange(30))) for _ in range(6)]
        text = np.frombuffer(b"".join(p + b"\xff" for p in parts), np.uint8)
        order, lo, hi = sd.repeated_intervals(text, 12)
        raw = text.tobytes()
        got = sorted(tuple(sorted(order[a:b].tolist())) for a, b in zip(lo, hi))
        at = {}
        for p in range(len(raw) - 11):
            if 255 not in raw[p:p + 12]:
                at.setdefault(raw[p:p + 12], []).append(p)
        assert got == sorted(tuple(v) for v in at.values() if len(v) > 1)
