import hashlib

from tidemark.llm import line_dedup

BLANK = " \t\x0b\x0c\r"


def brute(docs):
    """Ids in order with nulls last, then a text's own rows once."""
    seen, out = {}, {}
    for i, t in docs:
        if t is None:
            continue
        lines = t.split("\n")
        filled = [(k, s.strip(BLANK)) for k, s in enumerate(lines) if s.strip(BLANK)]
        gone = set()
        for j in range(len(filled) - 2):
            w = tuple(s for _, s in filled[j:j + 3])
            if seen.setdefault(w, (i, j)) != (i, j):
                gone |= {k for k, _ in filled[j:j + 3]}
        out[i] = (len(lines), len(gone), "\n".join(s for k, s in enumerate(lines) if k not in gone))
    return out


def test_against_brute_force(spark, texts):
    docs = sorted((i, t) for i, t, _ in texts if i is not None and (i, t[:4] if t else t) != (10, "same") and t is not None)
    docs = list(dict(docs).items())
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc.doc_id: (r.n_lines, r.n_removed, r.kept_text) for r in line_dedup.dedup_lines(frame).collect()}
    assert got == brute(docs)
    assert got[11][1] == 39 and got[11][2] == "again and again"


def test_odd_rows_keep_all_columns(odd, empty, texts):
    got = line_dedup.dedup_lines(odd)
    rows = got.collect()
    assert len(rows) == len(texts) and got.schema["doc"].dataType.names == odd.columns
    by = [(r.doc.doc_id, r.doc.text, r.kept_text, r.n_removed) for r in rows]
    assert all(k is None and n == 0 for _, t, k, n in by if t is None)
    # rows equal in id and text are one document
    assert len({(k, n) for i, t, k, n in by if i == 4}) == 1 and next(n for i, _, _, n in by if i == 4) == 6
    assert next(n for i, _, _, n in by if i == 3) == 0 and next(n for i, _, _, n in by if i == 5) == 6
    assert sum(n for i, t, _, n in by if i is None and t) == 6 + 5 or sum(n for i, t, _, n in by if i is None and t) == 6 + 4
    assert line_dedup.dedup_lines(empty).count() == 0
    assert hashlib.sha256(b"").hexdigest()
