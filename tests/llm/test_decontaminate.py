import re

import pytest

from tidemark.llm import decontaminate as d

from .conftest import passage


def words(t):
    t = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    return re.findall(r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", t)


def brute(docs, items):
    wins = {}
    for item, t in items:
        w = words(t)
        if w and item is not None:
            n = min(10, len(w))
            for i in range(len(w) - n + 1):
                wins.setdefault(tuple(w[i:i + n]), set()).add(str(item))
    out = []
    for i, t in docs:
        w, hit, names = words(t), set(), set()
        for n in {len(x) for x in wins}:
            for k in range(len(w) - n + 1):
                if (x := tuple(w[k:k + n])) in wins:
                    hit |= set(range(k, k + n))
                    names |= wins[x]
        out.append((i, len(w), sorted(hit), sorted(names)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("broadcast", [1 << 26, 0])
def test_against_brute_force(spark, odd, texts, rows, monkeypatch, broadcast):
    monkeypatch.setattr(d, "BROADCAST_BYTES", broadcast)
    items = [(1, passage(77, 200)), (2, "Two words"), (3, None), (4, ""), (5, passage(0, 9) + " " + passage(1, 9)), (6, "word"),
             (7, passage(77, 200)), (None, "same id"), (30, "ab ab ab ab ab ab ab ab ab ab ab ab"), (31, "漢字 äöü äöü")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = odd.unionByName(spark.createDataFrame([(90, "x TWO, words y " + passage(77, 200)[40:900])], "doc_id long, text string"), allowMissingColumns=True)
    got = d.find_hits(docs, bench)
    want = brute([*((i, t) for i, t, _ in texts), (90, "x TWO, words y " + passage(77, 200)[40:900])], items)
    assert rows(got, "doc_id", "n_words", "hit_words", "items") == want


def test_a_passage_that_many_items_share(spark, rows):
    shared = passage(5, 30)
    items = [(i, shared + " " + passage(500 + i, 12)) for i in range(300)]
    docs = [(i, passage(900 + i, 20) + " " + shared + " " + passage(500 + i, 12)) for i in range(20)] + [(20, shared)] * 2
    bench, table = spark.createDataFrame(items, "item_id long, text string"), spark.createDataFrame(docs, "doc_id long, text string")
    wins, holders = d.benchmark_windows(bench)
    assert "items" not in wins.columns and wins.count() == wins.select("win").distinct().count() < holders.count()
    assert rows(d.find_hits(table, bench), "doc_id", "n_words", "hit_words", "items") == brute(docs, items)
    assert d.remove_documents(table, bench).count() == 0


def test_empty_tables(spark, odd, empty, texts):
    none = spark.createDataFrame([], "item_id long, text string")
    bench = spark.createDataFrame([(1, "word")], "item_id long, text string")
    assert d.report(odd, none).where("contaminated").count() == 0
    assert d.report(odd, none).count() == len(texts)
    assert d.report(empty, bench).count() == 0


def test_removal_keeps_clean_rows_and_columns(spark, odd, texts):
    bench = spark.createDataFrame([(1, passage(77, 200))], "item_id long, text string")
    left = d.remove_documents(odd, bench)
    assert left.columns == odd.columns
    assert left.count() == len(texts) - 2 and left.where("doc_id IN (14, 15)").count() == 0
