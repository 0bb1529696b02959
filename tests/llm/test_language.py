import math
import zlib

import duckdb
import numpy as np

from tidemark.llm import language

DOCS = "/root/testdata/sf0.01/documents.parquet"


def test_held_out_accuracy(spark):
    got = {r.doc_id: r for r in language.identify(spark.read.parquet(DOCS)).collect()}
    table = duckdb.sql(f"SELECT doc_id, lang FROM '{DOCS}'").fetchall()
    assert len(got) == len(table)
    held = [(got[i].lang_pred, lang) for i, lang in table if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, _ in table)
    assert sum(a == b for a, b in held) / len(held) > 0.98
    assert all(0 <= r.score <= 1 for r in got.values())


def test_odd_rows(odd, empty, texts):
    got = language.identify(odd).collect()
    assert len(got) == len(texts)
    und = {t for (_, t, _) in texts if not any(c.isalpha() for c in t or "")}
    assert sum(r.lang_pred == language.UNKNOWN for r in got) == sum(t in und for _, t, _ in texts)
    assert language.identify(empty).count() == 0


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "some text", None), (2, None, "en")], "doc_id long, text string, lang string")
    assert {(r.lang_pred, r.score) for r in language.identify(docs).collect()} == {("und", 0.0)}


def test_known_words_come_before_grams_and_grams_back_off(spark):
    labelled = spark.createDataFrame([(1, "sol sol luna", "xx"), (2, "moon sun sun", "yy")], "id long, text string, lang string")
    model = language.fit(labelled)
    assert model.languages == ["xx", "yy"] and "luna" in model.rows[0] and "^luna"[:5] in model.rows[5]
    docs = spark.createDataFrame([(1, "luna"), (2, "sunny"), (3, "lunatic"), (4, "²"), (5, "12 -")], "doc_id long, text string")
    got = {r.doc_id: r.lang_pred for r in language.predict(docs, model, ["doc_id"]).collect()}
    assert got == {1: "xx", 2: "yy", 3: "xx", 4: "und", 5: "und"}


def test_every_label_is_learned_and_rare_ones_take_no_others_texts(spark):
    common = " ".join(f"w{chr(97 + i)}{chr(97 + j)}" for i in range(20) for j in range(20))
    rows = [(i, common, "aa") for i in range(40)]
    names = [chr(98 + i // 26) + chr(97 + i % 26) for i in range(300)]
    rows += [(1000 + 2 * i + j, f"{n}zq{n} {n}xv{n}", n) for i, n in enumerate(names) for j in range(2)]
    rows += [(5000, "only once", "rare")]
    model = language.fit(spark.createDataFrame(rows, "id long, text string, lang string"), docs_per_language=10)
    assert model.languages == sorted(["aa", "rare", *names])
    # the prior is the share of all documents, not of the sample
    share = dict(zip(model.languages, np.exp(model.prior)))
    assert abs(share["aa"] - 40 / 641) < 1e-12 and abs(share["rare"] - 1 / 641) < 1e-12
    # a cell for each entry of a language, not for each entry and language
    assert model.gain.size < 2 * sum(map(len, model.rows)) and model.start.size == sum(map(len, model.rows)) + 1
    docs = [(n, f"{n}zq{n} {n}xv{n}") for n in [*names, "rare"][:-1]] + [("rare", "only once"), ("aa", "waa wbb unheard wcc wdd")]
    got = language.predict(spark.createDataFrame(docs, "lang string, text string"), model, ["lang"]).collect()
    assert [r.lang for r in got if r.lang != r.lang_pred] == []


def test_scores_equal_those_of_a_dense_table(spark):
    labelled = spark.createDataFrame([(1, "sol sol luna", "xx"), (2, "moon sun sun sol", "yy")], "id long, text string, lang string")
    model = language.fit(labelled)
    got = language.predict(spark.createDataFrame([("sol moon sol",)], "text string"), model, ["text"]).first()
    value = lambda k, total: math.log((k + 0.5) / (total + 0.5 * 4))  # noqa: E731 - four words in all
    x = (math.log(0.5) + 2 * value(2, 3) + value(0, 3)) / 3
    y = (math.log(0.5) + 2 * value(1, 4) + value(1, 4)) / 3
    assert got.lang_pred == ("xx" if x > y else "yy") and abs(got.score - 1 / (1 + math.exp(-abs(x - y)))) < 1e-9
