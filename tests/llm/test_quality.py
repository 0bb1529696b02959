import math
import re
from collections import Counter

import pyspark.sql.functions as F

from tidemark.llm import quality


def brute(t):
    t = t or ""
    w = re.findall("[^\x20\x09-\x0D]+", t)
    lines = [x for x in t.split("\n") if re.search("[^\x20\x09-\x0D]", x)]
    wins = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    often = Counter(wins)
    repeat = {j for i, x in enumerate(wins) if often[x] > 1 for j in range(i, i + 3)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines), len(lines) - len(set(lines)), len(repeat))


def test_base_features(spark, odd, empty, texts, rows):
    more = ["# * $ % & | < >", "a b c a b c a b c", "x\n\nx\n x", "a a a a", "a a a"]
    docs = odd.select("doc_id", "text").unionByName(spark.createDataFrame([(100 + i, t) for i, t in enumerate(more)], "doc_id long, text string"))
    got = quality.base_features(docs, {"doc_id": F.col("doc_id")}).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")
    want = [(i, *brute(t)) for i, t in [*((i, t) for i, t, _ in texts), *((100 + i, t) for i, t in enumerate(more))]]
    assert rows(got) == sorted(want, key=repr)
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert quality.judge(empty, labels).count() == 0
    assert quality.judge(odd, labels).count() == len(texts)


def test_binomial_tail(spark):
    cases = [(k, n, share) for n in (1, 10, 400, 3000) for k in (0, 1, 3, 11) if k <= n for share in (0.004, 0.05)]
    for share in (0.004, 0.05):
        frame = spark.createDataFrame([(k, n) for k, n, s in cases if s == share], "k long, n long")
        for r in frame.select("*", quality.binomial_tail(F.col("k"), F.col("n"), share).alias("p")).collect():
            exact = sum(math.comb(r.n, i) * share**i * (1 - share) ** (r.n - i) for i in range(r.k + 1))
            assert r.p == 1.0 if r.k >= r.n * share else abs(r.p - exact) < 1e-9


def make(spark, good, bad, symbols):
    text = lambda i, marks: " ".join(f"word{i}x{j}" for j in range(60)) + " " + "#" * marks
    docs = [(i, text(i, 0), "en") for i in range(good)] + [(good + i, text(good + i, symbols), "en") for i in range(bad)]
    labels = [(i, 1) for i in range(good)] + [(good + i, 0) for i in range(bad)]
    return spark.createDataFrame(docs, "doc_id long, text string, lang string"), spark.createDataFrame(labels, "doc_id long, quality int")


def test_cutoffs_need_enough_good_documents(spark):
    docs, labels = make(spark, 1700, 100, 40)
    got = quality.judge(docs, labels).groupBy(F.col("doc_id") < 1700).agg(F.sum(F.col("kept").cast("int")).alias("n")).collect()
    assert dict(map(tuple, got)) == {True: 1700, False: 0}
    docs, labels = make(spark, 140, 100, 40)  # 149 would do
    assert quality.judge(docs, labels).where("kept").count() == 240


def test_strata_and_rules_that_take_part_come_from_the_data(spark):
    """Two languages, one of them unheard of: each has its own cutoffs, the error is
    halved, and only a rule that reaches new bad documents takes risk from the others."""
    docs, labels = make(spark, 200, 30, 40)
    other = docs.withColumn("doc_id", F.col("doc_id") + 1000).withColumn("lang", F.lit("xx"))
    all_docs, all_labels = docs.unionByName(other), labels.unionByName(labels.withColumn("doc_id", F.col("doc_id") + 1000))
    got = quality.judge(all_docs, all_labels)
    assert {r.stratum: r.n for r in got.where("NOT kept").groupBy("stratum").agg(F.count("*").alias("n")).collect()} == {"en": 30, "xx": 30}
    features = quality.values(quality.base_features(all_docs, {"doc_id": F.col("doc_id"), "stratum": F.col("lang")}))
    found = quality.certified_cutoffs(features, all_labels).collect()
    assert {r.rule for r in found} == {0} and all(abs(r.tail - 0.98 ** 200) < 1e-12 for r in found if r.good_rejected == 0)
    # a bad document that only the last rule reaches makes it take part: risk and error are halved, and 200 are too few
    short = spark.createDataFrame([(5000, " ".join(chr(97 + i % 26) + chr(97 + i // 26) for i in range(300)), "en")], "doc_id long, text string, lang string")
    more = all_labels.unionByName(spark.createDataFrame([(5000, 0)], "doc_id long, quality int"))
    features = quality.values(quality.base_features(all_docs.unionByName(short), {"doc_id": F.col("doc_id"), "stratum": F.col("lang")}))
    assert {r.stratum for r in quality.certified_cutoffs(features, more).collect()} == {"xx"}


def test_conflicting_and_null_labels(spark):
    docs, labels = make(spark, 1700, 100, 40)
    more = labels.unionByName(spark.createDataFrame([(None, 1), (5, None), (5, 1), (1750, 1)], "doc_id long, quality int"))
    features = quality.values(quality.base_features(docs.unionByName(docs.where("doc_id < 3")), {"doc_id": F.col("doc_id"), "stratum": F.lit("en")}))
    r = quality.certified_cutoffs(features, more).where("chosen").first()
    assert (r.good, r.bad) == (1700, 100)
