"""Quality rules with risk-controlled thresholds (operator 1).

A rule rejects documents whose value lies above a cutoff. For every stratum
(language) and rule, a fixed ladder of cutoffs is tested on labelled documents,
from lenient to strict: with ``n`` good documents of which a cutoff rejects
``k``, the exact binomial tail ``P(Bin(n, a) <= k)`` must stay below the level.
Then the share of good documents that the cutoff rejects is below ``a``. A ladder
stops at its first failure (fixed-sequence testing).

Strata are the values that the data have. The error is split equally over those
with labelled good documents. Within a stratum, a rule takes part if its strictest
cutoff rejects a labelled bad document that those of the rules before it all pass;
the other rules' risk and error go to the rules that take part, in equal parts
(Bonferroni). Who takes part depends on bad documents alone, so the tests on good
ones stay valid: with probability ``1 - ERROR`` all rules together reject at most
``RISK`` of the good documents in every stratum. With ``S`` strata and ``m`` rules
taking part, a stratum needs ``ln(ERROR / (S m)) / ln(1 - RISK / m)`` good labelled
documents before a cutoff can pass: 217 for four strata and one rule, 505 for two.
Of the cutoffs that pass, the one with the best balance of bad and good rejections
is used; a ladder without such a cutoff rejects nothing.

Everything is a DataFrame expression. Texts are scanned once into a table of
counts. Cutoffs are a row per stratum that has some, and join by it.
"""

from __future__ import annotations

import pyspark.sql.functions as F
from pyspark.sql import Column, DataFrame

from .common import col, written

#: Greatest share of a stratum's good documents that may be rejected, and the
#: probability that the labelled sample misleads about it.
RISK, ERROR = 0.02, 0.05
#: Rules: name, value (a document fails above the cutoff), cutoffs from lenient to strict.
RULES: list[tuple[str, str, list[int]]] = [
    ("symbols per 1000 word characters", "1000 * n_symbols div word_chars", [400, 300, 200, 150, 100, 75, 50, 30, 20, 10, 5, 2]),
    ("repeated lines in percent", "100 * n_dup_lines div greatest(n_lines, 1)", [95, 90, 80, 70, 60, 50, 45, 40, 35, 30]),
    ("repeated words in percent", "100 * n_repeat_words div n_words", [49, 45, 40, 35, 30, 25, 20, 15]),
    ("longest mean word", "100 * word_chars div n_words", [1500, 1200, 1000, 900, 850, 800, 750, 700]),
    ("shortest mean word", "-(100 * word_chars div n_words)", [-150, -200, -250, -300, -325, -350, -375, -400]),
]

BLANK = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"


def base_features(docs: DataFrame, keep: dict[str, Column], text_col: str = "text") -> DataFrame:
    """The columns ``keep`` (name: expression) and counts of each text, a row
    per input row.

    Words are runs of other than blanks. ``n_words``, ``word_chars`` (code points
    in words), ``n_symbols``, ``n_lines`` (lines with a word), ``n_dup_lines``
    (those equal to an earlier one) and ``n_repeat_words`` (words inside
    three-word windows that the text has twice or more). All are 0 for null,
    empty and blank texts.
    """
    text = F.coalesce(col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(" \t\x0b\x0c\r")) != "")
    split = docs.select(
        *[c.alias(k) for k, c in keep.items()], F.filter(F.split(text, BLANK), lambda w: w != "").alias("words"),
        (F.size(F.split(text, SYMBOLS)) - 1).cast("long").alias("n_symbols"), lines.alias("lines"))
    windows = F.transform(F.sequence(F.lit(0), F.size("words") - 3), lambda i: F.struct(
        F.xxhash64(*[F.get("words", i + k) for k in range(3)]).alias("h"), i.alias("i")))
    hashed = split.select(
        *keep, F.size("words").cast("long").alias("n_words"), F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        "n_symbols", F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.size("words") >= 4, F.sort_array(windows)).alias("wins"))
    m = F.size("wins") - 1
    twice = F.flatten(F.zip_with(F.slice("wins", 1, m), F.slice("wins", 2, m), lambda a, b: F.when(
        a["h"] == b["h"], F.array(a["i"], b["i"])).otherwise(F.array().cast("array<int>"))))
    starts = hashed.select("*", F.sort_array(F.array_distinct(twice)).alias("starts")).drop("wins")
    covered = F.aggregate(
        "starts", F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")),
        lambda acc, i: F.struct((i + 3).alias("end"), (acc["n"] + i + 3 - F.greatest(i, acc["end"])).alias("n")), lambda acc: acc["n"])
    return starts.select("*", F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words")).drop("starts")


def base_failed() -> Column:
    """Too short, or mostly repeated."""
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def binomial_tail(k: Column, n: Column, share: Column | float) -> Column:
    """``P(Bin(n, share) <= k)`` for ``k`` below ``n * share``; 1 from there on,
    where the tail exceeds any level of use. Sums the terms from ``k`` down by
    their ratios, from the logarithm of the first one."""
    share = share if isinstance(share, Column) else F.lit(share)
    step = lambda a, i: a + F.log((n - k + i) / i)
    down = F.when(k > 0, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<bigint>"))
    first = F.aggregate(down, F.lit(0.0), step) + k * F.log(share) + (n - k) * F.log(1 - share)
    ratio = lambda i: i * (1 - share) / ((n - i + 1) * share)
    rest = F.aggregate(F.reverse(down), F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("sum")), lambda a, i: F.struct(
        (a["term"] * ratio(i)).alias("term"), (a["sum"] + a["term"] * ratio(i)).alias("sum")), lambda a: a["sum"])
    return F.when(k >= n * share, 1.0).otherwise(F.exp(first) * rest)


def values(features: DataFrame) -> DataFrame:
    """Adds ``rule_values``: each rule's value, null where a text has no words."""
    return features.withColumn("rule_values", F.when(F.col("n_words") > 0, F.array(*[F.expr(e).cast("long") for _, e, _ in RULES])))


def certified_cutoffs(valued: DataFrame, labels: DataFrame, risk: float = RISK, error: float = ERROR) -> DataFrame:
    """``stratum, rule, position, cutoff, good, bad, good_rejected,
    bad_rejected, tail, chosen`` for all cutoffs that pass.

    ``valued`` has ``doc_id, stratum, n_words, n_repeat_words, rule_values``;
    documents that fail the base rules are no evidence. ``labels`` has ``doc_id,
    quality``: ids or qualities that are null are dropped, and an id with
    several qualities counts once, by the lowest. Rows of one id count once.
    Without labels no cutoff passes.
    """
    rated = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    seen = valued.where(~base_failed()).join(rated, "doc_id").groupBy("doc_id").agg(
        F.min(F.struct("stratum", "rule_values", "quality")).alias("x")).select("x.*")
    good, bad = (F.col("quality") >= 1).cast("long"), (F.col("quality") < 1).cast("long")
    cells = [(r, p, c, F.get("rule_values", F.lit(r)) > c) for r, (_, _, ladder) in enumerate(RULES) for p, c in enumerate(ladder)]
    counted = seen.groupBy("stratum").agg(
        F.sum(good).alias("good"), F.sum(bad).alias("bad"), F.array(*[F.struct(
            F.lit(r).alias("rule"), F.lit(p).alias("position"), F.lit(c).alias("cutoff"),
            F.sum(F.when(over, good).otherwise(0)).alias("good_rejected"),
            F.sum(F.when(over, bad).otherwise(0)).alias("bad_rejected")) for r, p, c, over in cells]).alias("cells"))
    strictest = [F.when(F.get("rule_values", F.lit(r)) > ladder[-1], r) for r, (_, _, ladder) in enumerate(RULES)]
    used = seen.where(bad > 0).select("stratum", F.coalesce(*strictest).alias("rule")).where("rule IS NOT NULL").groupBy("stratum").agg(
        F.collect_set("rule").alias("used"))  # of the rules
    n_strata = seen.where(good > 0).agg(F.count_distinct("stratum").alias("n")).scalar()
    tested = counted.join(used, "stratum").select("stratum", "good", "bad", F.size("used").alias("m"), "used", F.explode("cells").alias("c")).select(
        "stratum", "good", "bad", "m", "used", "c.*").where(F.array_contains("used", F.col("rule"))).drop("used").withColumn(
        "level", error / (n_strata * F.col("m"))).withColumn(
        "tail", binomial_tail(F.col("good_rejected"), F.col("good"), risk / F.col("m")))
    # rejections grow along a ladder and so do tails: what passes comes before the first failure
    passed = tested.where(F.col("tail") <= F.col("level")).drop("level", "m")
    gain = F.col("bad_rejected") * F.col("good") - F.col("good_rejected") * F.col("bad")
    best = passed.groupBy("stratum", "rule").agg(F.max(F.struct(gain.alias("gain"), (-F.col("position")).alias("p"))).alias("best")).where(
        "best.gain > 0").select("stratum", "rule", (-F.col("best.p")).alias("position"), F.lit(True).alias("chosen"))
    return passed.join(best, ["stratum", "rule", "position"], "left").withColumn("chosen", F.coalesce("chosen", F.lit(False)))


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang",
          risk: float = RISK, error: float = ERROR) -> DataFrame:
    """``doc_id``, the base counts, ``base_failed``, ``kept`` and ``stratum``,
    a row per input row.

    A document is kept if the base rules and all chosen cutoffs of its stratum
    pass; a null stratum is the empty string. Null, empty and blank texts fail the base rules. Repeated rows get
    equal results; null ids are judged, but no label applies to them. Further
    columns are not read.
    """
    stratum = F.coalesce(col(stratum_col).cast("string"), F.lit(""))
    features = written(values(base_features(docs, {"doc_id": col(id_col), "stratum": stratum}, text_col)), "quality-features")
    chosen = certified_cutoffs(features, labels, risk, error).where("chosen")
    by_stratum = chosen.groupBy("stratum").agg(F.collect_list(F.struct("rule", "cutoff")).alias("cutoffs"))  # a row per rule at most
    rules = features.join(by_stratum, "stratum", "left")
    failed = F.exists("cutoffs", lambda c: F.get(F.col("rule_values"), c["rule"]) > c["cutoff"])
    return rules.withColumn("base_failed", base_failed()).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & ~F.coalesce(failed, F.lit(False))).alias("kept"), "stratum")
