"""DuckDB twins of the queries that SQL can express."""

OP10 = r"""
WITH line AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS s, generate_subscripts(string_split(text, chr(10)), 1) AS i
  FROM documents WHERE text IS NOT NULL),
filled AS (
  SELECT doc_id, i, trim(s, chr(32) || chr(9) || chr(11) || chr(12) || chr(13)) AS s FROM line
  WHERE trim(s, chr(32) || chr(9) || chr(11) || chr(12) || chr(13)) <> ''),
win AS (
  SELECT doc_id, i AS a, lead(i, 1) OVER d AS b, lead(i, 2) OVER d AS c,
         s AS x, lead(s, 1) OVER d AS y, lead(s, 2) OVER d AS z
  FROM filled WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
occurrence AS (
  SELECT doc_id, a, b, c, row_number() OVER (PARTITION BY x, y, z ORDER BY doc_id, a) AS k FROM win WHERE z IS NOT NULL),
gone AS (SELECT DISTINCT doc_id, unnest([a, b, c]) AS i FROM occurrence WHERE k > 1),
kept AS (
  SELECT l.doc_id, count(*) AS n_lines, count(g.i) AS n_removed,
         coalesce(string_agg(CASE WHEN g.i IS NULL THEN l.s END, chr(10) ORDER BY l.i), '') AS t
  FROM line l LEFT JOIN gone g ON g.doc_id = l.doc_id AND g.i = l.i GROUP BY l.doc_id)
SELECT d.doc_id, coalesce(k.n_lines, 0) AS n_lines, coalesce(k.n_removed, 0) AS n_removed, sha256(k.t) AS kept_sha256
FROM documents d LEFT JOIN kept k ON k.doc_id = d.doc_id
"""

def _op1() -> str:
    from .quality import ERROR, RISK, RULES
    value = lambda e: e.replace(" div ", " // ")
    ladders = ", ".join(f"({r}, {p}, {c})" for r, (_, _, ladder) in enumerate(RULES) for p, c in enumerate(ladder))
    values = ", ".join(value(e) for _, e, _ in RULES)
    strictest = ", ".join(f"CASE WHEN v[{r + 1}] > {ladder[-1]} THEN {r} END" for r, (_, _, ladder) in enumerate(RULES))
    return rf"""
WITH doc AS (
  SELECT doc_id, coalesce(lang, '') AS stratum, coalesce(text, '') AS t FROM documents),
word AS (SELECT doc_id, regexp_extract_all(t, '[^ 	-
]+') AS w FROM doc),
win AS (SELECT doc_id, i, w[i:i + 2] AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM word)),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM win) WHERE n > 1),
rep AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM twice) GROUP BY doc_id),
line AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS s FROM doc),
lines AS (SELECT doc_id, count(*) AS n, count(*) - count(DISTINCT s) AS dup FROM line
          WHERE regexp_matches(s, '[^ 	-
]') GROUP BY doc_id),
feature AS (
  SELECT d.doc_id, d.stratum, len(w.w) AS n_words, length(array_to_string(w.w, '')) AS word_chars,
         len(regexp_extract_all(d.t, '[#*$%&|<>]')) AS n_symbols, coalesce(l.n, 0) AS n_lines,
         coalesce(l.dup, 0) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words
  FROM doc d JOIN word w ON w.doc_id = d.doc_id LEFT JOIN lines l ON l.doc_id = d.doc_id LEFT JOIN rep r ON r.doc_id = d.doc_id),
judged AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
         CASE WHEN n_words > 0 THEN [{values}] END AS v FROM feature),
rated AS (SELECT doc_id, min(quality) AS quality FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id),
seen AS (SELECT j.*, r.quality FROM judged j JOIN rated r ON r.doc_id = j.doc_id WHERE NOT base_failed),
ladder(rule, position, cutoff) AS (VALUES {ladders}),
cell AS (
  SELECT stratum, rule, position, cutoff, count(*) FILTER (quality >= 1) AS good, count(*) FILTER (quality < 1) AS bad,
         count(*) FILTER (quality >= 1 AND v[rule + 1] > cutoff) AS k, count(*) FILTER (quality < 1 AND v[rule + 1] > cutoff) AS b
  FROM seen, ladder GROUP BY ALL),
used AS (SELECT DISTINCT stratum, coalesce({strictest}) AS rule FROM seen WHERE quality < 1),
part AS (SELECT stratum, count(rule) AS m FROM used GROUP BY stratum),
strata AS (SELECT count(DISTINCT stratum) AS n FROM seen WHERE quality >= 1),
tried AS (SELECT c.*, {RISK} / m AS share, {ERROR} / (n * m) AS level FROM cell c JOIN used USING (stratum, rule) JOIN part USING (stratum), strata),
term AS (SELECT *, unnest(range(0, k + 1)) AS i FROM tried WHERE k < good * share),
tail AS (
  SELECT stratum, rule, position, cutoff, good, bad, k, b, level,
         sum(exp(lgamma(good + 1) - lgamma(i + 1) - lgamma(good - i + 1) + i * ln(share) + (good - i) * ln(1 - share))) AS p
  FROM term GROUP BY ALL),
best AS (
  SELECT stratum, rule, cutoff, row_number() OVER (PARTITION BY stratum, rule ORDER BY b * good - k * bad DESC, position) AS r
  FROM tail WHERE p <= level AND b * good - k * bad > 0),
failed AS (SELECT DISTINCT j.doc_id FROM judged j JOIN best c ON c.stratum = j.stratum AND c.r = 1 WHERE j.v[c.rule + 1] > c.cutoff)
SELECT j.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND f.doc_id IS NULL AS kept, stratum
FROM judged j LEFT JOIN failed f ON f.doc_id = j.doc_id
"""


#: Words after lower-casing A-Z: runs of what is no ASCII separator.
_WORDS = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")

OP5 = rf"""
WITH item AS (SELECT item_id::VARCHAR AS item, {_WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL),
item_win AS (
  SELECT item, least(len(w), 10) AS n, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i, w FROM item WHERE len(w) > 0),
win AS (SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS t FROM item_win),
doc AS (SELECT doc_id, {_WORDS} AS w FROM documents),
place AS (
  SELECT doc_id, s.n, unnest(range(1, len(w) - s.n + 2)) AS i, w FROM doc, (SELECT DISTINCT n FROM win) s WHERE len(w) >= s.n),
hit AS (
  SELECT p.doc_id, p.i, p.n, v.item FROM (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS t FROM place) p
  JOIN win v ON v.t = p.t AND v.n = p.n),
covered AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM hit) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
          FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(c.n_hit, 0) AS n_hit, coalesce(m.n_items, 0) AS n_items,
       sha256(coalesce(m.items, '')) AS items_sha256, coalesce(c.n_hit, 0) > 0 AS contaminated
FROM doc d LEFT JOIN covered c ON c.doc_id = d.doc_id LEFT JOIN named m ON m.doc_id = d.doc_id
"""


#: Five filters over every order: flags by document, then sums over orders and steps.
OP13 = r"""
WITH doc AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
fail AS (
  SELECT doc_id, part,
         [len(w) < 50, 100 * len(list_distinct(w)) < 65 * len(w), 100 * len(regexp_extract_all(t, '[A-Z]')) > 5 * length(t),
          regexp_matches(t, '[#$%&*|]'), coalesce(min(doc_id) OVER (PARTITION BY t) < doc_id, false)] AS f FROM doc),
rated AS (
  SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
cell AS (
  SELECT part, f, list_sum([x::INT FOR x IN f]) AS k, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic
  FROM fail LEFT JOIN rated USING (doc_id) GROUP BY part, f),
pos AS (SELECT unnest(range(1, 6)) AS p),
ord AS (
  SELECT [a.p, b.p, c.p, d.p, e.p] AS o FROM pos a, pos b, pos c, pos d, pos e
  WHERE len(list_distinct([a.p, b.p, c.p, d.p, e.p])) = 5),
step AS (SELECT o, p AS step, o[p] AS own, o[1:p - 1] AS before FROM ord, pos),
judged AS (
  SELECT part, o, step, n, good, toxic, k, f[own] AS holds, NOT coalesce(list_bool_or([f[x] FOR x IN before]), false) AS passed FROM cell, step)
SELECT part, array_to_string([substr('ABCDE', x, 1) FOR x IN o], '') AS filter_order, step::INT AS step,
       coalesce(sum(n) FILTER (NOT holds AND passed), 0)::BIGINT AS kept, coalesce(sum(n) FILTER (holds AND passed), 0)::BIGINT AS removed,
       coalesce(sum(n) FILTER (holds AND NOT passed), 0)::BIGINT AS redundant,
       coalesce(sum(n) FILTER (holds AND k = 1), 0)::BIGINT AS unique_fails,
       coalesce(sum(good) FILTER (holds AND passed), 0)::BIGINT AS good_lost,
       coalesce(sum(toxic) FILTER (holds AND passed), 0)::BIGINT AS toxic_lost,
       coalesce(sum(n * 120 // greatest(k, 1)) FILTER (holds), 0)::BIGINT AS shapley
FROM judged GROUP BY part, o, step
"""


_TERMS = _WORDS.replace(r"\x3A-\x60", r"\x3A-\x40\x5B-\x60")
OP11 = rf"""
WITH doc AS (SELECT doc_id, row_number() OVER () AS r, {_TERMS} AS w FROM documents),
total AS (SELECT count(*) AS big_n, sum(len(w))::BIGINT AS big_l FROM doc WHERE len(w) > 0),
tf AS (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(w) AS t FROM doc) GROUP BY r, t),
weight AS (SELECT t, floor(1000 * ln((2 * any_value(big_n) + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM tf, total GROUP BY t),
item AS (SELECT item_id, row_number() OVER () AS i, {_TERMS} AS w FROM benchmark),
ask AS (SELECT i, item_id, t, count(*) AS q FROM (SELECT i, item_id, unnest(w) AS t FROM item) GROUP BY i, item_id, t),
length AS (SELECT r, doc_id, 75 + (25 * len(w) * big_n) // big_l AS m FROM doc, total WHERE len(w) > 0),
score AS (
  SELECT i, item_id, doc_id, r, sum(q * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
  FROM ask JOIN weight USING (t) JOIN tf USING (t) JOIN length USING (r) GROUP BY i, item_id, doc_id, r)
SELECT item_id, (row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id))::INT AS rank, doc_id, score
FROM score WHERE score > 0 QUALIFY rank <= 20
"""

ORACLES: dict[str, str] = {"op1_quality_rules": _op1(), "op5_decontaminate": OP5, "op10_line_dedup": OP10, "op11_lexical_search": OP11, "op13_filter_audit": OP13}
