import re

from tidemark.llm import licenses
from tidemark.llm.queries import BASE_PHRASES


def words(t):
    t = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    return re.findall(r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", t)


def brute(t):
    w = words(t)
    hits = [(label, i) for p, label in BASE_PHRASES for i in range(len(w)) if w[i:i + len(p.split())] == p.split()]
    at = [i for _, i in hits]
    return len(w), len(hits), min(at, default=None), max(at, default=None), ",".join(sorted({x for x, _ in hits}))


def test_base_places_against_brute_force(spark, odd, empty, texts):
    more = ["Licensed under the MIT License. Under the mit-license!", "Apache License, Version 2.0 and CC BY-NC 4.0", "cc by nc cc by nc"]
    docs = odd.select("doc_id", "text").unionByName(spark.createDataFrame([(50 + i, t) for i, t in enumerate(more)], "doc_id long, text string"))
    got = licenses.label_documents(licenses.scan_licenses(docs, BASE_PHRASES)).collect()
    want = [(i, *brute(t)) for i, t in [*((i, t) for i, t, _ in texts), *((50 + i, t) for i, t in enumerate(more))]]
    assert sorted([tuple(r)[:6] for r in got], key=repr) == sorted(want, key=repr)
    assert all(set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(","))) and 0 <= r.score <= 1 for r in got)
    assert licenses.scan_licenses(empty, BASE_PHRASES).count() == 0


SCANNER = licenses.Scanner(licenses.build_rules(), BASE_PHRASES)


def labels(text):
    return [(x[0], x[2], x[3]) for x in SCANNER.scan(text.encode())[2]]


def test_longest_and_surest_rule_wins():
    assert len(licenses.build_rules()) > 200
    assert labels("licensed under the GNU General Public License, version 3") == [("gpl-3", 0, 9)]
    assert labels("GNU Lesser General Public License, version 2.1")[0][0] == "lgpl-2.1"
    assert labels("released under GPL v2") == [("gpl-2", 0, 4)]
    assert labels("All rights reserved.") == [("all-rights-reserved", 0, 3)]
    assert labels("SPDX-License-Identifier: Apache-2.0")[0][0] == "apache-2"
    assert labels("mit dem Auto") == []


def test_containment():
    keep = licenses.suppress([(0, 10, 2, 0), (2, 8, 1, 1), (2, 8, 3, 2), (0, 10, 2, 3), (5, 12, 1, 4)])
    assert keep == [(0, 10, 2, 0), (2, 8, 3, 2), (5, 12, 1, 4)]


def test_common_forms_have_their_labels():
    forms = {
        "released under the GPL": "gpl", "available under the terms of the LGPL": "lgpl", "distributed under MIT": "mit",
        "relicensed under the MPL": "mpl", "GPLv3": "gpl-3", "GPLv2+": "gpl-2", "LGPLv2.1": "lgpl-2.1", "AGPLv3": "agpl-3",
        "GNU GPL v3": "gpl-3", "GPL-3.0-or-later": "gpl-3", "MPLv2": "mpl-2", "Apache v2": "apache-2", "GFDLv1.3": "gfdl-1.3",
        "BSD-3-Clause License": "bsd", "BSD-2-Clause": "bsd", "three-clause BSD": "bsd", "License: MIT": "mit",
        "License: Apache-2.0": "apache-2", "license is GPL": "gpl", "MIT licensed": "mit", "GPL-licensed code": "gpl",
        "BSD licenses": "bsd", "Apache licences": "apache",
    }
    got = {t: {x[0] for x in labels(t)} for t in forms}
    assert got == {t: {label} for t, label in forms.items()}
    for t in ("mit dem Auto", "gplus 3", "the EPL 2 season", "he was released under bail", "apache 2 helicopters", "nothing"):
        assert labels(t) == [], t


def test_holder_of_any_length():
    for n in (1, 12, 200, 20_000):
        t = "Neither the name of " + "holder " * n + "nor the names of its contributors may be used"
        assert labels(t) == [("bsd", 0, n + 10)]
    assert labels("neither the name of x " * 20_000) == []
    assert labels("neither the name of a neither the name of b nor the names of its contributors") == [("bsd", 5, 16)]


def test_lists_short_names_and_ordinary_words():
    forms = {
        "CC BY-NC-SA 4.0": {"cc-by-nc-sa-4"}, "CC-BY 4.0": {"cc-by-4"}, "MIT/X11": {"mit"}, "Apache-2.0 OR MIT": {"apache-2", "mit"},
        "Creative Commons Attribution-ShareAlike 4.0 International License": {"cc-by-sa-4"}, "CC BY-ND": {"cc-by-nd"},
        "dual licensed under MIT or Apache 2.0": {"mit", "apache-2"}, "MIT AND BSD-3-Clause OR ISC": {"mit", "bsd", "isc"},
        "licensed under the vim license": {"vim"}, "Elastic License 2.0": {"elastic-2"}, "licensed under the PHP License": {"php"},
        "the vim license plate": set(), "elastic license to drive": set(), "the common public license plates": set(), "a ruby license": set(),
        "mit dem Apache 2 Hubschrauber": set(), "rock and isc": set(),
    }
    assert {t: {x[0] for x in labels(t)} for t in forms} == forms


def ungated(text, rules):
    """Every rule on every text, and containment by comparing all pairs."""
    line = " " + " ".join(words(text)) + " "
    found = [(m.start(), m.end(), r.priority, i) for i, (r, e) in enumerate(rules) for m in e.finditer(line)]
    rank = lambda d: (-(d[1] - d[0]), -d[2], d[3])
    inside = lambda a, b: b[0] <= a[0] and a[1] <= b[1] and b[2] >= a[2] and (a[:2] != b[:2] or rank(b) < rank(a))
    kept = [d for d in found if not any(inside(d, e) for e in found if e is not d)]
    at = lambda pos: line.count(" ", 0, pos) - 1
    return sorted((rules[i][0].label, p, at(s), at(e) + 1) for s, e, p, i in kept)


def test_gate_and_containment_against_all_rules_and_pairs():
    import random
    rules = licenses.build_rules()
    scanner = licenses.Scanner(rules, BASE_PHRASES)
    compiled = [(x, re.compile(f"(?<= )(?:{x.expression})(?= )")) for x in rules]
    r = random.Random(7)
    parts = ("licensed under the terms of|license|version|v|2|3|2.1|or|and|mit|apache|gnu|gpl|gplv3|lesser|general public license|bsd|3-clause|"
             "all rights reserved|creative commons attribution|sharealike|cc by|nc|sa|4.0|international|public domain|SPDX-License-Identifier:|"
             "mpl|mozilla public|only|or later|vim|elastic|software is provided as is without warranty of any kind|the|x11|isc").split("|")
    for _ in range(1500):
        text = " ".join(r.choice(parts) for _ in range(r.randint(1, 12)))
        got = sorted(scanner.scan(text.encode())[2])
        assert got == ungated(text, compiled), text


def test_time_grows_with_the_hits():
    import time
    scanner = licenses.Scanner(licenses.build_rules(), BASE_PHRASES)
    text = b"All rights reserved. under the mit license " * 120_000  # 5 MB
    began = time.time()
    n, base, found = scanner.scan(text)
    assert time.time() - began < 60 and n == 7 * 120_000 and len(base) == 120_000 and base[-1][1] == n - 4
    assert sum(label == "all-rights-reserved" for label, *_ in found) == 120_000
