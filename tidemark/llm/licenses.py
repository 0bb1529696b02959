"""License detection by ordered signature rules (operator 6).

A text becomes its lower-case words, joined by single blanks. One pass with a
keyword automaton tells which rules can match at all; only those expressions
run. Every rule has a priority. A detection that lies inside another one of at
least its priority is dropped (an equal interval: the rule that comes first
wins), so that "gnu general public license version 3" is one finding and not
four. Declared base phrases are matched as whole word sequences and are never
suppressed. Each row is judged alone: nothing is shuffled or collected.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
import pyspark.sql.functions as F
from pyspark.sql import DataFrame

from .common import col

# License families as (label stem, names as word expressions with
# the keywords of which each name
# holds one, versions). A version "2" also reads "2 0".
FAMILIES: list[tuple[str, str, str, tuple[str, ...]]] = [
    ("mit", "(?:mit|expat|mit x11)", "licen", ()),
    ("apache", "(?:apache|apache software)", "apache", ("1 0", "1 1", "2")),
    ("gpl", "(?:gnu )?(?:general public|gpl|gnu gpl)", "general public|gpl", ("1", "2", "3")),
    ("lgpl", "(?:gnu )?(?:lesser general public|library general public|lgpl)", "lesser general|library general|lgpl", ("2", "2 1", "3")),
    ("agpl", "(?:gnu )?(?:affero general public|agpl)", "affero|agpl", ("1", "3")),
    ("gfdl", "(?:gnu )?(?:free documentation|gfdl|fdl)", "free documentation|fdl", ("1 1", "1 2", "1 3")),
    ("bsd", "(?:(?:new|modified|simplified|revised|original|(?:[0234]|two|three|four) clause) )?bsd(?: (?:[0234]|two|three|four) clause)?", "bsd", ()),
    ("mpl", "(?:mozilla public|mpl)", "mozilla public| mpl ", ("1 0", "1 1", "2")),
    ("epl", "(?:eclipse public|epl)", "eclipse public| epl ", ("1", "2")),
    ("edl", "eclipse distribution", "eclipse distribution", ("1",)),
    ("cddl", "(?:common development and distribution|cddl)", "common development|cddl", ("1", "1 1")),
    ("cpl", "common public", "common public", ("1",)),
    ("ipl", "ibm public", "ibm public", ("1",)),
    ("eupl", "(?:european union public|eupl)", "european union|eupl", ("1 0", "1 1", "1 2")),
    ("osl", "(?:open software|osl)", "open software| osl ", ("1", "2", "3")),
    ("afl", "academic free", "academic free", ("1 2", "2", "3")),
    ("artistic", "(?:perl )?artistic", "artistic", ("1", "2")),
    ("boost", "boost(?: software)?", "boost", ("1",)),
    ("isc", "isc", "isc", ()),
    ("zlib", "(?:zlib|zlib libpng)", "zlib", ()),
    ("unlicense", "(?:unlicense|unlicence)", "unlicen", ()),
    ("wtfpl", "(?:wtfpl|do what the fuck you want to public)", "wtfpl|what the fuck", ("1", "2")),
    ("python", "(?:python software foundation|psf)", "python software| psf ", ("2",)),
    ("php", "php", "php", ("3", "3 01")),
    ("ruby", "ruby", "ruby", ()),
    ("postgresql", "postgresql", "postgresql", ()),
    ("openssl", "openssl", "openssl", ()),
    ("ofl", "(?:sil )?(?:open font|ofl)", "open font| ofl ", ("1 0", "1 1")),
    ("odbl", "(?:open database|odbl)", "open database|odbl", ("1",)),
    ("odc-by", "(?:open data commons attribution|odc by)", "open data commons|odc by", ("1",)),
    ("pddl", "(?:public domain dedication and|pddl)", "domain dedication|pddl", ("1",)),
    ("ms-pl", "(?:microsoft public|ms pl)", "microsoft public|ms pl", ()),
    ("ms-rl", "(?:microsoft reciprocal|ms rl)", "microsoft reciprocal|ms rl", ()),
    ("upl", "universal permissive", "universal permissive", ("1",)),
    ("blue-oak", "blue oak model", "blue oak", ("1",)),
    ("cecill", "cecill", "cecill", ("1", "2", "2 1")),
    ("qpl", "q public", "q public", ("1",)),
    ("lppl", "(?:latex project public|lppl)", "latex project|lppl", ("1 0", "1 2", "1 3")),
    ("busl", "(?:business source|busl|bsl)", "business source|busl| bsl ", ("1 1",)),
    ("sspl", "(?:server side public|sspl)", "server side|sspl", ("1",)),
    ("elastic", "elastic", "elastic", ("1", "2")),
    ("vim", "vim", "vim", ()),
    ("w3c", "w3c(?: software)?", "w3c", ()),
    ("ncsa", "(?:university of illinois )?ncsa(?: open source)?", "ncsa", ()),
    ("cc-by", "(?:cc by|creative commons attribution)", "cc by|creative commons", ("1", "2", "2 5", "3", "4")),
    ("cc-by-sa", "(?:cc by sa|creative commons attribution share ?alike)", "cc by|creative commons", ("1", "2", "2 5", "3", "4")),
    ("cc-by-nd", "(?:cc by nd|creative commons attribution no ?deriv(?:ative)?s?)", "cc by|creative commons", ("2", "3", "4")),
    ("cc-by-nc", "(?:cc by nc|creative commons attribution non ?commercial)", "cc by|creative commons", ("2", "3", "4")),
    ("cc-by-nc-sa", "(?:cc by nc sa|creative commons attribution non ?commercial share ?alike)", "cc by|creative commons", ("2", "3", "4")),
    ("cc-by-nc-nd", "(?:cc by nc nd|creative commons attribution non ?commercial no ?deriv(?:ative)?s?)", "cc by|creative commons", ("2", "3", "4")),
    ("cc0", "(?:cc0|creative commons zero|cc zero)", "cc0|cc zero|commons zero", ("1",)),
]
# Short names that a version can follow without a word for license, joined to it or not
# (gplv3, lgpl 2 1), and those that mean other things too, where the version needs a v.
SHORT = {"gpl": "gpl", "lgpl": "lgpl", "agpl": "agpl", "gfdl": "g?fdl", "mpl": "mpl", "cddl": "cddl", "eupl": "eupl", "odbl": "odbl",
         "pddl": "pddl", "lppl": "lppl", "busl": "busl", "sspl": "sspl", "wtfpl": "wtfpl", "cecill": "cecill"}
SHORT_WITH_V = {"apache": "apache", "epl": "epl", "osl": "osl", "afl": "afl", "python": "psf", "ofl": "ofl", "upl": "upl", "qpl": "qpl"}
#: Families whose names are ordinary words too: "name license" alone says nothing of them.
ORDINARY = {"cpl", "boost", "php", "ruby", "elastic", "vim"}
#: Keywords of names that stand without a word for license, where the family's has that word.
BARE_KEYWORDS = {"mit": "under mit |under the mit |terms of mit |terms of the mit |expat"}
#: Names that are a license without that word.
BARE_NAMES: list[tuple[str, str, str]] = [
    ("bsd", "bsd (?:[0234]|two|three|four) clause", "clause"),
    ("bsd", "(?:[0234]|two|three|four) clause bsd", "clause"),
    ("mit", "mit x11", "mit x11"),
    ("mit", "x11 licen[sc]e", "x11 licen"),
    ("apache-2", "apache 2 0", "apache 2 0"),
    ("cc-by-sa", "cc by sa", "cc by sa"),
    ("cc-by-nd", "cc by nd", "cc by nd"),
    ("cc-by-nc", "cc by nc", "cc by nc"),
    ("cc-by-nc-sa", "cc by nc sa", "cc by nc sa"),
    ("cc-by-nc-nd", "cc by nc nd", "cc by nc nd"),
    ("cc0", "cc0", " cc0 "),
    ("unlicense", "the unlicense", "the unlicense"),
]
# Names as expressions of licenses write them ("apache 2 0 or mit"), with their labels. In such
# an expression a name needs no other word.
LISTED: list[tuple[str, str]] = [
    ("mit", "mit"), ("apache-2", "apache 2 0"), ("apache-2", "apache 2"), ("bsd", "bsd 2 clause"), ("bsd", "bsd 3 clause"), ("isc", "isc"),
    ("zlib", "zlib"), ("mpl-2", "mpl 2 0"), ("gpl-2", "gpl 2 0"), ("gpl-3", "gpl 3 0"), ("gpl-2", "gplv2"), ("gpl-3", "gplv3"),
    ("lgpl-2.1", "lgpl 2 1"), ("lgpl-3", "lgpl 3 0"), ("agpl-3", "agpl 3 0"), ("unlicense", "unlicense"), ("cc0-1", "cc0 1 0"),
    ("boost-1", "bsl 1 0"), ("epl-2", "epl 2 0"),
]
# Wording of notices and license texts, as (label, expression, keyword).
NOTICES: list[tuple[str, str, str]] = [
    ("all-rights-reserved", "all rights (?:are )?reserved", "rights"),
    ("all-rights-reserved", "tous droits réservés", "tous droits"),
    ("all-rights-reserved", "alle rechte vorbehalten", "alle rechte"),
    ("all-rights-reserved", "todos los derechos reservados", "derechos reservados"),
    ("copyright-notice", "copyright (?:c )?(?:19|20)[0-9]{2}(?: (?:19|20)?[0-9]{2})*", "copyright"),
    ("public-domain", "(?:is |are |placed |released |dedicated )?(?:in|into|to) the public domain", "public domain"),
    ("public-domain", "public domain (?:work|dedication|mark)", "public domain"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy", "hereby granted"),
    ("mit", "the above copyright notice and this permission notice shall be included", "permission notice"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose", "permission to use"),
    ("bsd", "redistribution and use in source and binary forms with or without modification", "redistribution and use"),
    ("bsd", "redistributions of source code must retain the above copyright notice", "redistributions of source"),
    # the holder's name, of any length, ends at the next of these words
    ("bsd", "neither the names? of(?: (?!neither |nor the names of )[^ ]+)++ nor the names of (?:its|their|the) contributors", "neither the name"),
    ("apache-2", "you may not use this file except in compliance with the license", "in compliance with"),
    ("gpl", "this program is free software you can redistribute it and or modify it", "free software"),
    ("gpl", "either version [23] (?:of the license )?or at your option any later version", "any later version"),
    ("lgpl", "this library is free software you can redistribute it and or modify it", "free software"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license", "mozilla public"),
    ("zlib", "this software is provided as is without any express or implied warranty in no event", "provided as is"),
    ("boost-1", "permission is hereby granted free of charge to any person or organization", "hereby granted"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "unencumbered"),
    ("wtfpl-2", "you just do what the fuck you want to", "what the fuck"),
    ("proprietary", "(?:confidential and proprietary|proprietary and confidential)", "proprietary"),
    ("proprietary", "unauthori[sz]ed (?:copying|use|reproduction|distribution)", "unauthori"),
    ("no-warranty", "the software is provided as is without warranty of any kind", "without warranty"),
    ("apache-2", "unless required by applicable law or agreed to in writing software distributed under the license", "applicable law"),
    ("apache-2", "licensed to the apache software foundation", "apache software"),
    ("gpl", "you should have received a copy of the gnu general public license", "received a copy"),
    ("lgpl", "you should have received a copy of the gnu lesser general public license", "received a copy"),
    ("agpl", "you should have received a copy of the gnu affero general public license", "received a copy"),
    ("gpl", "this program is distributed in the hope that it will be useful but without any warranty", "in the hope"),
    ("lgpl", "this library is distributed in the hope that it will be useful but without any warranty", "in the hope"),
    ("gpl", "everyone is permitted to copy and distribute verbatim copies of this license document", "verbatim copies"),
    ("gfdl", "permission is granted to copy distribute and or modify this document", "modify this document"),
    ("bsd", "redistributions in binary form must reproduce the above copyright notice", "binary form"),
    ("bsd", "all advertising materials mentioning features or use of this software must display", "advertising materials"),
    ("bsd", "the views and conclusions contained in the software and documentation are those of the authors", "views and conclusions"),
    ("isc", "the software is provided as is and the author disclaims all warranties", "disclaims all"),
    ("mpl-2", "if a copy of the mpl was not distributed with this file you can obtain one at", "copy of the mpl"),
    ("mpl-1.1", "software distributed under the license is distributed on an as is basis without warranty of any kind either express or implied", "as is basis"),
    ("epl", "this program and the accompanying materials are made available under the terms of the eclipse public license", "accompanying materials"),
    ("cddl-1", "you can obtain a copy of the license at usr src opensolaris license", "opensolaris"),
    ("ofl-1.1", "this font software is licensed under the sil open font license", "font software"),
    ("artistic-2", "everyone is permitted to copy and distribute verbatim copies of this license document but changing it is not allowed", "changing it"),
    ("cc0-1", "to the extent possible under law the (?:author|person)(?: who| has)", "extent possible"),
    ("cc-by", "this work is licensed under (?:a|the) creative commons attribution", "creative commons"),
    ("python-2", "psf is making python available to licensee on an as is basis", "psf is making"),
    ("postgresql", "permission to use copy modify and distribute this software and its documentation for any purpose without fee", "without fee"),
    ("zlib", "altered source versions must be plainly marked as such", "plainly marked"),
    ("zlib", "this notice may not be removed or altered from any source distribution", "removed or altered"),
    ("boost-1", "distributed under the boost software license version 1 0", "boost software"),
    ("unlicense", "anyone is free to copy modify publish use compile sell or distribute this software", "anyone is free"),
    ("public-domain", "no copyright is claimed", "copyright is claimed"),
    ("public-domain", "has been dedicated to the public domain", "public domain"),
    ("ms-pl", "if you use the software you accept this license", "accept this license"),
    ("sspl-1", "making the functionality of the program or a modified version available to third parties as a service", "as a service"),
    ("busl-1.1", "the licensor hereby grants you the right to copy modify create derivative works redistribute and make non production use", "non production"),
    ("elastic-2", "you may not provide the software to third parties as a hosted or managed service", "managed service"),
    ("odbl-1", "this database is made available under the open database license", "open database"),
    ("blue-oak-1", "each contributor licenses you to do everything with this software", "each contributor"),
    ("non-commercial", "for (?:personal and )?non ?commercial use only", "commercial use"),
    ("non-commercial", "not for commercial use", "commercial use"),
    ("proprietary", "this software is (?:the )?proprietary", "proprietary"),
    ("proprietary", "no part of this (?:publication|work|book|document) may be reproduced", "may be reproduced"),
    ("proprietary", "trade secrets? (?:of|and)", "trade secret"),
    ("used-with-permission", "(?:used|reprinted|reproduced) (?:with|by) (?:the )?(?:kind )?permission", "permission"),
    ("commercial", "(?:commercial|enterprise) licen[sc]e agreement", "agreement"),
    ("eula", "end user licen[sc]e agreement", "agreement"),
]

#: Priorities, and what a detection of that kind adds to a document's score.
TAG, TEXT, VERSIONED, REFERENCE, NAME = 5, 4, 3, 2, 1
CONFIDENCE = {TAG: 1.0, TEXT: 0.95, VERSIONED: 0.9, REFERENCE: 0.8, NAME: 0.5}


@dataclass(frozen=True)
class Rule:
    label: str
    expression: str
    keyword: str  # alternatives are separated by |
    priority: int


def _version(v: str) -> str:
    return f"{v}(?: 0)?" if " " not in v else v


def build_rules(families=None, notices=None) -> list[Rule]:
    """The ordered rules: the wordings of each family and version, then names
    that need no word for license, then notices."""
    rules = []
    for stem, name, keyword, versions in FAMILIES if families is None else families:
        words = stem.replace("-", " ")
        kind = "licen[sc](?:e|es|ed)"
        given = ("(?:re)?(?:licen[sc]ed|released|distributed|published|available|provided|covered|governed|offered) "
                 "under (?:the )?(?:terms of )?(?:the )?")
        named = "licen[sc]es?(?: is| type| name| id)? (?:under )?(?:the )?"
        granted = ("(?:licen[sc]ed|released|distributed|published|available|provided|covered|governed|offered) "
                   "(?:under|by|with|on) (?:the )?(?:terms of )?(?:the )?")
        ported = "(?: (?:international|unported|generic))?" if stem.startswith("cc") else ""
        for v in versions:
            label = f"{stem}-{v.replace(' ', '.')}"
            if ported:
                rules.append(Rule(label, f"{name} {_version(v)}{ported}(?: {kind})?", keyword, VERSIONED))
            rules += [
                Rule(label, f"spdx licen[sc]e identifier {words} {_version(v)}(?: only| or later)?", "spdx", TAG),
                Rule(label, f"{granted}{name}(?: {kind})? (?:version |v ?)?{_version(v)}", keyword, VERSIONED),
                Rule(label, f"{name} {kind} (?:version |v ?)?{_version(v)}", keyword, VERSIONED),
                Rule(label, f"{named}{name} (?:version |v ?)?{_version(v)}", keyword, VERSIONED),
            ]
            for short, between in ((SHORT.get(stem), " ?(?:v ?|version )?"), (SHORT_WITH_V.get(stem), " ?(?:v ?|version )")):
                if short:
                    rules.append(Rule(label, f"(?:gnu )?{short}{between}{_version(v)}(?: only| or later)?(?: {kind})?",
                                      "|".join(f" {k}" for k in ("gfdl", "fdl")) if stem == "gfdl" else f" {short}", VERSIONED))
        rules += [
            Rule(stem, f"spdx licen[sc]e identifier {words}", "spdx", TAG),
            Rule(stem, f"{granted}{name} {kind}", keyword, REFERENCE),
            Rule(stem, f"{given}{name}", BARE_KEYWORDS.get(stem, keyword), REFERENCE),
        ]
        if stem not in ORDINARY:
            rules += [Rule(stem, f"{name} {kind}", keyword, NAME), Rule(stem, f"{named}{name}", keyword, NAME)]
    rules += [Rule(label, e, k, NAME) for label, e, k in BARE_NAMES]
    others = "|".join(sorted({n for _, n in LISTED}, key=lambda n: (-len(n), n)))
    after = "|".join(f"(?<= {n} {w} )" for n in sorted({n for _, n in LISTED}) for w in ("or", "and"))
    for label, n in LISTED:
        rules += [Rule(label, f"{n}(?= (?:or|and) (?:{others}) )", f"{n} or |{n} and ", REFERENCE),
                  Rule(label, f"(?:{after}){n}", f" or {n} | and {n} ", REFERENCE)]
    return rules + [Rule(label, e, k, TEXT) for label, e, k in (NOTICES if notices is None else notices)]


_BLANK = re.compile(" ")


class Scanner:
    """Compiled rules for one worker."""

    def __init__(self, rules: list[Rule], phrases: list[tuple[str, str]]):
        self.rules = [(r, re.compile(f"(?<= )(?:{r.expression})(?= )")) for r in rules]
        self.phrases = [(f" {p} ", label) for p, label in phrases]
        by_keyword: dict[str, list[int]] = {}
        for i, r in enumerate(rules):
            for k in r.keyword.split("|"):
                by_keyword.setdefault(k, []).append(i)
        for i, (p, _) in enumerate(self.phrases):
            by_keyword.setdefault(p, []).append(-1 - i)
        self.words = ahocorasick.Automaton()
        for k, which in by_keyword.items():
            self.words.add_word(k, which)
        self.words.make_automaton()
        # bytes of words after lower-casing A-Z: digits, a-z, and all of any non-ASCII character
        self.fold = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32
                          for b in range(256))

    def scan(self, text: bytes) -> tuple[int, list, list]:
        """Words; base places ``(label, start word)``; surviving detections
        ``(label, priority, start word, end word)``."""
        words = text.translate(self.fold).split()
        line = " " + b" ".join(words).decode("utf-8", "replace") + " "
        due = sorted({i for _, which in self.words.iter(line) for i in which})
        blanks = [m.start() for m in _BLANK.finditer(line)] if due else []
        at = lambda pos: bisect_left(blanks, pos) - 1  # noqa: E731 - the word that starts at pos
        base, found = [], []
        for i in due:
            if i < 0:
                phrase, label = self.phrases[-1 - i]
                pos = line.find(phrase)
                while pos >= 0:
                    base.append((label, at(pos + 1)))
                    pos = line.find(phrase, pos + 1)
            else:
                rule, expression = self.rules[i]
                found += [(m.start(), m.end(), rule.priority, i) for m in expression.finditer(line)]
        kept = suppress(found)
        return len(words), base, [(self.rules[i][0].label, p, at(s), at(e) + 1) for s, e, p, i in kept]


def suppress(found: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    """Detections ``(start, end, priority, order)`` that lie in no kept one of
    at least their priority. They are looked at from the left, longer ones,
    higher priorities and earlier rules first; it is enough to know how far the
    kept ones of each priority reach."""
    kept, reach = [], {}
    for d in sorted(found, key=lambda d: (d[0], -d[1], -d[2], d[3])):
        if all(end < d[1] for p, end in reach.items() if p >= d[2]):
            kept.append(d)
            reach[d[2]] = max(reach.get(d[2], -1), d[1])
    return kept


def scan_licenses(docs: DataFrame, phrases: list[tuple[str, str]], rules: list[Rule] | None = None,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, base, detections`` with one row per input row.

    ``base`` holds ``label, start`` of every place of a base phrase, and
    ``detections`` ``label, priority, start, end`` (words from 0, end excluded).
    A null or empty text has no words and empty lists. Repeated rows and null
    ids are kept as they are, and further columns are not read.
    """
    table = build_rules() if rules is None else rules
    base_type = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64())]))
    found_type = pa.list_(pa.struct([("label", pa.string()), ("priority", pa.int32()), ("start", pa.int64()),
                                     ("end", pa.int64())]))

    def run(batches):
        scanner = Scanner(table, phrases)
        for whole in batches:
            for start in range(0, whole.num_rows, 256):
                b = whole.slice(start, 256)
                out = [scanner.scan(t or b"") for t in b.column(1).cast(pa.binary()).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array([n for n, _, _ in out], pa.int64()),
                     pa.array([[dict(zip(("label", "start"), x)) for x in base] for _, base, _ in out], base_type),
                     pa.array([[dict(zip(("label", "priority", "start", "end"), x)) for x in f] for _, _, f in out],
                              found_type)], ["doc_id", "n_words", "base", "detections"])

    frame = docs.select(col(id_col).alias("doc_id"), col(text_col).alias("text"))
    return frame.mapInArrow(run, f"doc_id {frame.schema[0].dataType.simpleString()}, n_words long, "
                            "base array<struct<label:string,start:bigint>>, "
                            "detections array<struct<label:string,priority:int,start:bigint,end:bigint>>")


def label_documents(found: DataFrame) -> DataFrame:
    """From ``scan_licenses``: labels, places and a score per document. The
    score is the confidence of its surest finding (a base phrase counts as
    certain) and 0 without any."""
    base = F.transform("base", lambda b: b["label"])
    score = F.array_max(F.transform("detections", lambda d: F.element_at(
        F.create_map(*[F.lit(x) for p, c in CONFIDENCE.items() for x in (p, c)]), d["priority"])))
    starts = F.transform("base", lambda b: b["start"])
    joined = lambda labels: F.concat_ws(",", F.array_sort(F.array_distinct(labels)))
    return found.select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"), F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"), joined(base).alias("base_labels"),
        joined(F.concat(base, F.transform("detections", lambda d: d["label"]))).alias("labels"),
        F.when(F.size("base") > 0, 1.0).otherwise(F.coalesce(score, F.lit(0.0))).alias("score"))
