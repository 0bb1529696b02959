"""List-literal parsing and the features computed from it.

Values such as ``['kernel32.dll', 'user32.dll']`` arrive as strings. All of
this is native Column expressions (JSON reader with single quotes, split,
transform/filter/aggregate) — no Python per row.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

_JSON_OPTS = {"allowSingleQuotes": "true", "allowBackslashEscapingAnyCharacter": "true",
              "allowNumericLeadingZeros": "true", "allowNonNumericNumbers": "true"}


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


#: What surrounds a literal or a token without being part of it.
_SPACE = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0"
#: A quoted string, and words that are values in JSON but not in a list literal.
_QUOTED = r"""'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*\""""
_JSON_WORDS = r"[\[,]\s*(?:null|true|false|NaN|[+-]?Infinity|[+-]?INF)\s*[,\]]"
#: One of these is in whatever matches ``_JSON_WORDS``; few literals have any.
_WORD_PARTS = ("null", "true", "false", "NaN", "Infinity", "INF")


def _strip(s: Column) -> Column:
    return F.btrim(s, F.lit(_SPACE))


def _bracket_parse(s: Column) -> Column:
    """Parse a bracketed literal to array<string>; NULL when malformed.
    A trailing comma (valid in the literal, not in JSON) is removed first, and
    bare words that only JSON knows make it malformed. Quoted strings are looked
    through for them only where such a word occurs at all."""
    cleaned = F.regexp_replace(s, r",\s*\]$", "]")
    bare = F.regexp_replace(cleaned, _QUOTED, "''")
    words = F.lit(False)
    for w in _WORD_PARTS:
        words = words | s.contains(w)
    return F.when(~words | ~bare.rlike(_JSON_WORDS), F.from_json(cleaned, "array<string>", _JSON_OPTS))


def stripped(col: str | Column) -> Column:
    """A literal without what surrounds it. As a column of its own it is made once for
    all that ``list_from_literal`` looks at."""
    return _strip(_c(col))


def list_from_literal(col: str | Column, is_stripped: bool = False) -> Column:
    """string -> array<string>.

    null / '' -> []; trimmed; not starting with '[' -> split on '|' or ',',
    drop blank tokens, trim, strip quote characters; otherwise parse the list
    literal, any failure -> []. Nested lists come back as one stringified
    element each. ``is_stripped`` columns are not trimmed again.
    """
    s = _c(col) if is_stripped else _strip(_c(col))
    tokens = F.filter(F.split(s, r"[|,]"), lambda t: _strip(t) != "")
    plain = F.transform(tokens, lambda t: F.regexp_replace(_strip(t), r"^['\"]+|['\"]+$", ""))
    empty = F.array().cast("array<string>")
    return (F.when(s.isNull() | (s == ""), empty)
            .when(~s.startswith("["), plain)
            .otherwise(F.coalesce(_bracket_parse(s), empty)))


def parse_status(col: str | Column) -> Column:
    """'empty' (null/blank), 'malformed' (bracketed but unparseable) or 'ok'.

    Exposes the cases F1 silently maps to [] — e.g. truncated long lists.
    """
    s = _strip(_c(col))
    return (F.when(s.isNull() | (s == ""), "empty")
            .when(s.startswith("[") & _bracket_parse(s).isNull(), "malformed")
            .otherwise("ok"))


def list_size(col: str | Column) -> Column:
    """number of parsed items."""
    return F.size(list_from_literal(col))


def contains_any(col: str | Column, patterns: Iterable[str]) -> Column:
    """1 if any pattern is a (case-sensitive) substring; null -> 0."""
    s = _c(col)
    cond = F.lit(False)
    for p in patterns:
        cond = cond | s.contains(p)
    return F.coalesce(cond, F.lit(False)).cast("int")


def signature_count(col: str | Column) -> Column:
    """null/'' -> 0; parsed non-empty -> item count with nested lists
    flattened one level; parsed empty (incl. '[]' and malformed) ->
    number of commas + 1."""
    s = _c(col)
    n_of = lambda x: F.when(
        x.startswith("["), F.coalesce(F.size(F.from_json(x, "array<string>", _JSON_OPTS)), F.lit(1))
    ).otherwise(F.lit(1))
    # null for an empty list; the items are parsed once
    flat = F.aggregate(list_from_literal(s), F.lit(None).cast("int"), lambda acc, x: F.coalesce(acc, F.lit(0)) + n_of(x))
    commas = F.length(s) - F.length(F.replace(s, F.lit(","), F.lit(""))) + 1
    return F.when(s.isNull() | (s == ""), F.lit(0)).otherwise(F.coalesce(flat, commas)).cast("int")


def any_member(col: str | Column, names: Iterable[str]) -> Column:
    """1 if any parsed item is exactly one of ``names``."""
    arr = F.array(*[F.lit(n) for n in names])
    return F.coalesce(F.arrays_overlap(F.array_compact(list_from_literal(col)), arr), F.lit(False)).cast("int")
