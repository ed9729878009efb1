"""Regex predicates with RE2 meaning: partial match, case-sensitive, ASCII word boundaries.

The shipped patterns have JVM forms that need linear time and no recursion. Of other patterns
those that leave every place of a text after a few steps are rewritten for the JVM (re2.py); all
others are matched by RE2 itself, in Arrow batches and together (multipattern.py), so that a
caller's pattern can neither overflow a task's stack, nor hang a scan, nor change its meaning.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from fleetlake.functions.multipattern import which_match
from fleetlake.functions.re2 import to_jvm

# The shipped detection patterns.
DEFAULT_PATTERN = (
    r"('(''|[^'])*')|(;)|(\b(ALTER|CREATE|DELETE|DROP|EXEC(UTE){0,1}|INSERT( +INTO){0,1}"
    r"|MERGE|SELECT|UPDATE|UNION( +ALL){0,1})\b)"
)
PATTERN_LIBRARY = {
    "quotes_and_semicolons": r"('(''|[^'])*')|(;)",
    "sql_keywords": (
        r"\b(ALTER|CREATE|DELETE|DROP|EXEC(UTE){0,1}|INSERT( +INTO){0,1}"
        r"|MERGE|SELECT|UPDATE|UNION( +ALL){0,1})\b"
    ),
    "comment_patterns": r"(/\*.*?\*/)|(--.*$)|(;.*$)",
    "union_attacks": r"UNION\s+(ALL\s+)?SELECT",
    "or_attacks": r"\bOR\b.*=.*\bOR\b",
    "and_attacks": r"\bAND\b.*=.*\bAND\b",
    "script_injection": r"<script.*?>.*?</script>",
    "javascript_injection": r"javascript:",
    "vbscript_injection": r"vbscript:",
    "data_injection": r"data:",
}

_WORD = "0-9A-Za-z_"
_STARTS_WORD, _ENDS_WORD = f"(?<![{_WORD}])", f"(?![{_WORD}])"
# The words of the keyword patterns. The optional tails of the keyword patterns never decide a yes/no answer, but for EXECUTE.
_KEYWORDS = [
    "ALTER", "CREATE", "DELETE", "DROP", "EXEC", "INSERT", "MERGE", "SELECT", "UPDATE", "UNION",
]


def _word(w: str) -> str:
    return f"{_STARTS_WORD}{w}{_ENDS_WORD}"


def _two_quotes(c: Column) -> Column:
    # Text up to the second quote is the whole text unless there is a second quote.
    return F.substring_index(c, "'", 2) != c


def _rlike_if(c: Column, needed: list[str], regex: str) -> Column:
    """``regex``, tried only on text that holds every needed part: a byte search is far cheaper."""
    test = c.contains(needed[0])
    for part in needed[1:]:
        test = test & c.contains(part)
    return test & c.rlike(regex)


def _keyword(c: Column) -> Column:
    test = c.contains(_KEYWORDS[0])
    for word in _KEYWORDS[1:]:
        test = test | c.contains(word)
    return test & c.rlike(_word(f"(?:{'|'.join(_KEYWORDS)}|EXECUTE)"))


def _in_one_line(*parts: str) -> str:
    """The parts one after another within a line.

    Taking the first place for each part but the last is enough for a yes/no answer; the
    atomic groups keep those places fixed, so a line is read once.
    """
    *first, last = parts
    return r"(?:\A|\n)" + "".join(f"(?>[^\\n]*?{p})" for p in first) + f"[^\\n]*?{last}"


def _last_line(c: Column) -> Column:
    return F.substring_index(c, "\n", -1)


_JVM_FORMS: dict[str, Callable[[Column], Column]] = {
    DEFAULT_PATTERN: lambda c: c.contains(";") | _two_quotes(c) | _keyword(c),
    PATTERN_LIBRARY["quotes_and_semicolons"]: lambda c: c.contains(";") | _two_quotes(c),
    PATTERN_LIBRARY["sql_keywords"]: _keyword,
    PATTERN_LIBRARY["comment_patterns"]: lambda c: _last_line(c).contains("--")
    | _last_line(c).contains(";")
    | _rlike_if(c, ["/*", "*/"], _in_one_line(r"/\*", r"\*/")),
    PATTERN_LIBRARY["union_attacks"]: lambda c: _rlike_if(
        c, ["UNION", "SELECT"], r"UNION[\t\n\f\r ]++(?:ALL[\t\n\f\r ]++)?SELECT"
    ),
    PATTERN_LIBRARY["or_attacks"]: lambda c: _rlike_if(
        c, ["OR", "="], _in_one_line(_word("OR"), "=", _word("OR"))
    ),
    PATTERN_LIBRARY["and_attacks"]: lambda c: _rlike_if(
        c, ["AND", "="], _in_one_line(_word("AND"), "=", _word("AND"))
    ),
    PATTERN_LIBRARY["script_injection"]: lambda c: _rlike_if(
        c, ["<script", "</script>"], _in_one_line("<script", ">", "</script>")
    ),
}


def pattern_error(pattern: str) -> str | None:
    """Why RE2 refuses the pattern, or None when it is fine."""
    try:
        pc.match_substring_regex(pa.array([""]), pattern)
    except pa.ArrowInvalid as error:
        return str(error)
    return None


def jvm_match(c: Column, pattern: str) -> Column | None:
    """The predicate as a JVM expression, where its time is in proportion to the text; else None."""
    if pattern in _JVM_FORMS:
        return _JVM_FORMS[pattern](c)
    if not re.search(r"[\\.^$|?*+()\[\]{}]", pattern):
        return F.contains(c, F.lit(pattern))
    jvm = to_jvm(pattern)
    return None if jvm is None else c.rlike(jvm)


def match_all(c: Column, patterns: list[str]) -> list[Column]:
    """Whether each pattern matches. All that the JVM cannot bound share one pass in Arrow batches."""
    found = [jvm_match(c, p) for p in patterns]
    rest = [p for p, m in zip(patterns, found) if m is None]
    if rest:
        flags = which_match(c, rest)
        place = {p: i for i, p in enumerate(rest)}
        found = [F.get(flags, place[p]) if m is None else m for p, m in zip(patterns, found)]
    return found


def matches(c: Column, pattern: str) -> Column:
    """Null text gives null, as a regex predicate does."""
    return F.when(c.isNotNull(), match_all(c, [pattern])[0])
