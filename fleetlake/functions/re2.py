"""What can be told from an RE2 pattern without running it.

A pattern of common parts is parsed into a small tree (``parse``; None for all others). From the tree
come a JVM expression, where matching it takes a bounded number of steps per character of the text
(``to_jvm``), and literals without which the pattern cannot match (``needed_literals``).
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

_WORD = "0-9A-Za-z_"
_BOUNDARY = f"(?:(?<![{_WORD}])(?=[{_WORD}])|(?<=[{_WORD}])(?![{_WORD}]))"
# A space in RE2 is one of five characters; a word boundary and the classes are ASCII.
_ESCAPES = {"d": "[0-9]", "D": "[^0-9]", "s": r"[\t\n\f\r ]", "S": r"[^\t\n\f\r ]", "w": f"[{_WORD}]", "W": f"[^{_WORD}]"}
_INSIDE = {"d": "0-9", "s": r"\t\n\f\r ", "w": _WORD}
_CONTROLS = {"t": "\t", "n": "\n", "r": "\r"}
_TOKEN = re.compile(
    r"""(?P<cls>\[\^?(?:[^\[\]\\&~-]|\\[dswtnr.\-\]\[\\^$|?*+(){}]|[0-9A-Za-z]-[0-9A-Za-z]|-(?=\]))+\])
      | (?P<esc>\\[dDsSwWbtnr.\-/\]\[\\^$|?*+(){}"'<>=!@#%&:;,~`])
      | (?P<open>\((?:\?:)?) | (?P<close>\)) | (?P<or>\|)
      | (?P<rep>(?:[*+?]|\{[0-9]{1,3}(?:,(?:[0-9]{1,3})?)?\})\??)
      | (?P<dot>\.) | (?P<start>\^) | (?P<end>\$)
      | (?P<lit>[^\\\[\](){}|*+?.^$])""",
    re.X,
)
# Steps a pattern may take from one place of a text, and literals looked for as one alternative.
MAX_STEPS = 1_000
MAX_LITERALS = 24


@dataclass(frozen=True)
class One:
    """One character: any of ``chars``, or of a class that is not spelled out (None)."""

    jvm: str
    chars: frozenset[str] | None


@dataclass(frozen=True)
class Place:
    """An anchor or a word boundary."""

    jvm: str


@dataclass(frozen=True)
class Chain:
    parts: tuple


@dataclass(frozen=True)
class Choice:
    branches: tuple


@dataclass(frozen=True)
class Repeat:
    part: object
    low: int
    high: int | None
    jvm: str


def _bounds(text: str) -> tuple[int, int | None]:
    if text[0] != "{":
        return {"*": (0, None), "+": (1, None), "?": (0, 1)}[text[0]]
    low, comma, high = text.rstrip("?")[1:-1].partition(",")
    return int(low), (int(high) if high else None) if comma else int(low)


def _character(kind: str, text: str):
    if kind == "dot":
        return One(r"[^\n]", None)
    if kind == "lit":
        return One(text, frozenset(text))
    if kind == "esc":
        if text[1] in _ESCAPES:
            return One(_ESCAPES[text[1]], None)
        return One(text, frozenset(_CONTROLS.get(text[1], text[1])))
    listed = text[1:-1]
    chars = frozenset(listed) if len(listed) <= 4 and listed[0] != "^" and not set("\\-") & set(listed) else None
    return One(re.sub(r"\\([dsw])", lambda m: _INSIDE[m[1]], text), chars)


def parse(pattern: str):
    """The tree of the pattern, or None if it has other parts than those listed above."""
    open_groups: list[list[list]] = [[[]]]
    at = 0
    while at < len(pattern):
        token = _TOKEN.match(pattern, at)
        if not token:
            return None
        kind, text, at = token.lastgroup, token.group(), token.end()
        here = open_groups[-1][-1]
        if kind == "open":
            open_groups.append([[]])
        elif kind == "close":
            if len(open_groups) == 1:
                return None
            here = open_groups.pop()
            open_groups[-1][-1].append(Choice(tuple(Chain(tuple(b)) for b in here)))
        elif kind == "or":
            open_groups[-1].append([])
        elif kind == "rep":
            low, high = _bounds(text)
            if not here or isinstance(here[-1], (Repeat, Place)) or (high is not None and low > high):
                return None
            here[-1] = Repeat(here[-1], low, high, text)
        elif kind == "start":
            here.append(Place(r"\A"))
        elif kind == "end":
            here.append(Place(r"\z"))
        elif kind == "esc" and text == r"\b":
            here.append(Place(_BOUNDARY))
        else:
            here.append(_character(kind, text))
    if len(open_groups) > 1:
        return None
    return Choice(tuple(Chain(tuple(b)) for b in open_groups[0]))


def _steps(node) -> tuple[float, float]:
    """Ways through the part, and the characters of the longest."""
    if isinstance(node, (One, Place)):
        return 1, 1
    if isinstance(node, Repeat):
        # A repeated group would be matched by recursion.
        if node.high is None or not isinstance(node.part, One):
            return float("inf"), float("inf")
        return node.high - node.low + 1, node.high
    parts = [_steps(p) for p in (node.parts if isinstance(node, Chain) else node.branches)]
    if isinstance(node, Chain):
        return reduce(lambda n, p: n * p[0], parts, 1), sum(p[1] for p in parts)
    return sum(p[0] for p in parts), max(p[1] for p in parts)


def _jvm(node) -> str:
    if isinstance(node, (One, Place)):
        return node.jvm
    if isinstance(node, Repeat):
        return _jvm(node.part) + node.jvm
    if isinstance(node, Chain):
        return "".join(map(_jvm, node.parts))
    return f"(?:{'|'.join(map(_jvm, node.branches))})"


def to_jvm(pattern: str) -> str | None:
    """The same pattern for ``rlike``, or None.

    Given only where every place of a text is left after a bounded number of steps: no open repeat, no
    repeated group, and few ways in all. So the time is in proportion to the text, whatever it holds.
    """
    tree = parse(pattern)
    if tree is None:
        return None
    ways, length = _steps(tree)
    return _jvm(tree) if ways * max(1, length) <= MAX_STEPS else None


# Texts that a part can match, if these are few, and sets of literals of each of which a match holds one.
_Found = tuple[frozenset[str] | None, list[frozenset[str]]]


def _needs(found: _Found) -> list[frozenset[str]]:
    texts, sets = found
    return [texts, *sets] if texts and "" not in texts else sets


def _literals(node) -> _Found:
    if isinstance(node, One):
        return node.chars, []
    if isinstance(node, Place):
        return frozenset([""]), []
    if isinstance(node, Repeat):
        texts, sets = found = _literals(node.part)
        if node.low == 0:
            return (texts | {""} if texts is not None and node.high == 1 else None), []
        return (texts if node.low == node.high == 1 else None), _needs(found) if node.high != 1 else sets
    if isinstance(node, Choice):
        found = [_literals(b) for b in node.branches]
        if len(found) == 1:
            return found[0]
        if all(texts is not None for texts, _ in found):
            texts = frozenset().union(*(t for t, _ in found))
            if len(texts) <= MAX_LITERALS:
                return texts, []
        needs = [_needs(f) for f in found]
        if not all(needs):
            return None, []
        # Of each branch the set whose shortest literal is longest.
        one = frozenset().union(*(max(n, key=lambda s: (min(map(len, s)), -len(s))) for n in needs))
        return None, [one] if len(one) <= MAX_LITERALS else []
    run, sets, whole = frozenset([""]), [], True
    for part in node.parts:
        texts, inner = _literals(part)
        sets += inner
        if texts is not None and len(run) * len(texts) <= MAX_LITERALS:
            run = frozenset(a + b for a in run for b in texts)
            continue
        sets += _needs((run, []))
        run, whole = texts if texts is not None else frozenset([""]), False
    if whole:
        return run, sets
    return None, sets + _needs((run, []))


def needed_literals(pattern: str) -> list[frozenset[str]]:
    """Sets of literals; a text that the pattern matches holds one of every set. Empty: nothing known."""
    tree = parse(pattern)
    return [] if tree is None else list(dict.fromkeys(_needs(_literals(tree))))
