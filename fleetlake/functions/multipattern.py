"""Many RE2 patterns over a column in about one pass, in Arrow batches.

Literals that the patterns need (re2.py) are looked for all at once, by one automaton over the whole
batch. RE2 itself runs only on rows that hold what a pattern needs; its time is in proportion to the text for any
pattern, so neither a hostile text nor a caller's pattern can hang a scan.
"""

from __future__ import annotations

import functools

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlake.functions.re2 import needed_literals

# Between the texts of a batch stands a character that no literal holds.
_SEPARATORS = "\n\0\1\2\3\4\5\6\7"


class MultiPattern:
    """Which of ``patterns`` match the texts of a batch."""

    def __init__(self, patterns: tuple[str, ...]):
        self.patterns = patterns
        needs = [needed_literals(p) for p in patterns]
        literals = sorted({x for sets in needs for s in sets for x in s})
        held = set("".join(literals))
        self.separator = next((c for c in _SEPARATORS if c not in held), None)
        if self.separator is None:
            literals, needs = [], [[] for _ in patterns]
        number = {x: i for i, x in enumerate(literals)}
        # Per pattern: sets of literal numbers, of each of which one has to occur.
        self.needs = [[[number[x] for x in s] for s in sets] for sets in needs]
        self.count = len(literals)
        self.automaton = ahocorasick.Automaton()
        for x, i in number.items():
            self.automaton.add_word(x, i)
        if literals:
            self.automaton.make_automaton()

    def holds(self, texts: pa.Array) -> np.ndarray:
        """Whether a literal (first index) occurs in a text (second index)."""
        found = np.zeros((self.count, len(texts)), bool)
        if not self.count:
            return found
        whole = self.separator.join(texts.to_pylist())
        hits = np.fromiter((x for hit in self.automaton.iter(whole) for x in hit), np.int64).reshape(-1, 2)
        ends = np.cumsum(pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
        found[hits[:, 1], np.searchsorted(ends, hits[:, 0], side="right")] = True
        return found

    def __call__(self, values: pa.Array) -> np.ndarray:
        """Whether a pattern (first index) matches a text (second index); a null matches none."""
        texts = pc.fill_null(values, "")
        present = pc.is_valid(values).to_numpy(zero_copy_only=False)
        found = self.holds(texts)
        out = np.zeros((len(self.patterns), len(texts)), bool)
        for i, pattern in enumerate(self.patterns):
            rows = present.copy()
            for one_of in self.needs[i]:
                rows &= found[one_of].any(axis=0)
            at = np.flatnonzero(rows)
            if len(at):
                tried = texts if len(at) == len(texts) else texts.take(pa.array(at))
                out[i, at] = pc.match_substring_regex(tried, pattern).to_numpy(zero_copy_only=False)
        return out


@functools.lru_cache(maxsize=16)
def _compiled(patterns: tuple[str, ...]) -> MultiPattern:
    return MultiPattern(patterns)


def which_match(c: Column, patterns: list[str]) -> Column:
    """Array of booleans, one per pattern, in one pass; null text gives falses."""
    wanted = tuple(patterns)

    def scan(values):
        flags = _compiled(wanted)(values).T.ravel()
        offsets = pa.array(np.arange(len(values) + 1, dtype=np.int32) * len(wanted))
        return pa.ListArray.from_arrays(offsets, pa.array(flags))

    # ArrowEvalPython hands over plain Arrow arrays.
    scan.__annotations__ = {"values": pa.Array, "return": pa.Array}
    return F.arrow_udf(scan, T.ArrayType(T.BooleanType()))(c)
