"""Secret scans by character Markov models (free style: Arrow batches, one small aggregation).

Rules find the known shapes: values assigned to a telling name, access keys, long hexadecimal runs. Beyond
them, every token of ``min_length`` or more characters is scored by two Markov models of first order over
its characters, one of random strings and one of ordinary identifiers: the sum over the characters of
log P(character | one before) under the first, less that under the second. A token with ``min_ratio``
or more is a secret. Either model mixes the shares that it has counted with even odds over all
characters, by a fixed weight, so the ratios do not depend on how large the samples are.

The models are trained from labelled samples, rows of (text, spans): characters inside a span belong to
random strings, all others to ordinary identifiers. ``label_by_rules`` labels documents by the rules;
hand-made labels do as well. Pairs are counted in every task and summed: two tables of 67 by 67 numbers,
whatever the size of the corpus. Scanning needs no shuffle.

All texts of a slice are searched as one run of bytes, in which a line feed keeps neighbours apart (no rule and
no token takes one). Memory holds some ten bytes for each byte of a slice; a text longer than
a slice is one of its own and is never cut.

Results: null and empty texts have no spans. Spans are in code points, end exclusive. A token that lies within
a rule's span is not reported again. Repeated rows and identifiers are scanned each. With nothing learned
no token has a ratio, and the rules alone report. Other columns are ignored; an empty table gives none.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlake.llm.common import blocks

# The rules, and how long what they find must be (of an assignment its value).
ASSIGN = re.compile(
    rb"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]+")
ASSIGN_LENGTH, ACCESS_LENGTH, HEX_LENGTH = 6, 20, 24

KINDS = ["assign", "access", "hex", "markov"]
MIN_LENGTH = 16
MIN_RATIO = 12.0  # natural logarithm: e**12 to one for a random string
# Share of even odds in each model: labelled secrets are of a few kinds, a random string of any.
RANDOM_EVEN, ORDINARY_EVEN = 0.5, 0.01
_SIGNS = b"+/_=-"
_LETTERS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789" + _SIGNS
_SYMBOLS = len(_LETTERS) + 1  # 0: not part of a token
_CODE = np.zeros(256, np.uint8)
_CODE[list(_LETTERS)] = np.arange(1, _SYMBOLS)
_IS_HEX = np.zeros(256, bool)
_IS_HEX[list(b"0123456789abcdef")] = True
SPAN = "struct<kind:string,start:bigint,end:bigint,ratio:double>"
SCHEMA = f"doc_id bigint, spans array<{SPAN}>"


@dataclass
class Models:
    """Pair counts of random strings and ordinary identifiers, each (symbol before, symbol)."""

    random: np.ndarray
    ordinary: np.ndarray

    def ratios(self, random_even: float = RANDOM_EVEN, ordinary_even: float = ORDINARY_EVEN) -> np.ndarray:
        """log P(symbol | one before) of random strings less that of ordinary identifiers."""
        logs = []
        for counts, even in ((self.random, random_even), (self.ordinary, ordinary_even)):
            total = counts[:, 1:].sum(axis=1, keepdims=True)
            share = np.divide(counts[:, 1:], total, out=np.full_like(counts[:, 1:], 1 / (_SYMBOLS - 1)), where=total > 0)
            logs.append(np.log((1 - even) * share + even / (_SYMBOLS - 1)))
        out = np.hstack([np.zeros((_SYMBOLS, 1)), logs[0] - logs[1]]).astype(np.float32)
        # A sign next to something with which neither sample has it decides nothing.
        unseen = (self.random == 0) & (self.ordinary == 0)
        unseen[: -len(_SIGNS), : -len(_SIGNS)] = False
        out[unseen] = 0
        return out


def _runs(inside: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of the runs of ``least`` or more true values."""
    edges = np.diff(np.concatenate([[0], inside.view(np.int8), [0]]))
    first, last = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    long = last - first >= least
    return first[long], last[long]


def rule_spans(data: bytes) -> list[tuple[int, int, int]]:
    """(start, end, number of the kind) of what the rules find, by start and kind."""
    found = [(m.start(), m.end(), 0) for m in ASSIGN.finditer(data) if len(m[2]) >= ASSIGN_LENGTH]
    found += [(m.start(), m.end(), 1) for m in ACCESS.finditer(data) if len(m[0]) >= ACCESS_LENGTH]
    # A match of the third rule is a whole run of its characters.
    first, last = _runs(_IS_HEX[np.frombuffer(data, np.uint8)], HEX_LENGTH)
    found += [(a, b, 2) for a, b in zip(first.tolist(), last.tolist())]
    return sorted(found, key=lambda s: (s[0], s[2]))


def token_ratios(data: bytes, ratios: np.ndarray, min_length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and log likelihood ratio of every token of ``min_length`` or more characters."""
    codes = _CODE[np.frombuffer(data, np.uint8)]
    first, last = _runs(codes > 0, min_length)
    if not len(first):
        return first, last, np.empty(0)
    sizes = last - first
    starts = np.cumsum(sizes) - sizes
    at = np.arange(sizes.sum()) + np.repeat(first - starts, sizes)
    symbols = codes[at]
    before = np.concatenate([[0], symbols[:-1]])
    before[starts] = 0
    return first, last, np.add.reduceat(ratios[before, symbols].astype(np.float64), starts)


def count_pairs(data: bytes, spans: list[tuple[int, int]]) -> np.ndarray:
    """Pairs inside the spans and outside of them: (2, symbols, symbols).

    The first character of a token, or of a part of it inside or outside, follows symbol 0.
    """
    codes = _CODE[np.frombuffer(data, np.uint8)].astype(np.int64)
    inside = np.zeros(len(codes) + 1, np.int8)
    for a, b in spans:
        inside[a:b] = 1
    inside = inside[:-1].astype(np.int64)
    before = np.concatenate([[0], codes[:-1]])
    before[1:][inside[1:] != inside[:-1]] = 0
    real = codes > 0
    index = (inside * _SYMBOLS + before) * _SYMBOLS + codes
    out = np.bincount(index[real], minlength=2 * _SYMBOLS * _SYMBOLS).reshape(2, _SYMBOLS, _SYMBOLS)
    return out[::-1]


def _secret_part(data: bytes, span: tuple[int, int, int]) -> tuple[int, int]:
    """Where the random string of a rule's span lies: an assignment's value, all of the others."""
    start, end, kind = span
    return ASSIGN.match(data, start, end).span(2) if kind == 0 else (start, end)


def label_by_rules(data: bytes) -> list[tuple[int, int]]:
    return [_secret_part(data, s) for s in rule_spans(data)]


def train(docs: DataFrame, label=label_by_rules) -> Models:
    """Models of all texts of ``docs``; ``label`` gives the spans of random strings in a run of bytes,
    which may hold several texts."""
    size = 2 * _SYMBOLS * _SYMBOLS

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, _SYMBOLS, _SYMBOLS), np.int64)
        for _, texts in blocks(batches):
            data = b"\n".join(texts)
            counts += count_pairs(data, label(data))
        flat = counts.ravel()
        cells = np.flatnonzero(flat)
        yield pa.record_batch([pa.array(cells.astype(np.int32)), pa.array(flat[cells])], names=["cell", "n"])

    rows = docs.select(F.col("text").cast("string")).mapInArrow(work, "cell int, n bigint")
    counts = np.zeros(size, np.float64)
    for r in rows.groupBy("cell").agg(F.sum("n").alias("n")).collect():
        counts[r["cell"]] = r["n"]
    random, ordinary = counts.reshape(2, _SYMBOLS, _SYMBOLS)
    return Models(random, ordinary)


def scan_texts(texts: list[bytes], ratios: np.ndarray, min_length: int, min_ratio: float) -> list[list[tuple]]:
    """The spans (kind, start, end, ratio) of each text, in code points, by start and kind."""
    data = b"\n".join(texts)
    found = [(a, b, k, None) for a, b, k in rule_spans(data)]
    first, last, ratio = token_ratios(data, ratios, min_length)
    ruled = sorted((a, b) for a, b, _, _ in found)
    starts = np.array([a for a, _ in ruled], np.int64)
    reach = np.maximum.accumulate(np.array([b for _, b in ruled], np.int64)) if ruled else starts
    for i in np.flatnonzero(ratio >= min_ratio).tolist():
        a, b = int(first[i]), int(last[i])
        at = int(np.searchsorted(starts, a, side="right"))
        if not at or reach[at - 1] < b:
            found.append((a, b, 3, float(ratio[i])))
    out: list[list[tuple]] = [[] for _ in texts]
    if not found:
        return out
    begins = np.cumsum([0, *(len(t) + 1 for t in texts)])[:-1]
    owners = np.searchsorted(begins, [f[0] for f in found], side="right") - 1
    reached: dict[int, tuple[int, int]] = {}  # text → place so far in bytes and in characters
    for owner, (a, b, kind, score) in sorted(zip(owners.tolist(), found), key=lambda x: (x[1][0], x[1][2])):
        at, chars = reached.get(owner, (0, 0))
        place = a - int(begins[owner])
        start = chars + len(texts[owner][at:place].decode(errors="replace"))
        reached[owner] = place, start
        out[owner].append((KINDS[kind], start, start + b - a, score))
    return out


def scan(
    docs: DataFrame, models: Models, min_length: int = MIN_LENGTH, min_ratio: float = MIN_RATIO
) -> DataFrame:
    """``doc_id`` and the array of ``spans`` of every row."""
    ratios = models.ratios()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("ratio", pa.float64())]))
        for batch, texts in blocks(batches):
            spans = [
                [dict(zip(("kind", "start", "end", "ratio"), s)) for s in row]
                for row in scan_texts(texts, ratios, min_length, min_ratio)
            ]
            yield pa.record_batch([batch.column("doc_id"), pa.array(spans, kind)], names=["doc_id", "spans"])

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(work, SCHEMA)


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of an array of spans, joined by commas."""
    one = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(one, ",")
