"""Fill-in-middle transformation with pyarrow.compute (free style: Arrow batches, no shuffle).

A text is cut into lines that keep their newline. Two cut points between the lines, drawn from a
hash of the identifier, give prefix, middle and suffix, which are written behind marks in the order
prefix, suffix, middle (``psm``) or suffix, prefix, middle (``spm``). Texts without a line, texts that
hold a mark, and those that the rate leaves out stay as they are (``plain``).

All texts of a slice are worked on at once: they are split into one list array, flattened with the
indices of their parents, numbered within the parent, given a role by that number, filtered by role,
rebuilt as lists and joined. Nothing is done per row in Python, and nothing is shuffled, so a hot
source or a large group of copies is work like any other. Memory holds a few copies of a slice of
``BLOCK_BYTES``; a longer text is a slice of its own and is never cut.

Results: null and empty texts are plain and have no lines; their output is empty. A null identifier
hashes like an empty one. Rows with one identifier have the same draws, whatever their order; equal
cut points leave the middle empty. An empty table gives an empty result, other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlake.llm.common import BLOCK_BYTES

# Marks in front of prefix, suffix and middle.
MARKS = ("<P>", "<S>", "<M>")
PLAIN, PSM, SPM = "plain", "psm", "spm"
_PREFIX, _MIDDLE, _SUFFIX = 0, 1, 2
_DRAWS = 4
NAMES = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output", "restored"]
SCHEMA = "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string, restored string"


def draw(seed: int, doc_id: Column, number: int) -> Column:
    """The ``number``-th group of eight digits of the hash of seed and identifier."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    return F.conv(F.substring(digest, 8 * number + 1, 8), 16, 10).cast("bigint")


def _modulo(value: pa.Array, by) -> pa.Array:
    return pc.subtract(value, pc.multiply(pc.divide(value, by), by))


def lines(texts: pa.Array) -> tuple[pa.Array, pa.Array, pa.Array, pa.Array]:
    """Lines of all texts: line, index of its text, its number within the text; lines per text."""
    pieces = pc.split_pattern(texts, "\n")
    parent, piece = pc.list_parent_indices(pieces), pc.list_flatten(pieces)
    sizes = pc.cast(pc.list_value_length(pieces), pa.int64())
    ends = pc.cumulative_sum(sizes)
    number = pc.subtract(pa.array(np.arange(len(piece))), pc.take(pc.subtract(ends, sizes), parent))
    # Behind the last newline is a line only if something stands there.
    last = pc.equal(number, pc.subtract(pc.take(sizes, parent), 1))
    closed = pc.binary_join_element_wise(piece, pc.if_else(last, "", "\n"), "")
    real = pc.greater(pc.binary_length(closed), 0)
    open_end = pc.not_equal(pc.binary_length(pc.take(piece, pc.subtract(ends, 1))), 0)
    counts = pc.subtract(sizes, pc.if_else(open_end, 0, 1))
    return closed.filter(real), parent.filter(real), number.filter(real), counts


def _rebuilt(values: pa.Array, counts: pa.Array) -> pa.Array:
    """Consecutive runs of ``counts`` values, each joined into one."""
    offsets = pa.array(np.concatenate([[0], np.cumsum(counts.to_numpy(zero_copy_only=False))]), pa.int32())
    return pc.binary_join(pa.ListArray.from_arrays(offsets, values), "")


def transform(
    texts: pa.Array, draws: list[pa.Array], fim_rate: int, spm_rate: int, marks: tuple[str, str, str] = MARKS
) -> tuple[pa.Array, pa.Array, pa.Array, pa.Array, pa.Array]:
    """Lines, form, characters of prefix and of middle, and output of each text (none is null)."""
    line, parent, number, n = lines(texts)
    one, other = (_modulo(h, pc.add(n, 1)) for h in draws[:2])
    low, high = pc.min_element_wise(one, other), pc.max_element_wise(one, other)
    role = pc.if_else(
        pc.less(number, pc.take(low, parent)),
        _PREFIX,
        pc.if_else(pc.less(number, pc.take(high, parent)), _MIDDLE, _SUFFIX),
    )
    sizes = {_PREFIX: low, _MIDDLE: pc.subtract(high, low), _SUFFIX: pc.subtract(n, high)}
    prefix, middle, suffix = (_rebuilt(line.filter(pc.equal(role, r)), c) for r, c in sizes.items())

    plain = pc.or_(pc.equal(n, 0), pc.greater_equal(_modulo(draws[2], 100), fim_rate))
    for mark in marks:
        plain = pc.or_(plain, pc.match_substring(texts, mark))
    spm = pc.less(_modulo(draws[3], 100), spm_rate)
    form = pc.if_else(plain, PLAIN, pc.if_else(spm, SPM, PSM))
    marked = pc.binary_join_element_wise(
        pc.if_else(spm, marks[1], marks[0]),
        pc.if_else(spm, suffix, prefix),
        pc.if_else(spm, marks[0], marks[1]),
        pc.if_else(spm, prefix, suffix),
        marks[2],
        middle,
        "",
    )
    chars = (
        pc.if_else(plain, pa.scalar(None, pa.int64()), pc.cast(pc.utf8_length(x), pa.int64())) for x in (prefix, middle)
    )
    return n, form, *chars, pc.if_else(plain, texts, marked)


def check_marks(marks: tuple[str, str, str]) -> None:
    """Marks must be told apart wherever pieces meet: none overlaps or holds another."""
    for i, a in enumerate(marks):
        for j, b in enumerate(marks):
            overlaps = any(b.startswith(a[k:]) for k in range(1, len(a)))
            if not a or overlaps or (i != j and a in b):
                raise ValueError(f"marks {marks} cannot be told apart")


def restore(outputs: pa.Array, forms: pa.Array, marks: tuple[str, str, str] = MARKS) -> pa.Array:
    """The texts again, from outputs and forms alone.

    A masked text holds no mark, and none can arise where a piece and a mark meet, so a masked
    output falls into nothing, two pieces in the order of its form, and the middle.
    """
    masked = pc.not_equal(forms, PLAIN)
    pieces = pc.split_pattern_regex(outputs.filter(masked), "|".join(map(re.escape, marks)))
    one, two, middle = (pc.list_element(pieces, i) if len(pieces) else outputs[:0] for i in (1, 2, 3))
    spm = pc.equal(forms.filter(masked), SPM)
    texts = pc.binary_join_element_wise(pc.if_else(spm, two, one), middle, pc.if_else(spm, one, two), "")
    return pc.replace_with_mask(outputs, masked, texts)


def _slices(batches: Iterator[pa.RecordBatch], limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about ``limit`` bytes of text."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(at, to - at)
            at = to


def fill_in_middle(
    docs: DataFrame,
    seed: int = 7,
    fim_rate: int = 100,
    spm_rate: int = 50,
    marks: tuple[str, str, str] = MARKS,
) -> DataFrame:
    """One row per document: lines, form, sizes of prefix and middle (null if plain), the output,
    and the text restored from it. Rates are in per cent: of masked texts, and of those in ``spm``."""
    check_marks(marks)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _slices(batches):
            texts = pc.fill_null(pc.cast(part.column("text"), pa.string()), "")
            draws = [part.column(f"h{i}") for i in range(_DRAWS)]
            n, form, prefix, middle, output = transform(texts, draws, fim_rate, spm_rate, marks)
            columns = [part.column("doc_id"), n, form, prefix, middle, output, restore(output, form, marks)]
            yield pa.record_batch(columns, names=NAMES)

    drawn = [draw(seed, F.col("doc_id"), i).alias(f"h{i}") for i in range(_DRAWS)]
    narrow = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"), *drawn)
    return narrow.mapInArrow(work, SCHEMA)
