"""JSON lists that are too large for one task, read in parallel.

A list is read in pieces between commas, which Spark splits over tasks wherever the commas stand: in a
string, in an item or between items. Tasks gather the pieces to blocks of about a megabyte and note of
each block how it changes the state of the reader: whether a string is open, which its quotes tell,
and how deep brackets are nested, for either case of a string being open where it begins. Sums over the
blocks before then give the state in which each block begins, and with it any task finds the commas
between items in its own blocks. The two ends of a block are parts of items that the neighbours
share; those parts are the only text that is shuffled.

What is no list fails the read, as it does for a small file. One fault goes unseen: a comma that is the
very last character of a file, behind the list.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fleetlake.sources.scratch import stored

BLOCK_BYTES = 1 << 20
# States of blocks sent to every executor: at most this many rows (some 50 bytes each).
MAX_BROADCAST_BLOCKS = 1_000_000

_ESCAPE = re.compile(rb"\\.", re.S)
_OPEN, _CLOSE = frozenset(b"[{"), frozenset(b"]}")
_STEP = np.zeros(256, np.int8)
_STEP[list(_OPEN)] = 1
_STEP[list(_CLOSE)] = -1
_BLANK = b" \t\r\n"
# What stands before and after a part of an item: the list's brackets, a comma, or the block's end.
_BEGIN, _COMMA, _END, _CUT = "[", ",", "]", "-"
_BLOCKS = "file string, split bigint, block int, text string, quotes bigint, outside bigint, inside bigint, brackets bigint"
_PARTS = "file string, split bigint, block int, part int, text string, before string, after string"


class ListError(ValueError):
    def __init__(self, text: bytes):
        super().__init__(f"Expected a list of messages, got: {text[:80].decode(errors='replace')}")


@dataclass
class Marks:
    """Where quotes and brackets stand in a block, escaped characters left out."""

    data: np.ndarray
    odd: np.ndarray  # whether an odd number of quotes stands before a byte or at it
    step: np.ndarray

    @classmethod
    def of(cls, text: bytes) -> Marks:
        # A character after a backslash is neither a quote nor a bracket.
        data = np.frombuffer(_ESCAPE.sub(b"xx", text), np.uint8)
        odd = np.cumsum(data == ord('"'), dtype=np.int64) % 2 == 1
        return cls(data, odd, _STEP[data])

    def change(self) -> tuple[int, int, int, int]:
        """Quotes, change of depth if no string is open at the front or if one is, brackets in all."""
        quotes = int((self.data == ord('"')).sum())
        return quotes, int(self.step[~self.odd].sum()), int(self.step[self.odd].sum()), int(np.abs(self.step).sum())


def _blocks(pieces: DataFrame) -> DataFrame:
    """Consecutive pieces of a split as rows of about ``BLOCK_BYTES``, with what they change."""

    def row(place: tuple[str, int], number: int, texts: list[str]) -> tuple:
        text = ",".join(texts)
        return (*place, number, text, *Marks.of(text.encode()).change())

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, number, texts, size = None, 0, [], 0
        for batch in batches:
            rows = []
            for *at, text in zip(*(batch.column(c).to_pylist() for c in ("file", "split", "value"))):
                if place != tuple(at) or size > BLOCK_BYTES:
                    if texts:
                        rows.append(row(place, number, texts))
                    number = number + 1 if place == tuple(at) else 0
                    place, texts, size = tuple(at), [], 0
                texts.append(text)
                size += len(text) + 1
            yield _record_batch(rows, _BLOCKS)
        if texts:
            yield _record_batch([row(place, number, texts)], _BLOCKS)

    return pieces.mapInArrow(work, _BLOCKS)


def _record_batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32()}
    fields = [field.split() for field in schema.split(", ")]
    columns = list(zip(*rows)) if rows else [()] * len(fields)
    return pa.record_batch([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields)], names=[n for n, _ in fields])


def _states(blocks: DataFrame) -> DataFrame:
    """``in_string``, ``depth`` and ``earlier`` brackets at the front of each block, and ``last``."""
    order = W.partitionBy("file").orderBy("split", "block")
    before = order.rowsBetween(W.unboundedPreceding, -1)
    zero = F.lit(0).cast("bigint")
    narrow = blocks.select("file", "split", "block", "quotes", "outside", "inside", "brackets").withColumn(
        "in_string", F.coalesce(F.sum("quotes").over(before), zero) % 2 == 1
    )
    step = F.when(F.col("in_string"), F.col("inside")).otherwise(F.col("outside"))
    return narrow.withColumn("step", step).select(
        "file", "split", "block", "in_string",
        F.coalesce(F.sum("step").over(before), zero).alias("depth"),
        F.coalesce(F.sum("brackets").over(before), zero).alias("earlier"),
        F.lead("block").over(order).isNull().alias("last"),
    )


def parts_of(text: bytes, in_string: bool, depth: int, opened: bool, last: bool) -> list[tuple[bytes, str, str]]:
    """The parts of items in a block: text, what stands before it and what after."""
    marks = Marks.of(text)
    outside = marks.odd == in_string  # neither in a string nor a closing quote
    step = np.where(outside, marks.step, 0)
    deep = depth + np.cumsum(step, dtype=np.int64)
    start, before = 0, _CUT
    if not opened:
        start = len(text) - len(text.lstrip(_BLANK))
        if start == len(text):
            if last:
                raise ListError(text)
            return []
        if text[start : start + 1] != b"[":
            raise ListError(text)
        start, before = start + 1, _BEGIN
    elif depth == 0:
        if text.strip(_BLANK):
            raise ListError(text)
        return []
    ends = np.flatnonzero((deep == 0) & (step == -1))
    end = int(ends[0]) if len(ends) else len(text)
    if len(ends) and (text[end : end + 1] != b"]" or text[end + 1 :].strip(_BLANK)) or last and not len(ends):
        raise ListError(text)
    commas = np.flatnonzero((marks.data == ord(",")) & outside & (deep == 1))
    cuts = [c for c in commas.tolist() if start <= c < end] + [end]
    out = []
    for cut in cuts:
        after = _COMMA if cut < end else _END if len(ends) else _CUT
        out.append((text[start:cut], before, after))
        start, before = cut + 1, _COMMA
    return out


def _parts(blocks: DataFrame) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                text = r["text"].encode()
                # Between two blocks stands the comma that parted their pieces.
                if not (r["split"] == 0 and r["block"] == 0):
                    text = b"," + text
                found = parts_of(text, r["in_string"], r["depth"], r["earlier"] > 0, r["last"])
                rows += [(r["file"], r["split"], r["block"], i, t.decode(), b, a) for i, (t, b, a) in enumerate(found)]
            yield _record_batch(rows, _PARTS)

    return blocks.mapInArrow(work, _PARTS)


def _item(text: Column, before: Column, after: Column) -> Column:
    """The items (none or one) of the text between two ends: the blank of an empty list is none."""
    blank = F.trim(F.translate(text, "\t\r\n", "   ")) == ""
    parsed = F.from_json(F.concat(F.lit("["), text, F.lit("]")), "array<string>")
    fault = F.raise_error(F.concat(F.lit("Expected a list of messages, got: "), F.substring(text, 1, 80)))
    empty_list = blank & (before == _BEGIN) & (after == _END)
    return F.when(empty_list, F.array().cast("array<string>")).when(~blank & (F.size(parsed) == 1), parsed).otherwise(
        fault.cast("array<string>")
    )


def read_large_lists(spark: SparkSession, path: str, more_than: int) -> DataFrame | None:
    """The items (``raw``) of the files of more than ``more_than`` bytes below ``path``, each of which holds
    one JSON list; None if there are none. The text is read here and stored in blocks."""
    pieces = (
        spark.read.option("lineSep", ",").text(path)
        .where(F.col("_metadata.file_size") > more_than)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("split"),
            "value",
        )
    )
    if pieces.limit(1).isEmpty():
        return None
    blocks = stored(_blocks(pieces), "list-blocks")
    states = stored(_states(blocks), "list-states")
    if states.count() <= MAX_BROADCAST_BLOCKS:
        states = F.broadcast(states)
    placed = blocks.select("file", "split", "block", "text").join(states, ["file", "split", "block"])
    parts = stored(_parts(placed), "list-parts")
    whole = (F.col("before") != _CUT) & (F.col("after") != _CUT)
    # Parts of one item follow one another, from one that begins it. They are numbered without their text.
    place = ["file", "split", "block", "part"]
    begun = F.sum((F.col("before") != _CUT).cast("int")).over(W.partitionBy("file").orderBy(*place[1:]))
    shared = parts.where(~whole)
    numbers = shared.select(*place, begun.alias("item"))
    joined = shared.join(numbers, place).groupBy("file", "item").agg(
        F.array_join(F.array_sort(F.collect_list(F.struct("split", "block", "part", "text")))["text"], "").alias("text"),
        F.max(F.when(F.col("before") != _CUT, F.col("before"))).alias("before"),
        F.max(F.when(F.col("after") != _CUT, F.col("after"))).alias("after"),
    )
    items = parts.where(whole).select("text", "before", "after").unionByName(joined.select("text", "before", "after"))
    return items.select(F.explode(_item(F.col("text"), F.col("before"), F.col("after"))).alias("raw"))
