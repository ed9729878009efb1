"""Hierarchical multi-length packing (free style: Arrow batches, no shuffle).

Every document is tokenised and closed by an end id. Whole windows are cut off its front; the
rest (for most documents: all of it) is routed to the smallest context-size tier it fits in.
Windows are then packed tier by tier, from the longest: a window starts with the longest waiting
piece of its tier, and its gap is filled from pieces of this and the shorter tiers, always the
longest that fits; the last one is cut to the gap and its remainder waits in a shorter tier. So
short tiers get windows of their own only from what no longer window has taken, and every window
but the last of a partition is full at the length of its tier.

Sequences of one tier are dealt into step groups of ``step_tokens`` tokens each, so all groups
are equally long, but for the last of each tier and input partition.

Every input partition is packed by itself while it streams by, so memory holds one batch and at
most ``pool`` waiting pieces. Each partition pads at most one window. Sequence and group numbers
carry the partition number, so a recomputed partition gives the same numbers.

Results: null or empty text is the end id alone. Rows with the same ``doc_id`` are packed as
documents of their own. Other columns of the input are ignored. An empty table gives no pieces.
"""

from __future__ import annotations

import base64
import bisect
import functools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

WINDOW = 1024
SMALLEST = 128
STEP_TOKENS = 8 * WINDOW
# Pieces that may wait for a window; when there are more, a window is packed.
POOL = 4096
SCHEMA = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint,"
    " sequence_id bigint, offset bigint, tier int, step_group bigint"
)
_NUMBER_BITS = 38


class Encoder:
    """Ids of a byte-level BPE file, by its rank table where that gives the same ids faster."""

    def __init__(self, tokenizer: str, ranks: str | None, pattern: str | None):
        self.exact = Tokenizer.from_file(tokenizer)
        self.special = [t.content for t in self.exact.get_added_tokens_decoder().values()]
        self.fast = None
        if ranks and pattern:
            with open(ranks, "rb") as lines:
                table = {base64.b64decode(p): int(r) for p, r in (line.split() for line in lines if line.strip())}
            self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})

    def __call__(self, text: str) -> list[int]:
        if self.fast is None or any(s in text for s in self.special):
            return self.exact.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)


@functools.cache
def _encoder(tokenizer: str, ranks: str | None, pattern: str | None) -> Encoder:
    return Encoder(tokenizer, ranks, pattern)


class Packer:
    """Packs the pieces of one partition; ``rows`` gathers what is placed."""

    def __init__(self, base: int, window: int, smallest: int, step_tokens: int, pool: int):
        self.window, self.smallest, self.step_tokens, self.limit = window, smallest, step_tokens, pool
        self.base, self.sequences, self.groups = base, 0, 0
        self.room: dict[int, tuple[int, int]] = {}  # length → open step group, sequences left in it
        self.waiting: dict[int, list[tuple]] = {}  # length → pieces (doc, start, ids, doc_tokens)
        self.lengths: list[int] = []  # of the waiting pieces, ascending
        self.n_waiting = 0
        self.rows: list[tuple] = []

    def document(self, doc_id, ids: np.ndarray) -> None:
        start, total = 0, len(ids)
        while total - start >= self.window:
            self._sequence([(doc_id, start, ids[start : start + self.window], total)], self.window)
            start += self.window
        if start < total:
            self._wait(doc_id, start, ids[start:], total)
        while self.n_waiting > self.limit:
            self._fill(self._tier(self.lengths[-1]))

    def finish(self) -> None:
        """Pack what waits; pieces that fill no tier any more share windows of full size."""
        while self.n_waiting:
            tier = self._tier(self.lengths[-1])
            left = sum(size * len(pieces) for size, pieces in self.waiting.items()) if self.n_waiting < 64 else tier
            self._fill(tier if left >= tier else self.window)

    def _tier(self, length: int) -> int:
        tier = self.smallest
        while tier < length:
            tier *= 2
        return tier

    def _wait(self, doc_id, start: int, ids: np.ndarray, total: int) -> None:
        size = len(ids)
        if size not in self.waiting:
            self.waiting[size] = []
            bisect.insort(self.lengths, size)
        self.waiting[size].append((doc_id, start, ids, total))
        self.n_waiting += 1

    def _fill(self, tier: int) -> None:
        gap, pieces = tier, []
        while gap and self.n_waiting:
            # The longest that fits; where none does, the shortest, cut to the gap.
            at = max(bisect.bisect_right(self.lengths, gap) - 1, 0)
            size = self.lengths[at]
            doc_id, start, ids, total = self.waiting[size].pop()
            if not self.waiting[size]:
                del self.waiting[size], self.lengths[at]
            self.n_waiting -= 1
            if size > gap:
                self._wait(doc_id, start + gap, ids[gap:], total)
                ids = ids[:gap]
            pieces.append((doc_id, start, ids, total))
            gap -= len(ids)
        self._sequence(pieces, tier)

    def _sequence(self, pieces: list[tuple], tier: int) -> None:
        group, left = self.room.get(tier, (0, 0))
        if not left:
            group, left = self.groups, max(1, self.step_tokens // tier)
            self.groups += 1
        self.room[tier] = (group, left - 1)
        offset = 0
        for doc_id, start, ids, total in pieces:
            self.rows.append(
                (doc_id, start, len(ids), zlib.crc32(ids.tobytes()), total,
                 self.base + self.sequences, offset, tier, self.base + group)
            )
            offset += len(ids)
        self.sequences += 1

    def take(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows)) or [[]] * 9
        self.rows = []
        kinds = [pa.int64()] * 7 + [pa.int32(), pa.int64()]
        names = [part.split()[0] for part in SCHEMA.split(",")]
        return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def pack(
    docs: DataFrame,
    tokenizer: str,
    ranks: str | None = None,
    pattern: str | None = None,
    end_id: int = 0,
    window: int = WINDOW,
    smallest: int = SMALLEST,
    step_tokens: int = STEP_TOKENS,
    pool: int = POOL,
) -> DataFrame:
    """One row per piece: where it lies in its document and in its sequence.

    ``window`` and ``smallest`` are powers of two. ``tokenizer`` is a file every executor can
    open; ``ranks`` and ``pattern`` may name the same vocabulary as a rank table.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(tokenizer, ranks, pattern)
        partition = TaskContext.get().partitionId()
        packer = Packer(partition << _NUMBER_BITS, window, smallest, step_tokens, pool)
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                ids = encode(text) if text else []
                packer.document(doc_id, np.array([*ids, end_id], dtype="<u4"))
                if len(packer.rows) > 20_000:
                    yield packer.take()
        packer.finish()
        yield packer.take()

    return docs.selectExpr("cast(doc_id as bigint) doc_id", "cast(text as string) text").mapInArrow(work, SCHEMA)
