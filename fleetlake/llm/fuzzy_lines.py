"""Fuzzy line deduplication by blocks of words (free style: Arrow batches and joins).

Lines are cut at newlines and normalised: A-Z in lower case, digits to 0, ASCII punctuation to
space, words joined by one space. Equal normalised lines are one item. Two items are linked when
the edit similarity of their words (1 - edit distance / words of the longer) is at least
``similarity``.

Which items meet is a matter of the pigeonhole principle: ``e`` edits cannot break ``e + 1`` blocks that
lie apart. The blocks are runs of ``k`` words and not blocks of a SimHash: one word in ten changed
moves some 9 of 64 bits, so SimHashes of near lines share no block that is long enough to tell lines apart
(README). A line's distinct runs are put in an order that is the same for all lines, and
the first ones are keys, until ``e + 1`` of them lie apart, if the line may have ``e`` edits. The
first run in that order which two near lines share is then among the keys of both: the runs before
it are all broken, and ``e`` edits cannot break ``e + 1`` runs that lie apart. Near lines do share
one (``run_length``). Runs that are frequent in all documents come last in that order, which keeps
buckets small; the order changes no result. Lines too short for an edit have no near line. Whether
lines that met are near is first asked of 128 bits, each the parity of the words that fall on it: an edit
changes at most two of them.

Of every connected group one occurrence stays: the first by doc_id and place. Lines without a
word always stay.

One pass over the documents gives a row a line with all that later steps need: place, key, numbers, runs
and, where a block of documents has the line first, its text. A text is moved only to be compared.

Results: null and empty texts have no lines to remove. A null ``doc_id`` comes first. Rows with
the same ``doc_id`` and text are one document and keep the same lines. Extra columns do not
matter. A line that stands in a third of all documents is summed in every task first; near lines
are compared with hubs (linking.py), and every join on a line is one Spark can split.
"""

from __future__ import annotations

import hashlib
import itertools
import string
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlake.llm import membership
from fleetlake.llm.common import blocks as text_blocks
from fleetlake.llm.common import release, stored
from fleetlake.llm.linking import Near, Traits, link_near, only, shared_buckets
from fleetlake.llm.text import Words, mix

SIMILARITY = 0.9
RUN = 4  # words
# Slots on which all runs are counted, how many of them go in one row, and runs counted at a time.
SLOTS, _SLOTS_A_ROW, _RUNS = 1 << 22, 1 << 10, 1 << 20
# Steps in which a count may double.
_STEPS = 6
# Lines whose keys are chosen one by one, as too few are left to choose side by side.
_FEW = 24
TRAITS = ["n", "odd", "odd2"]
# Bins on which the words of two lines are counted, the largest count, and pairs compared at a time.
BINS, _MOST_COUNTED, _PAIRS = 256, 16_000, 2_048
_NULL_ID = -(1 << 63)
_BLANK = string.punctuation.encode() + b"\t\x0b\x0c\r"
_NORMAL = bytes.maketrans(
    b"0123456789" + _BLANK + string.ascii_uppercase.encode(),
    b"0" * 10 + b" " * len(_BLANK) + string.ascii_lowercase.encode(),
)


def normal_words(line: bytes) -> list[bytes]:
    return line.translate(_NORMAL).split()


def normal_lines(text: bytes) -> list[bytes]:
    """Every line of a text, normalised; empty where it has no word."""
    text = text.translate(_NORMAL)
    while b"  " in text:
        text = text.replace(b"  ", b" ")
    return [line.strip(b" ") for line in text.split(b"\n")]


def _key(line: bytes) -> bytes:
    return hashlib.blake2b(line, digest_size=16).digest()


def edit_distance(a: list, b: list, most: int) -> int:
    """Insertions, deletions and replacements from ``a`` to ``b``, or ``most + 1`` if more.

    By furthest-reaching points on diagonals: the time grows with the length plus the square of
    the distance, so equal stretches of long lines cost little.
    """
    n, m = len(a), len(b)
    if abs(n - m) > most:
        return most + 1

    def slide(i: int, diagonal: int) -> int:
        j = i + diagonal
        while i < n and j < m and a[i] == b[j]:
            i += 1
            j += 1
        return i

    reach = {0: slide(0, 0)}
    for distance in range(most + 1):
        if reach.get(m - n, -1) >= n:
            return distance
        further = {}
        for diagonal in range(-distance - 1, distance + 2):
            i = max(
                reach.get(diagonal, -2) + 1,  # replace
                reach.get(diagonal - 1, -2),  # insert
                reach.get(diagonal + 1, -2) + 1,  # delete
            )
            if i >= 0 and i <= n and i + diagonal <= m and i + diagonal >= 0:
                further[diagonal] = slide(i, diagonal)
            elif i > n or i + diagonal > m:
                further[diagonal] = min(n, m - diagonal)
        reach = further
    return most + 1


def similar(a: list, b: list, similarity: float) -> bool:
    longest, shortest = max(len(a), len(b)), min(len(a), len(b))
    most = int(longest * (1 - similarity) + 1e-9)
    # What two lines begin or end with costs no edit.
    first = 0
    while first < shortest and a[first] == b[first]:
        first += 1
    last = 0
    while last < shortest - first and a[-1 - last] == b[-1 - last]:
        last += 1
    if longest - first - last <= most:
        return True
    return edit_distance(a[first : len(a) - last], b[first : len(b) - last], most) <= most


def most_edits(n_words: int, similarity: float) -> int:
    """Edits to the longest line that may be near one of ``n_words``."""
    return int(int(n_words / similarity + 1e-9) * (1 - similarity) + 1e-9)


def shortest_line(similarity: float) -> int:
    """Words of the shortest line that may be near another."""
    return next(n for n in itertools.count(1) if most_edits(n, similarity))


def run_length(similarity: float) -> int:
    """Words of a run, at most ``RUN``, such that any two near lines that differ share one.

    A line of ``n`` words has ``n - k + 1`` runs and loses ``k`` an edit, at most
    ``(1 - similarity) * n`` times; one stays if ``2 * k <= 1 / (1 - similarity)``.
    """
    if not 0.5 <= similarity < 1:
        raise ValueError("similarity must be at least 0.5 and below 1")
    return min(RUN, int(0.5 / (1 - similarity) + 1e-9))


def parities(words: Words) -> list[np.ndarray]:
    """128 bits of each text, 64 a number: whether an odd number of its words fall on the bit.

    An edit changes at most two of them.
    """
    mixed = mix(words.hashes)
    bits, half = np.uint64(1) << (mixed & np.uint64(63)), (mixed >> np.uint64(6)) & np.uint64(1)
    return [np.bitwise_xor.reduceat(np.where(half == h, bits, np.uint64(0)), words.bounds[:-1]) for h in (0, 1)]


def first_runs(texts: list[bytes], similarity: float, frequent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the text and hash of the runs by which it meets its near lines.

    ``frequent``: hashes of runs, the most frequent one last, or what ``frequent_runs`` gives.
    """
    return _first_runs(Words(texts), similarity, _ranks(frequent))


def _slot(hashes: np.ndarray) -> np.ndarray:
    return (hashes & np.uint64(SLOTS - 1)).astype(np.int64)


@dataclass(frozen=True)
class Frequencies:
    """How frequent runs are: a level of each slot, higher where the runs that fall on it are more."""

    levels: np.ndarray

    def of(self, hashes: np.ndarray) -> np.ndarray:
        return self.levels[_slot(hashes)].astype(np.int64)


class _Ranks:
    """Places of hashes in a list, counted from 1; 0: not in it."""

    def __init__(self, listed: np.ndarray):
        self.order = np.argsort(listed)
        self.listed = listed[self.order]
        # Most hashes are not in the list: a table by some of their bits tells that of most of these.
        self.may_be = np.zeros(SLOTS, bool)
        self.may_be[_slot(listed)] = True

    def of(self, hashes: np.ndarray) -> np.ndarray:
        ranks = np.zeros(len(hashes), np.int64)
        some = np.flatnonzero(self.may_be[_slot(hashes)])
        if len(some):
            at = np.searchsorted(self.listed, hashes[some]).clip(max=len(self.listed) - 1)
            ranks[some] = np.where(self.listed[at] == hashes[some], self.order[at] + 1, 0)
        return ranks


def _ranks(frequent: np.ndarray | Frequencies) -> _Ranks | Frequencies:
    return frequent if isinstance(frequent, Frequencies) else _Ranks(frequent)


def _in_order(owner: np.ndarray, rank: np.ndarray, runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by text, rank and hash, and whether a row is the first of its text and hash there."""
    if not len(runs) or owner[-1] >> 19:
        order = np.lexsort((runs, rank, owner))
    else:
        # One number tells texts, ranks and most hashes apart.
        bits = int(rank.max()).bit_length()
        brief = (owner.astype(np.int64) << 44) + (rank << (44 - bits)) + (runs >> np.uint64(20 + bits)).astype(np.int64)
        order = np.argsort(brief)
        same = np.flatnonzero(np.diff(brief[order]) == 0)
        if (runs[order[same]] != runs[order[same + 1]]).any():
            order = np.lexsort((runs, rank, owner))
    new = np.ones(len(runs), bool)
    new[1:] = (np.diff(owner[order]) != 0) | (np.diff(runs[order]) != 0)
    return order, new


def _first_runs(words: Words, similarity: float, ranks: _Ranks | Frequencies) -> tuple[np.ndarray, np.ndarray]:
    k = run_length(similarity)
    starts, runs = words.windows(k)
    owner = words.text[starts]
    lengths = np.diff(words.bounds)
    of_length, at = np.unique(lengths, return_inverse=True)
    edits = np.array([most_edits(int(n), similarity) for n in of_length], np.int64)[at]
    some = edits[owner] > 0
    starts, runs, owner = starts[some], runs[some], owner[some]
    if not len(runs):
        return owner, runs
    order, new = _in_order(owner, ranks.of(runs), runs)
    # Of equal runs of a text the one that comes first in it.
    starts = np.minimum.reduceat(starts[order], np.flatnonzero(new))
    owner, runs = owner[order[new]], runs[order[new]]

    # All texts choose side by side, a run of each at a time, until it has enough that lie apart.
    covered = np.zeros(len(words.text), bool)
    bounds = np.searchsorted(owner, np.arange(len(edits) + 1))
    at, ends, apart = bounds[:-1].copy(), bounds[1:], np.zeros(len(edits), np.int64)
    left = np.flatnonzero(at < ends)
    while len(left) > _FEW:
        start = starts[at[left]]
        # A run's ends tell whether it overlaps another of the same length.
        free = ~covered[start] & ~covered[start + (k - 1)]
        for i in range(k):
            covered[start[free] + i] = True
        apart[left] += free
        at[left] += 1
        left = left[(apart[left] <= edits[left]) & (at[left] < ends[left])]
    for text in left.tolist():
        here, end, n, most = int(at[text]), int(ends[text]), int(apart[text]), int(edits[text])
        low, high = int(words.bounds[text]), int(words.bounds[text + 1])
        own, places = bytearray(covered[low:high].tobytes()), (starts[here:end] - low).tolist()
        for start in places:
            if n > most:
                break
            if not own[start] and not own[start + k - 1]:
                own[start : start + k] = b"\1" * k
                n += 1
            here += 1
        at[text] = here
    taken = np.arange(len(owner)) < at[owner]
    return owner[taken], runs[taken]


def _doc(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("doc_id").fill_null(_NULL_ID).to_numpy(zero_copy_only=False)


def _text_keys(texts: list[bytes]) -> np.ndarray:
    return membership.keys_of([hashlib.blake2b(t, digest_size=8).digest() for t in texts])


def signed_lines(docs: DataFrame, similarity: float, frequent: np.ndarray | Frequencies) -> DataFrame:
    """A row for every line with a word: its document (``doc``, ``tkey``), place, key, number of
    words and parities. Where the line may have a near one and is the first of its key in a block of
    documents: also its normalised ``text`` and ``runs``, by which it meets its near lines."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent)
    shortest = shortest_line(similarity)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = _ranks(shared.value)
        for batch, texts in text_blocks(batches):
            owner, place, of_line = [], [], []
            number: dict[bytes, int] = {}
            for i, text in enumerate(texts):
                for j, line in enumerate(normal_lines(text)):
                    if line:
                        owner.append(i)
                        place.append(j)
                        of_line.append(number.setdefault(line, len(number)))
            if not number:
                continue
            distinct, at = list(number), np.array(of_line, np.int64)
            words = Words(distinct)
            lengths = np.diff(words.bounds)
            text_of, runs = _first_runs(words, similarity, ranks)
            first = np.zeros(len(at), bool)
            first[np.unique(at, return_index=True)[1]] = True
            first &= lengths[at] >= shortest
            counts = np.where(first, np.bincount(text_of, minlength=len(distinct))[at], 0)
            # The runs of first lines follow one another as the lines do, as both are numbered in order.
            offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            listed = pa.ListArray.from_arrays(pa.array(offsets), pa.array(runs.view(np.int64)))
            yield pa.record_batch(
                [
                    pa.array(_doc(batch)[owner]),
                    pa.array(_text_keys(texts).view(np.int64)[owner]),
                    pa.array(place, pa.int32()),
                    pa.array([_key(line) for line in distinct], pa.binary()).take(pa.array(at)),
                    pa.array(lengths[at]),
                    *[pa.array(odd.view(np.int64)[at]) for odd in parities(words)],
                    pa.array([distinct[i] if f else None for i, f in zip(of_line, first.tolist())], pa.binary()),
                    listed,
                ],
                names=["doc", "tkey", "line", "key", *TRAITS, "text", "runs"],
            )

    schema = "doc bigint, tkey bigint, line int, key binary, n bigint, odd bigint, odd2 bigint, text binary, runs array<bigint>"
    return docs.mapInArrow(work, schema)


def frequent_runs(docs: DataFrame, similarity: float) -> Frequencies:
    """How frequent the runs are of all lines that may have a near one, in all documents.

    A run falls on one of ``SLOTS`` slots, and a slot's runs are counted as one. A line counts once in
    a block of documents.
    """
    k, shortest = run_length(similarity), shortest_line(similarity)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, left, n = np.zeros(SLOTS, np.int64), [], 0
        for _, texts in itertools.chain(text_blocks(batches), [(None, None)]):
            if texts is not None:
                lines = {x for text in texts for x in normal_lines(text)}
                left.append(_slot(Words([x for x in lines if x.count(b" ") + 1 >= shortest]).windows(k)[1]))
                n += len(left[-1])
            if n and (texts is None or n >= _RUNS):
                counts += np.bincount(np.concatenate(left), minlength=SLOTS)
                left, n = [], 0
        rows = counts.reshape(-1, _SLOTS_A_ROW)
        row = np.flatnonzero(rows.any(axis=1))
        # As few bytes a count as the largest of a row needs.
        sizes = [np.min_scalar_type(most).itemsize for most in rows[row].max(axis=1).tolist()]
        listed = [x.astype(f"u{size}").tobytes() for x, size in zip(rows[row], sizes)]
        names = ["row", "bytes", "counts"]
        yield pa.record_batch([pa.array(row), pa.array(sizes, pa.int64()), pa.array(listed, pa.binary())], names=names)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for row, size, counts in zip(*(column.to_pylist() for column in batch.columns)):
                found = np.frombuffer(counts, f"u{size}")
                sums[row] = sums[row] + found if row in sums else found.astype(np.int64)
        levels = [(_STEPS * np.log2(1 + x)).clip(max=255).astype(np.uint8).tobytes() for x in sums.values()]
        yield pa.record_batch([pa.array(sums, pa.int64()), pa.array(levels, pa.binary())], names=["row", "levels"])

    counts = docs.select("text").mapInArrow(count, "row bigint, bytes bigint, counts binary")
    found = counts.repartition("row").mapInArrow(add, "row bigint, levels binary").toArrow()
    levels = np.zeros((SLOTS // _SLOTS_A_ROW, _SLOTS_A_ROW), np.uint8)
    for row, of_row in zip(*(column.to_pylist() for column in found.columns)):
        levels[row] = np.frombuffer(of_row, np.uint8)
    return Frequencies(levels.ravel())


def may_be_near(similarity: float):
    """For linking.py: which lines may be near, by their numbers of words and their parities."""

    def may_link(one: list[np.ndarray], other: list[np.ndarray]) -> np.ndarray:
        (m, *ours), (n, *theirs) = one, other
        most = (np.maximum(m[:, None], n[None, :]) * (1 - similarity) + 1e-9).astype(np.int64)
        found = abs(m[:, None] - n[None, :]) <= most
        odd = (np.bitwise_count(a.view(np.uint64)[:, None] ^ b.view(np.uint64)[None, :]) for a, b in zip(ours, theirs))
        found &= sum(odd) <= 2 * most
        return found

    return may_link


def alike(similarity: float) -> Near:
    """Test for linking.py: whether two normalised lines are near."""

    def linked(one: bytes, other: bytes) -> bool:
        return similar(one.split(), other.split(), similarity)

    def may_link(lines: list[bytes], one: np.ndarray, other: np.ndarray) -> np.ndarray:
        """By how many words of either line fall on each bin: an edit adds one word and takes one at most."""
        words = Words(lines)
        lengths = np.diff(words.bounds)
        at = words.text * BINS + (mix(words.hashes) >> np.uint64(32)).astype(np.int64) % BINS
        counts = np.bincount(at, minlength=len(lines) * BINS).clip(max=_MOST_COUNTED).astype(np.int16).reshape(-1, BINS)
        found = np.zeros(len(one), bool)
        for first in range(0, len(one), _PAIRS):
            a, b = one[first : first + _PAIRS], other[first : first + _PAIRS]
            difference = counts[a] - counts[b]
            most = (np.maximum(lengths[a], lengths[b]) * (1 - similarity) + 1e-9).astype(np.int64)
            added, taken = (np.maximum(d, 0).sum(axis=1, dtype=np.int64) for d in (difference, -difference))
            found[first : first + _PAIRS] = np.maximum(added, taken) <= most
        return found

    return Near(linked, may_link)


def repeated_lines(docs: DataFrame, similarity: float) -> DataFrame:
    """Stored rows: the places of the lines to remove, per document (``doc``, ``tkey``, ``lines``)."""
    signed = signed_lines(docs, similarity, frequent_runs(docs, similarity))
    lines = stored(signed.withColumn("id", F.monotonically_increasing_id()), "lines")
    at = F.struct("doc", "tkey", "line")
    # An item's id is that of one of its rows with a text; a line too short for a near one has none.
    with_text = lines.where("text is not null")
    items = stored(
        lines.groupBy("key").agg(
            F.min(at).alias("first"), F.count(F.lit(1)).alias("times"), F.min(F.when(F.col("text").isNotNull(), F.col("id"))).alias("id")
        ),
        "line-items",
    )
    release(docs.sparkSession)
    # The filter may let a second row of a line through: a copy, which is linked with the item and counts as none.
    by_run = only(with_text, items).select("id", F.explode("runs").alias("bucket"))
    members = shared_buckets(by_run, at_once=True)
    traits = Traits(with_text.select("id", *TRAITS), TRAITS, may_be_near(similarity))
    labels = link_near(members, with_text.select("id", "text"), alike(similarity), traits)

    labelled = stored(items.join(labels, "id").select("key", "label", "first"), "labelled-lines")
    firsts = labelled.groupBy("label").agg(F.min("first").alias("stays"))
    grouped = labelled.join(firsts, "label").select("key", "stays")
    alone = items.where("times > 1").join(labels, "id", "left_anti").select("key", F.col("first").alias("stays"))
    stays = stored(grouped.unionByName(alone), "stays")
    gone = lines.select("doc", "tkey", "line", "key").join(stays, "key").where(at != F.col("stays"))
    out = stored(gone.groupBy("doc", "tkey").agg(F.collect_set("line").alias("lines")), "lines-to-remove")
    release(docs.sparkSession)
    return out


def remove_lines(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The documents with all their columns, ``text`` without the lines to remove, and with
    ``n_lines`` and ``n_removed`` added (lines with a word)."""
    narrow = docs.selectExpr("cast(doc_id as bigint) doc_id", "cast(text as string) text")
    gone = repeated_lines(narrow, similarity)
    touched = membership.build(gone, "tkey")
    names = [f.name for f in docs.schema.fields]
    extra = [T.StructField("__n_lines", T.LongType()), T.StructField("__n_removed", T.LongType())]
    schema = T.StructType([*docs.schema.fields, *extra])

    def cut_block(batch: pa.RecordBatch, texts: list[bytes], listed: list) -> pa.RecordBatch:
        new, counts, removed = [], [], []
        for text, places in zip(texts, listed):
            counts.append(len(list(filter(None, map(bytes.strip, text.translate(_NORMAL).split(b"\n"))))))
            removed.append(len(places or ()))
            drop = set(places or ())
            new.append(b"\n".join(x for i, x in enumerate(text.split(b"\n")) if i not in drop).decode() if drop else None)
        column = batch.column("text")
        if any(removed):
            column = pa.array([n if r else o for n, r, o in zip(new, removed, column.to_pylist())], column.type)
        columns = [column if n == "text" else batch.column(n) for n in names]
        columns += [pa.array(counts, pa.int64()), pa.array(removed, pa.int64())]
        return pa.record_batch(columns, names=[*names, "__n_lines", "__n_removed"])

    def untouched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_blocks(batches):
            out = touched(_text_keys(texts))
            rest = [t for t, o in zip(texts, out) if not o]
            yield cut_block(batch.filter(pa.array(~out)), rest, [None] * len(rest))

    def maybe_touched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_blocks(batches):
            keys = _text_keys(texts)
            yield batch.append_column("__tkey", pa.array(keys.view(np.int64))).filter(pa.array(touched(keys)))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_blocks(batches):
            yield cut_block(batch, texts, batch.column("__lines").to_pylist())

    # Only texts from which something may go are moved to the list of what does.
    with_key = T.StructType([*docs.schema.fields, T.StructField("__tkey", T.LongType())])
    key = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_NULL_ID))
    lists = gone.select(F.col("doc").alias("__doc"), F.col("tkey").alias("__tkey"), F.col("lines").alias("__lines"))
    moved = (
        docs.mapInArrow(maybe_touched, with_key).withColumn("__doc", key)
        .join(lists, ["__doc", "__tkey"], "left").drop("__doc", "__tkey")
    )
    return docs.mapInArrow(untouched, schema).unionByName(moved.mapInArrow(cut, schema))
