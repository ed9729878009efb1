"""Repeated passages by seed and extend (free style: Arrow batches and joins).

Seeds: of the word 5-grams inside every window of ``length`` words the one with the least hash is
the window's anchor (winnowing), so equal windows have equal anchors, and a text of n words has
about n/5 anchors. Documents are joined on anchors: only anchors that stand in two documents go
on. Extend: a window around such an anchor is the anchor extended to both sides; the windows are
joined to the smallest ``doc_id`` that has the same one (96 bits of hash). Windows found in a
smaller document and overlapping or adjoining in the text make up the maximal repeats.

The anchors that go on are sent to the tasks as a bit filter of fixed greatest size (see
membership.py); it can only let too many windows through to the join, which is exact.

Results: words are runs of other than ASCII white space. A null or shorter text has no window. A
null ``doc_id`` counts as smaller than all. Rows with the same ``doc_id`` are one document: they
take nothing from each other, and what is found in one of them is removed at the same place in
all. Other columns do not matter. A passage that stands in a third of all documents is summed in
every task first, and the joins are ones Spark can split.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlake.llm import membership
from fleetlake.llm.common import blocks, release, stored
from fleetlake.llm.text import Words, sliding_min

LENGTH = 13
SEED = 5
_NULL_ID = -(1 << 63)


def _ids(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("doc_id").fill_null(_NULL_ID).to_numpy(zero_copy_only=False)


def _anchored(words: Words, length: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word of every window, the place of its anchor, and the seed hash at every word."""
    starts, _ = words.windows(length)
    at, hashes = words.windows(seed)
    seeds = np.full(len(words.hashes), np.iinfo(np.uint64).max, np.uint64)
    seeds[at] = hashes >> np.uint64(16)  # 48 bits do to select
    if not len(starts):
        return starts, starts, seeds
    return starts, sliding_min(seeds, length - seed + 1)[starts], seeds


def anchors(docs: DataFrame, length: int, seed: int) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in blocks(batches):
            words = Words(texts)
            _, places, seeds = _anchored(words, length, seed)
            places = np.unique(places)
            yield pa.record_batch(
                [pa.array(seeds[places].view(np.int64)), pa.array(_ids(batch)[words.text[places]])],
                names=["anchor", "doc"],
            )

    return docs.mapInArrow(work, "anchor bigint, doc bigint")


def windows(docs: DataFrame, shared: membership.Filter, length: int, seed: int) -> DataFrame:
    """Windows whose anchor may stand in several documents; of equal windows of one text the first."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in blocks(batches):
            words = Words(texts)
            starts, places, seeds = _anchored(words, length, seed)
            _, hashes = words.windows(length)
            chosen = np.flatnonzero(shared(seeds[places]))
            order = chosen[np.lexsort((hashes[chosen], words.text[starts[chosen]]))]
            text, same = words.text[starts[order]], hashes[order]
            first = np.ones(len(order), bool)
            first[1:] = (text[1:] != text[:-1]) | (same[1:] != same[:-1])
            chosen = np.sort(order[first])
            starts = starts[chosen]
            text = words.text[starts]
            yield pa.record_batch(
                [
                    pa.array(hashes[chosen].view(np.int64)),
                    pa.array(words.check(starts, length).view(np.int32)),
                    pa.array(_ids(batch)[text]),
                    pa.array((starts - words.bounds[text]).astype(np.int32)),
                ],
                names=["w", "c", "doc", "start"],
            )

    return docs.mapInArrow(work, "w bigint, c int, doc bigint, start int")


def repeats(docs: DataFrame, length: int = LENGTH, seed: int = SEED) -> DataFrame:
    """``doc`` and ``starts``: the windows of a document that a smaller document has too; of equal
    windows of one document the first."""
    docs = docs.selectExpr("cast(doc_id as bigint) doc_id", "cast(text as string) text")
    shared = stored(
        anchors(docs, length, seed)
        .groupBy("anchor")
        .agg(F.min("doc").alias("first"), F.max("doc").alias("last"))
        .where("first < last")
        .select("anchor"),
        "shared-anchors",
    )
    filter_ = membership.build(shared, "anchor")
    release(docs.sparkSession)
    found = windows(docs, filter_, length, seed)
    first = found.groupBy("w", "c").agg(F.min("doc").alias("first"))
    starts = (
        found.join(first, ["w", "c"]).where("doc > first").groupBy("doc").agg(F.collect_list("start").alias("starts"))
    )
    out = stored(starts, "repeats")
    del found, first, starts  # what is still referred to is not released
    release(docs.sparkSession)
    return out


def cut(text: bytes, windows_: np.ndarray, first: np.ndarray, length: int) -> tuple[list[bytes], list[tuple[int, int]]]:
    """The words that stay, and the maximal repeats (first word, words).

    ``windows_`` are the hashes of all windows of the text, ``first`` the places of those to
    remove; windows equal to these go too.
    """
    words = text.split()
    first = first[first < len(windows_)]
    if not len(first):
        return words, []
    starts = np.flatnonzero(np.isin(windows_, windows_[first]))
    step = np.zeros(len(words) + 1, np.int64)
    np.add.at(step, starts, 1)
    np.add.at(step, starts + length, -1)
    covered = np.cumsum(step[:-1]) > 0
    edges = np.flatnonzero(np.diff(np.concatenate([[0], covered, [0]]).astype(np.int8)))
    spans = [(int(a), int(b - a)) for a, b in zip(edges[::2], edges[1::2])]
    return [words[i] for i in np.flatnonzero(~covered)], spans


def remove_repeats(
    docs: DataFrame, length: int = LENGTH, seed: int = SEED, with_text: bool = False
) -> DataFrame:
    """One row per document: ``n_words``, ``n_removed``, ``kept_sha256``, the removed ``spans``
    and, if asked for, the kept ``text`` (words joined by one space)."""
    docs = docs.selectExpr("cast(doc_id as bigint) doc_id", "cast(text as string) text")
    found = repeats(docs, length, seed)
    touched = membership.build(found.select("doc"), "doc")
    release(docs.sparkSession)  # Spark keeps a step's shuffle until a later one has run
    schema = (
        "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string,"
        " spans array<struct<first:int,words:int>>" + ", text string" * with_text
    )

    def result(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.list_(pa.struct([("first", pa.int32()), ("words", pa.int32())]))
        for batch, texts in blocks(batches):
            listed = batch.column("starts") if "starts" in batch.schema.names else None
            if listed is not None:
                words = Words(texts)
                at, hashes = words.windows(length)
                begins = np.searchsorted(at, words.bounds)
            counts, shas, spans, kept_texts = [], [], [], []
            for i, text in enumerate(texts):
                kept, removed = text.split(), []
                n = len(kept)
                if listed is not None and listed[i].is_valid:
                    own = listed[i].values.to_numpy(zero_copy_only=False)
                    kept, removed = cut(text, hashes[begins[i] : begins[i + 1]], own, length)
                joined = b" ".join(kept)
                counts.append((n, n - len(kept)))
                shas.append(hashlib.sha256(joined).hexdigest())
                spans.append([{"first": a, "words": b} for a, b in removed])
                if with_text:
                    kept_texts.append(joined.decode())
            columns = [
                batch.column("doc_id"),
                pa.array([n for n, _ in counts], pa.int64()),
                pa.array([r for _, r in counts], pa.int64()),
                pa.array(shas, pa.string()),
                pa.array(spans, span),
            ]
            names = ["doc_id", "n_words", "n_removed", "kept_sha256", "spans"]
            if with_text:
                columns, names = [*columns, pa.array(kept_texts, pa.string())], [*names, "text"]
            yield pa.record_batch(columns, names=names)

    def chosen(batches: Iterator[pa.RecordBatch], wanted: bool) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(touched(_ids(batch)) == wanted))

    # Only texts from which something may go are moved to their starts.
    maybe = docs.mapInArrow(lambda batches: chosen(batches, True), "doc_id bigint, text string")
    moved = maybe.withColumn("doc", F.coalesce("doc_id", F.lit(_NULL_ID))).join(found, "doc", "left").drop("doc")
    rest = docs.mapInArrow(lambda batches: result(chosen(batches, False)), schema)
    return rest.unionByName(moved.mapInArrow(result, schema))
