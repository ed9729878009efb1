"""Exact duplicates by content-defined chunk recipes (free style: Arrow batches and joins).

A normalised text (A-Z in lower case) is cut where a rolling hash of the last 32 bytes says so,
so equal passages give equal chunks wherever they stand. A document's recipe is the ordered list
of its chunks' identifiers. Identifiers are 128-bit digests, verified: the contents of all chunks
whose digest occurs more than once are brought together, once for each distinct content and map
task, and contents that differ under one digest get different identifiers. Documents are equal
when their recipes are equal; whole texts are never moved or compared.

Results: null counts as empty, and empty texts are equal. Of equal texts the row with the
largest ``doc_id`` stays; a null ``doc_id`` stays only if the group has no other. Rows that repeat
the ``doc_id`` that stays are the same document and stay too. Extra columns do not matter. A group
with a third of all rows is summed in every task first, and its join is one Spark can split.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetlake.llm import membership
from fleetlake.llm.common import blocks, stored
from fleetlake.llm.text import mix

LEAST, MEAN_BITS, MOST = 1024, 12, 16_384
DIGEST_BYTES = 16
_WINDOW = 32
_GEAR = (mix(np.arange(1001, 1257, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def cut_points(texts: list[bytes], least: int, mean_bits: int, most: int) -> list[list[int]]:
    """End of every chunk of every text."""
    gap = b"\0" * _WINDOW
    # Every text follows a gap, so its first marks do not depend on what stands before it.
    data = np.frombuffer(gap + gap.join(texts), np.uint8)
    rolling, width = _GEAR[data], 1
    while width < _WINDOW:
        rolling[width:] += rolling[:-width] << np.uint32(width)
        width *= 2
    marks = np.flatnonzero(rolling >> np.uint32(32 - mean_bits) == 0) + 1
    out, begin = [], _WINDOW
    for text in texts:
        size = len(text)
        own = marks[np.searchsorted(marks, begin + least) : np.searchsorted(marks, begin + size)] - begin
        ends, at, i = [], 0, 0
        while size - at > least:
            i += int(np.searchsorted(own[i:], at + least))
            end = int(own[i]) if i < len(own) else size
            at = min(end, at + most, size)
            ends.append(at)
        if at < size or not ends:
            ends.append(size)
        out.append(ends)
        begin += size + _WINDOW
    return out


def _chunked(batches: Iterator[pa.RecordBatch], sizes: tuple[int, int, int], digest_bytes: int):
    for batch, texts in blocks(batches):
        texts = [t.translate(_LOWER) for t in texts]
        for doc_id, text, ends in zip(batch.column("doc_id").to_pylist(), texts, cut_points(texts, *sizes)):
            chunks = [text[a:b] for a, b in zip([0, *ends], ends)]
            digests = [hashlib.blake2b(c, digest_size=digest_bytes).digest() for c in chunks]
            yield doc_id, text, chunks, digests


def recipes(docs: DataFrame, sizes: tuple[int, int, int], digest_bytes: int) -> DataFrame:
    def work(batches):
        rows = []
        for doc_id, text, _, digests in _chunked(batches, sizes, digest_bytes):
            rows.append((doc_id, hashlib.sha256(text).hexdigest(), digests))
            if len(rows) == 2000:
                yield _batch(rows)
                rows = []
        yield _batch(rows)

    def _batch(rows):
        ids, shas, digests = zip(*rows) if rows else ((), (), ())
        return pa.record_batch(
            [pa.array(ids, pa.int64()), pa.array(shas, pa.string()), pa.array(digests, pa.list_(pa.binary()))],
            names=["doc_id", "text_sha256", "digests"],
        )

    return docs.mapInArrow(work, "doc_id bigint, text_sha256 string, digests array<binary>")


def repeated_chunks(docs: DataFrame, filter_: membership.Filter, sizes, digest_bytes: int) -> DataFrame:
    """Place, digest and content of every chunk whose digest may occur more than once."""

    def work(batches):
        rows, size = [], 0
        for doc_id, text, chunks, digests in _chunked(batches, sizes, digest_bytes):
            maybe = filter_(membership.keys_of(digests))
            for seq in np.flatnonzero(maybe):
                rows.append((doc_id, hashlib.sha256(text).hexdigest(), int(seq), digests[seq], chunks[seq]))
                size += len(chunks[seq])
            if size > 4_000_000:
                yield _batch(rows)
                rows, size = [], 0
        yield _batch(rows)

    def _batch(rows):
        kinds = [pa.int64(), pa.string(), pa.int32(), pa.binary(), pa.binary()]
        names = ["doc_id", "text_sha256", "seq", "digest", "content"]
        columns = zip(*rows) if rows else [()] * 5
        return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return docs.mapInArrow(work, "doc_id bigint, text_sha256 string, seq int, digest binary, content binary")


def exact_duplicates(
    docs: DataFrame,
    sizes: tuple[int, int, int] = (LEAST, MEAN_BITS, MOST),
    digest_bytes: int = DIGEST_BYTES,
) -> DataFrame:
    """One row per document: ``doc_id``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``,
    ``n_chunks``. ``sizes``: least bytes of a chunk, bits of the mean, most bytes."""
    docs = docs.selectExpr("cast(doc_id as bigint) doc_id", "cast(text as string) text")
    listed = stored(recipes(docs, sizes, digest_bytes), "recipes")

    # The identifiers: contents are compared wherever a digest occurs more than once.
    digests = listed.select(F.explode("digests").alias("digest")).groupBy("digest").agg(F.count(F.lit(1)).alias("n"))
    repeated = stored(digests.where("n > 1").select("digest"), "repeated-digests")
    filter_ = membership.build(repeated, "digest")
    chunks = repeated_chunks(docs, filter_, sizes, digest_bytes)
    contents = chunks.groupBy("digest", "content").agg(F.count(F.lit(1)).alias("n"))
    clashes = stored(
        contents.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("digest"), "clashes"
    )
    listed = listed.withColumn("variants", F.array().cast("array<struct<seq:int,variant:int>>"))
    if not clashes.isEmpty():
        listed = stored(_told_apart(listed, chunks, contents.join(clashes, "digest")), "verified-recipes")

    groups = stored(
        listed.groupBy("digests", "variants")
        .agg(F.max("doc_id").alias("__keep"), F.count(F.lit(1)).alias("__size"))
        .where("__size > 1"),
        "recipe-groups",
    )
    return listed.join(groups, ["digests", "variants"], "left").select(
        "doc_id",
        F.coalesce("__keep", "doc_id").alias("keep_id"),
        F.coalesce("__size", F.lit(1)).cast("bigint").alias("group_size"),
        F.coalesce("__keep", "doc_id").eqNullSafe(F.col("doc_id")).alias("kept"),
        "text_sha256",
        F.size("digests").alias("n_chunks"),
    )


def _told_apart(listed: DataFrame, chunks: DataFrame, clashing: DataFrame) -> DataFrame:
    """Recipes with a variant number at every place whose digest has several contents."""
    numbered = clashing.select(
        "digest", "content", F.row_number().over(Window.partitionBy("digest").orderBy("content")).alias("variant")
    )
    found = (
        chunks.join(numbered, ["digest", "content"])
        .groupBy("doc_id", "text_sha256")
        .agg(F.array_sort(F.collect_set(F.struct("seq", "variant"))).alias("__found"))
        .select(F.col("doc_id").alias("__doc"), F.col("text_sha256").alias("__sha"), "__found")
    )
    same = listed["doc_id"].eqNullSafe(found["__doc"]) & (listed["text_sha256"] == found["__sha"])
    return listed.join(found, same, "left").select(
        "doc_id", "text_sha256", "digests", F.coalesce("__found", "variants").alias("variants")
    )
