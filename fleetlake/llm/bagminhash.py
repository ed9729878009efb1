"""Near duplicates by BagMinHash (free style: Arrow batches and joins).

A text is the bag of its word 5-grams; two texts are near when the weighted Jaccard similarity of
their bags (sum of the lesser counts over sum of the greater) is at least ``threshold``.

Signature: a 5-gram with count w owns the weight axis from 0 to w. The axis is cut into levels
(0, 1], (1, 2], (2, 4], (4, 8], ...; on every level that w reaches runs a Poisson process seeded by
5-gram and level, whose rate is the level's width. Every point has a time, a place in the
signature and a height on its level; points above w do not count. A place of the signature keeps
its earliest time. So equal places have the probability of the weighted Jaccard similarity, and
as points come in order of time, a process stops when it is later than every place.

Texts with equal words are one item. Items that agree in a band of the signature share a bucket;
classes of near texts are found by linking.py, every link verified on the bags of the whole texts.
With 32 bands of 4, two texts at a similarity of 0.8 share no bucket with probability 5e-8.

Results: a text of one to four words is one shingle of all its words. Null texts and texts
without words are equal to each other and near nothing else. Of a class the least ``doc_id`` stays (null
counts as least); rows that repeat this ``doc_id`` with the same words stay too. Extra columns do
not matter. A group of copies is one item before any join on it, and near copies are compared
with hubs, not with each other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlake.llm import membership
from fleetlake.llm.common import blocks, stored
from fleetlake.llm.linking import link, shared_buckets
from fleetlake.llm.text import Words, mix

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 32, 4
_STEP = np.uint64(0x9E3779B97F4A7C15)
_NULL_ID = -(1 << 63)
_COLUMNS = 8192


def bags(words: Words, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, shingle hash and count of every shingle of every text, in order of text."""
    starts, hashes = words.windows(k)
    text = words.text[starts]
    sizes = np.diff(words.bounds)
    short = np.flatnonzero((sizes > 0) & (sizes < k))
    if len(short):
        text = np.concatenate([text, short])
        hashes = np.concatenate([hashes, *[_whole(words.words_of(i)) for i in short]])
    order = np.lexsort((hashes, text))
    text, hashes = text[order], hashes[order]
    if not len(text):
        return text, hashes, np.empty(0, np.int64)
    first = np.flatnonzero(np.concatenate([[True], (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])]))
    return text[first], hashes[first], np.diff(np.append(first, len(text)))


def _whole(words: np.ndarray) -> np.ndarray:
    """Hash of a text too short for a shingle."""
    out = np.array([len(words)], np.uint64)
    for word in words:
        out = mix(out * _STEP + word)
    return out


def signatures(text: np.ndarray, shingle: np.ndarray, count: np.ndarray, n: int, size: int) -> np.ndarray:
    """[n, size] times; ``size`` is a power of two. Infinite where a text has no shingle."""
    out = np.full((n, size), np.inf)
    flat = out.reshape(-1)
    # One process for every shingle and level it reaches.
    top = np.ceil(np.log2(np.maximum(count, 1))).astype(np.int64)
    level = np.arange(int(top.max()) + 1 if len(top) else 0)
    process = [np.flatnonzero(top >= v) for v in level]
    item = np.concatenate(process) if process else np.empty(0, np.int64)
    at_level = np.repeat(level, [len(p) for p in process])
    owner, weight = text[item], count[item].astype(np.float64)
    low = np.where(at_level == 0, 0.0, 2.0 ** (at_level - 1))
    width = np.where(at_level == 0, 1.0, low)
    seed = mix(shingle[item] + _STEP * (at_level + 1).astype(np.uint64))
    time = np.zeros(len(item))
    shift = np.uint64(64 - (size.bit_length() - 1))
    while len(item):
        draw = mix(seed)
        seed = seed + _STEP
        time = time - np.log1p(-(draw >> np.uint64(11)).astype(np.float64) * 2.0**-53) / width
        second = mix(draw ^ _STEP)
        place = (second >> shift).astype(np.int64)
        height = low + width * ((second & np.uint64(0xFFFFFFFF)).astype(np.float64) * 2.0**-32)
        counted = height < weight
        np.minimum.at(flat, owner[counted] * size + place[counted], time[counted])
        docs = np.unique(owner) if len(owner) < n else slice(None)
        latest = np.empty(n)
        latest[docs] = out[docs].max(axis=1)
        go = time < latest[owner]
        item, owner, weight, low, width, seed, time = (x[go] for x in (item, owner, weight, low, width, seed, time))
    return out


def band_keys(signature: np.ndarray, bands: int) -> np.ndarray:
    """[n, bands] 64-bit keys."""
    bits = signature.view(np.uint64).reshape(len(signature), bands, -1)
    key = np.broadcast_to(np.arange(bands, dtype=np.uint64) + np.uint64(1), bits.shape[:2]).copy()
    for r in range(bits.shape[2]):
        key = mix(key * _STEP + bits[:, :, r])
    return key.view(np.int64)


def _content_keys(texts: list[bytes]) -> list[bytes]:
    return [hashlib.blake2b(b" ".join(t.split()), digest_size=16).digest() for t in texts]


def _picks(keys: list[bytes], docs: np.ndarray) -> np.ndarray:
    """64-bit keys of content and doc_id together."""
    return mix(membership.keys_of(keys) ^ mix(docs.view(np.uint64)))


def signed(docs: DataFrame, bands: int, rows: int, k: int) -> DataFrame:
    """``row`` (a number for each row), ``doc_id``, content ``key``, both hashed (``pick``) and the
    ``bands`` of each text; no bands where there is no word."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 36
        for batch, texts in blocks(batches, 1_000_000):
            words = Words(texts)
            keys = band_keys(signatures(*bags(words, k), len(texts), bands * rows), bands)
            empty = np.diff(words.bounds) == 0
            offsets = np.concatenate([[0], np.cumsum(np.where(empty, 0, bands))]).astype(np.int32)
            contents = _content_keys(texts)
            picks = _picks(contents, batch.column("doc_id").fill_null(_NULL_ID).to_numpy(zero_copy_only=False))
            yield pa.record_batch(
                [
                    pa.array(np.arange(row, row + len(texts))),
                    batch.column("doc_id"),
                    pa.array(contents, pa.binary()),
                    pa.array(picks.view(np.int64)),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys[~empty].reshape(-1))),
                ],
                names=["row", "doc_id", "key", "pick", "bands"],
            )
            row += len(texts)

    return docs.mapInArrow(work, "row bigint, doc_id bigint, key binary, pick bigint, bands array<bigint>")


def near(threshold: float, k: int):
    """Test for linking.py: which pairs of texts have similar bags.

    The n-th occurrence of a shingle is an element of its own, so bags are sets, and common
    elements are counted by a product of two 0/1 matrices, some columns at a time.
    """

    def elements(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        text, shingle, count = bags(Words(texts), k)
        nth = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        text, shingle = np.repeat(text, count), np.repeat(shingle, count)
        return text, mix(shingle + _STEP * nth.astype(np.uint64)), np.bincount(text, minlength=len(texts))

    def test(one: list[bytes], other: list[bytes]) -> np.ndarray:
        (text_a, items_a, size_a), (text_b, items_b, size_b) = elements(one), elements(other)
        both = np.intersect1d(items_a, items_b)
        common = np.zeros((len(one), len(other)), np.float32)
        place_a, place_b = np.searchsorted(both, items_a), np.searchsorted(both, items_b)
        for first in range(0, len(both), _COLUMNS):
            width = min(_COLUMNS, len(both) - first)
            sides = []
            for text, items, place, n in ((text_a, items_a, place_a, len(one)), (text_b, items_b, place_b, len(other))):
                here = (place >= first) & (place < first + width)
                here[here] = both[place[here]] == items[here]
                matrix = np.zeros((n, width), np.float32)
                matrix[text[here], place[here] - first] = 1
                sides.append(matrix)
            common += sides[0] @ sides[1].T
        total = size_a[:, None] + size_b[None, :] - common
        return (total > 0) & (common >= threshold * total)

    return test


def _texts_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``id`` and ``text`` of the items in ``wanted`` (``id``, ``key``, ``doc``, ``pick``)."""
    filter_ = membership.build(wanted, "pick")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in blocks(batches):
            keys = _content_keys(texts)
            doc = batch.column("doc_id").fill_null(_NULL_ID)
            chosen = filter_(_picks(keys, doc.to_numpy(zero_copy_only=False)))
            full = pa.record_batch([pa.array(keys, pa.binary()), doc, batch.column("text")], names=["key", "doc", "text"])
            yield full.filter(pa.array(chosen))

    found = docs.mapInArrow(work, "key binary, doc bigint, text string").dropDuplicates(["key", "doc"])
    return found.join(wanted, ["key", "doc"]).select("id", "text")


def near_classes(
    docs: DataFrame, threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS, k: int = SHINGLE
) -> DataFrame:
    """Stored rows, one per document: ``doc_id``, content ``key``, ``class_id`` (the least doc_id
    of its class), ``class_size`` in documents, ``kept``."""
    docs = docs.selectExpr("cast(doc_id as bigint) doc_id", "cast(text as string) text")
    all_ = stored(signed(docs, bands, rows, k), "signatures").withColumn("doc", F.coalesce("doc_id", F.lit(_NULL_ID)))
    items = stored(all_.groupBy("key").agg(F.min(F.struct("doc", "row", "pick")).alias("m"))
                   .select("key", "m.doc", F.col("m.row").alias("id"), "m.pick"), "items")
    chosen = all_.select(F.col("row").alias("id"), "bands").join(items.select("id"), "id")
    members = shared_buckets(chosen.select("id", F.explode("bands").alias("bucket")))
    wanted = stored(items.join(members.select("id").distinct(), "id").select("id", "key", "doc", "pick"), "candidates")
    texts = stored(_texts_of(docs, wanted), "candidate-texts")
    labels = link(members, texts.select("id", F.col("text").cast("binary").alias("text")), near(threshold, k))

    labelled = items.join(labels, "id", "left").select("key", F.coalesce("label", "id").alias("label"), "doc")
    class_of = stored(
        labelled.join(labelled.groupBy("label").agg(F.min("doc").alias("least")), "label").select("key", "label", "least"),
        "item-classes",
    )
    named = stored(all_.join(class_of, "key").select("doc_id", "doc", "key", "label", "least"), "named")
    sizes = named.groupBy("label").agg(F.count(F.lit(1)).alias("size"))
    id_of = F.when(F.col("least") != _NULL_ID, F.col("least"))
    return named.join(sizes, "label").select(
        "doc_id",
        "key",
        id_of.alias("class_id"),
        F.col("size").cast("bigint").alias("class_size"),
        (F.col("doc") == F.col("least")).alias("kept"),
    )


def keep_one_of_each(
    docs: DataFrame, threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS, k: int = SHINGLE
) -> DataFrame:
    """The documents without all but one of each class, with all their columns."""
    narrow = docs.selectExpr("cast(doc_id as bigint) doc_id", "cast(text as string) text")
    classes = near_classes(narrow, threshold, bands, rows, k)
    dropped = classes.where("not kept").select(F.coalesce("doc_id", F.lit(_NULL_ID)).alias("__doc"), F.col("key").alias("__key"))
    dropped = stored(dropped.distinct(), "dropped")
    filter_ = membership.build(dropped, "__key")
    columns = docs.columns

    def part(wanted: bool):
        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch, texts in blocks(batches):
                keys = _content_keys(texts)
                chosen = pa.array(filter_(membership.keys_of(keys)) == wanted)
                if wanted:
                    batch = batch.append_column("__key", pa.array(keys, pa.binary()))
                yield batch.filter(chosen)

        schema = T.StructType([*docs.schema.fields, *[T.StructField("__key", T.BinaryType())] * wanted])
        return docs.mapInArrow(work, schema)

    # Only texts that may go are moved to the list of those that do.
    moved = part(True).withColumn("__doc", F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_NULL_ID)))
    return part(False).unionByName(moved.join(dropped, ["__doc", "__key"], "left_anti").select(*columns))
