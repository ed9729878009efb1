"""Classes of linked items among the members of buckets, without listing all pairs of a bucket.

Two items are linked when they share a bucket and pass a test; classes are the connected
components of the links. First every member is tested against one hub of its bucket, and the
classes so far are formed. A bucket whose members are all in the hub's class is done: a bucket of
like items costs one test each. For the rest, buckets with hubs of one class make up an arena.
There, every member outside the hub's class is tested against all members, in blocks of bounded
size: a block is one task's work and gives out links, not pairs, and of these only as many as connect
what they connect. Then all pairs that could join two classes have been tested, so the classes are
exact for these buckets.

Where numbers of an item (``traits``) can rule a link out, they are compared first, and texts are
fetched only for items that have someone left to be tested with. Pairs are then tested one by one, and
in a block only those whose classes its links so far do not connect. Most hubs and blocks have few
members, so many of them go through one call of Python.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlake.llm import membership
from fleetlake.llm.common import BLOCK_BYTES, release, stored
from fleetlake.llm.components import components

BLOCK = 128

# Two lists of texts → a matrix that tells which are linked.
Test = Callable[[list[bytes], list[bytes]], np.ndarray]


@dataclass(frozen=True)
class Near:
    """Tests of pairs. ``linked``: of two texts; ``may_link`` takes texts and the places of pairs among
    them and gives an array, false only where ``linked`` would refuse."""

    linked: Callable[[bytes, bytes], bool]
    may_link: Callable[[list[bytes], np.ndarray, np.ndarray], np.ndarray]


@dataclass(frozen=True)
class Traits:
    """Numbers of every item: ``table`` has ``id`` and ``columns``, all bigint. ``may_link`` takes the
    columns of two lists of items and gives a matrix, false only where the test would refuse."""

    table: DataFrame
    columns: list[str]
    may_link: Callable[[list[np.ndarray], list[np.ndarray]], np.ndarray]


def shared_buckets(buckets: DataFrame, at_once: bool = False) -> DataFrame:
    """Stored rows (``bucket``, ``id``, ``hub``) of buckets with several members.

    ``buckets`` (``bucket``, ``id``: both bigint, rows distinct) is computed twice; ``at_once``: once, for
    buckets that are dear to compute, and its rows are sorted by bucket.
    """
    if at_once:
        whole = W.partitionBy("bucket")
        counted = buckets.select("bucket", "id", F.min("id").over(whole).alias("hub"), F.count(F.lit(1)).over(whole).alias("n"))
        members = stored(counted.where("n > 1").select("bucket", "id", "hub"), "members")
        release(buckets.sparkSession)
        return members
    several = stored(
        buckets.groupBy("bucket").agg(F.min("id").alias("hub"), F.count(F.lit(1)).alias("n")).where("n > 1"),
        "several",
    )
    release(buckets.sparkSession)
    members = stored(buckets.join(several, "bucket").select("bucket", "id", "hub"), "members")
    release(buckets.sparkSession)
    return members


def only(texts: DataFrame, ids: DataFrame) -> DataFrame:
    """The texts without most of those whose ``id`` is not in ``ids``; only numbers go to Python."""
    may_have = membership.build(ids, "id")

    def listed(values):
        return pa.array(may_have(values.to_numpy()))

    listed.__annotations__ = {"values": pa.Array, "return": pa.Array}
    return texts.where(F.arrow_udf(listed, T.BooleanType())("id"))


def _with_texts(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    for side in "ba":
        pairs = pairs.join(texts.select(F.col("id").alias(side), F.col("text").alias(f"{side}_text")), side)
    return pairs


def _tested(pairs: DataFrame, texts: DataFrame, test: Test) -> DataFrame:
    """The linked ones of the pairs (``a``, ``b``)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # Pairs of one hub are tested together.
            a, b = batch.column("a").to_numpy(), batch.column("b").to_numpy()
            order = np.argsort(a, kind="stable")
            for rows in np.split(order, np.flatnonzero(np.diff(a[order])) + 1):
                for first in range(0, len(rows), BLOCK):
                    part = rows[first : first + BLOCK]
                    hub = batch.column("a_text")[int(part[0])].as_py() if len(part) else b""
                    found = test([hub], batch.column("b_text").take(pa.array(part)).to_pylist())[0]
                    linked = part[found]
                    yield pa.record_batch([pa.array(a[linked]), pa.array(b[linked])], names=["a", "b"])

    return _with_texts(pairs, texts).mapInArrow(work, "a bigint, b bigint")


def _slices_by_bytes(texts: pa.ChunkedArray) -> Iterator[slice]:
    """Consecutive slices of at most ``BLOCK_BYTES`` bytes of text, or of one text."""
    ends = np.cumsum(pa.compute.binary_length(texts).to_numpy(), dtype=np.int64)
    at = 0
    while at < len(ends):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + BLOCK_BYTES, side="right")))
        yield slice(at, to)
        at = to


class _Classes:
    """Classes of what has been joined so far."""

    def __init__(self):
        self.root: dict[int, int] = {}

    def find(self, x: int) -> int:
        root = self.root
        while (y := root.setdefault(x, x)) != x:
            root[x] = x = root[y]
        return x

    def join(self, x: int, y: int) -> bool:
        """Whether ``x`` and ``y`` were in two classes until now."""
        x, y = self.find(x), self.find(y)
        self.root[x] = y
        return x != y


def _forest(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Places of links (``a``, ``b``) that connect all that the links do, one fewer than what they connect."""
    classes = _Classes()
    return np.array([at for at, (x, y) in enumerate(zip(a.tolist(), b.tolist())) if classes.join(x, y)], np.int64)


def _tested_singly(pairs: DataFrame, texts: DataFrame, near: Near) -> DataFrame:
    """The linked ones of the pairs (``a``, ``b``)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            both = batch.column("a_text").to_pylist() + batch.column("b_text").to_pylist()
            may_be = near.may_link(both, np.arange(n), np.arange(n, 2 * n)).tolist()
            found = [may and near.linked(both[i], both[n + i]) for i, may in enumerate(may_be)]
            yield batch.select(["a", "b"]).filter(pa.array(found, pa.bool_()))

    return _with_texts(pairs, texts).mapInArrow(work, "a bigint, b bigint")


def _runs_of(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Batches of whole groups, with the bounds of the groups. Rows that agree in ``columns`` must
    follow one another, as they do in a sorted task; groups are of bounded size."""
    rest = None
    for batch in itertools.chain(batches, [None]):
        whole = batch
        if rest is not None and rest.num_rows:
            whole = rest if batch is None else pa.concat_batches([rest, batch])
        if whole is None or not whole.num_rows:
            continue
        new = np.zeros(whole.num_rows, bool)
        new[0] = True
        for column in columns:
            new[1:] |= np.diff(whole.column(column).to_numpy()) != 0
        bounds = np.append(np.flatnonzero(new), whole.num_rows)
        if batch is not None:
            # The last group may go on.
            rest, bounds = whole.slice(bounds[-2]), bounds[:-1]
        if len(bounds) > 1:
            yield whole.slice(0, bounds[-1]), bounds


_BLOCK_OF = ["arena", "i", "j"]


def _left(query: np.ndarray, label: np.ndarray, numbers: list[np.ndarray], traits: Traits) -> tuple[np.ndarray, ...]:
    """Rows of a block's queries and answers, and which of them may be linked and are not of one class."""
    one, other = np.flatnonzero(query), np.flatnonzero(~query)
    left = label[one][:, None] != label[other][None, :]
    if left.any():
        left &= traits.may_link([c[one] for c in numbers], [c[other] for c in numbers])
    return one, other, left


def _columns_of(batch: pa.RecordBatch, traits: Traits) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    query = batch.column("query").to_numpy(zero_copy_only=False)
    return query, batch.column("label").to_numpy(), [batch.column(c).to_numpy() for c in traits.columns]


def _in_blocks(rows: DataFrame) -> DataFrame:
    return rows.repartition(*_BLOCK_OF).sortWithinPartitions(*_BLOCK_OF)


def _with_partners(blocks: DataFrame, traits: Traits) -> DataFrame:
    """The rows of blocks that have an item of another class left on the other side, with their traits."""
    bare = Traits(None, traits.columns, traits.may_link)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, bounds in _runs_of(batches, _BLOCK_OF):
            query, label, numbers = _columns_of(batch, bare)
            kept = np.zeros(batch.num_rows, bool)
            for at, to in itertools.pairwise(bounds.tolist()):
                one, other, left = _left(query[at:to], label[at:to], [c[at:to] for c in numbers], bare)
                kept[at + one] = left.any(axis=1)
                kept[at + other] = left.any(axis=0)
            yield batch.filter(pa.array(kept))

    described = blocks.join(traits.table.select("id", *traits.columns), "id").select(*blocks.columns, *traits.columns)
    return _in_blocks(described).mapInArrow(work, described.schema)


def _links_of_blocks(blocks: DataFrame, texts: DataFrame, near: Near, traits: Traits) -> DataFrame:
    """Links (``a``, ``b``) between the classes of a block's items, no more than connect them."""
    bare = Traits(None, traits.columns, traits.may_link)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, bounds in _runs_of(batches, _BLOCK_OF):
            query, label, numbers = _columns_of(batch, bare)
            ids, label_of = batch.column("id").to_numpy(), label.tolist()
            texts = batch.column("text").to_pylist()
            block, a, b = [], [], []
            for at, to in itertools.pairwise(bounds.tolist()):
                one, other, left = _left(query[at:to], label[at:to], [c[at:to] for c in numbers], bare)
                i, j = np.nonzero(left)
                block.append(np.full(len(i), at))
                a.append(at + one[i])
                b.append(at + other[j])
            block, a, b = np.concatenate(block), np.concatenate(a), np.concatenate(b)
            rows = np.flatnonzero(near.may_link(texts, a, b))
            kept, of, classes = [], None, _Classes()
            for row, here, x, y in zip(rows.tolist(), block[rows].tolist(), a[rows].tolist(), b[rows].tolist()):
                if here != of:
                    of, classes = here, _Classes()
                if classes.find(label_of[x]) != classes.find(label_of[y]) and near.linked(texts[x], texts[y]):
                    classes.join(label_of[x], label_of[y])
                    kept.append(row)
            yield pa.record_batch([pa.array(ids[side[np.array(kept, np.int64)]]) for side in (a, b)], names=["a", "b"])

    return _in_blocks(blocks.join(texts, "id")).mapInArrow(work, "a bigint, b bigint")


def _blocks(arenas: DataFrame) -> DataFrame:
    """Blocks (``arena``, ``i``, ``j``) of members (``arena``, ``id``, ``label``): those outside an arena's class
    (``query``) and all of them."""
    outside = F.col("label") != F.col("arena")
    sizes = arenas.groupBy("arena").agg(
        F.ceil(F.count_if(outside) / BLOCK).alias("rows"), F.ceil(F.count(F.lit(1)) / BLOCK).alias("columns")
    )
    sized = arenas.join(stored(sizes, "arenas"), "arena")

    def place(blocks: str):
        return F.pmod(F.xxhash64("id"), F.col(blocks))

    def every(blocks: str):
        return F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(blocks) - 1))

    queries = sized.where(outside).select("arena", "id", "label", F.lit(True).alias("query"), place("rows").alias("i"), every("columns").alias("j"))
    answers = sized.select("arena", "id", "label", F.lit(False).alias("query"), place("columns").alias("j"), every("rows").alias("i"))

    return queries.unionByName(answers)


def _tested_in_blocks(arenas: DataFrame, texts: DataFrame, test: Test) -> DataFrame:
    """Links between members outside an arena's class and all of it."""

    def work(table: pa.Table) -> pa.Table:
        sides = [table.filter(pa.compute.equal(table.column("query"), value)) for value in (True, False)]
        a, b = (side.column("id").to_numpy() for side in sides)
        one, other = (side.column("label").to_numpy() for side in sides)
        found = np.zeros((len(a), len(b)), bool)
        # Long texts are tested a few at a time.
        for rows in _slices_by_bytes(sides[0].column("text")):
            for columns in _slices_by_bytes(sides[1].column("text")):
                texts = [side.column("text").slice(s.start, s.stop - s.start).to_pylist() for side, s in zip(sides, (rows, columns))]
                found[rows, columns] = test(*texts)
        i, j = np.nonzero(found & (one[:, None] != other[None, :]))
        # Links between classes, no more than connect them.
        first = _forest(one[i], other[j])
        return pa.table({"a": a[i[first]], "b": b[j[first]]})

    return _blocks(arenas).join(texts, "id").groupBy("arena", "i", "j").applyInArrow(work, "a bigint, b bigint")


def _near_hubs(members: DataFrame, traits: Traits) -> DataFrame:
    """The pairs of a hub and another member (``a``, ``b``) that the traits leave. A hub is the least
    of its members, so it comes first among them."""
    columns, may_link = traits.columns, traits.may_link
    described = members.select("hub", "id").distinct().join(traits.table.select("id", *columns), "id")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub, of_hub = None, []
        for batch in batches:
            hubs, ids = batch.column("hub").to_numpy(), batch.column("id").to_numpy()
            numbers = [batch.column(c).to_numpy() for c in columns]
            edges = np.flatnonzero(np.diff(hubs)) + 1
            kept = [np.empty(0, np.int64)]
            for at, to in zip([0, *edges], [*edges, len(hubs)] if len(hubs) else []):
                if hubs[at] != hub:
                    hub, of_hub = hubs[at], [c[at : at + 1] for c in numbers]
                near = may_link(of_hub, [c[at:to] for c in numbers])[0] & (ids[at:to] != hub)
                kept.append(at + np.flatnonzero(near))
            rows = np.concatenate(kept)
            yield pa.record_batch([pa.array(hubs[rows]), pa.array(ids[rows])], names=["a", "b"])

    dealt = described.select("hub", "id", *columns).repartition("hub").sortWithinPartitions("hub", "id")
    return dealt.mapInArrow(work, "a bigint, b bigint")


def link(members: DataFrame, texts: DataFrame, test: Test, traits: Traits | None = None) -> DataFrame:
    """``id`` and ``label`` of every item that has a link. ``members``: see ``shared_buckets``;
    ``texts`` has ``id`` and ``text`` (binary) of them all."""
    if traits is not None:
        near = Near(lambda one, other: bool(test([one], [other])[0, 0]), lambda _, a, b: np.ones(len(a), bool))
        return link_near(members, texts, near, traits)
    pairs = members.where("id <> hub").select(F.col("hub").alias("a"), F.col("id").alias("b")).distinct()
    labels = components(stored(_tested(stored(pairs, "pairs"), texts, test), "links"))
    return _with_more(labels, stored(_tested_in_blocks(_arenas(members, labels), texts, test), "links"))


def link_near(members: DataFrame, texts: DataFrame, near: Near, traits: Traits) -> DataFrame:
    """``link`` for items that traits describe: pairs are tested one by one."""
    pairs = stored(_near_hubs(members, traits), "pairs")
    release(members.sparkSession)
    ids = pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id")))
    # Fetched once, though every pair needs two.
    few = stored(only(texts, ids), "pair-texts")
    labels = components(stored(_tested_singly(pairs, few, near), "links"))
    blocks = stored(_with_partners(_blocks(_arenas(members, labels)), traits), "arena-partners")
    release(members.sparkSession)
    return _with_more(labels, stored(_links_of_blocks(blocks, only(texts, blocks), near, traits), "links"))


def _arenas(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Stored members (``arena``, ``id``, ``label``) of buckets that are not yet in one class."""
    named = labels.withColumnRenamed("id", "__id")
    at = members.join(named, F.col("id") == F.col("__id"), "left").select(
        "bucket", "id", "hub", F.coalesce("label", "id").alias("label")
    )
    arena = F.max(F.when(F.col("id") == F.col("hub"), F.col("label"))).alias("arena")
    classes = [F.min("label").alias("l"), F.max("label").alias("m"), F.count(F.lit(1)).alias("n")]
    # The one pair of a bucket of two has been tested.
    unlike = at.groupBy("bucket").agg(arena, *classes).where("l < m AND n > 2")
    arenas = stored(at.join(stored(unlike, "open"), "bucket").select("arena", "id", "label").distinct(), "arena-members")
    release(members.sparkSession)
    return arenas


def _with_more(labels: DataFrame, more: DataFrame) -> DataFrame:
    if more.isEmpty():
        return labels
    chain = labels.select(F.col("label").alias("a"), F.col("id").alias("b"))
    return components(chain.union(more))
