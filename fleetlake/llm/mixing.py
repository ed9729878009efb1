"""Mixing sources to target weights by hierarchical budgets (native: DataFrame functions only).

The levels (such as domain, language, source) form a tree. The token budget goes down the tree:
among the children of a node it is shared in proportion to their weights, and a child that has
less than its share (over at most ``max_epochs`` epochs) leaves the shortage to its siblings.
As a node's capacity is that of its whole subtree, a shortage moves to the siblings of the parent
only when the subtree has nothing left. All amounts are whole tokens, rounded down.

A leaf that gets more than one epoch reads all its documents that often, and the part of an
epoch that is left is the longest prefix, in the seeded order of that epoch, that fits. The end
of the prefix is found digit by digit of the order key: the tokens of 4,096 ranges, then of 4,096
ranges within the one that is cut, and so on. So no leaf is ever sorted as a whole, and a leaf
with a third of all rows costs a partial sum like any other.

Results: null levels are a leaf of their own (empty name). Null and empty texts have no tokens;
they are taken where the prefix passes them; a very long text counts whole and is taken where it fits.
A leaf without tokens gets nothing, nor does one whose weight is 0 or lies below a node of weight 0: its
share goes to the others. Negative weights are refused. Rows with the same ``doc_id`` have the same
place in the order and are taken together: if not all of them fit, the prefix ends before them. Rows
with a null ``doc_id`` are such rows too. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetlake.llm.common import SPACE, stored

_BIG = "decimal(38,0)"
_KEY_BITS, _DIGIT_BITS, _DIGITS = 48, 12, 3
_LAST_ID = (1 << 63) - 1


def token_count(text: Column) -> Column:
    """Words of the text."""
    plain = F.translate(F.coalesce(text.cast("string"), F.lit("")), SPACE[1:], " " * (len(SPACE) - 1))
    return F.regexp_count(plain, F.lit("[^ ]+")).cast("bigint")


def order_key(seed: int, epoch: Column, doc_id: Column) -> Column:
    """48 bits of md5 of seed, epoch and identifier."""
    text = F.concat(F.lit(f"{seed}|"), epoch.cast("string"), F.lit("|"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 12), 16, 10).cast("bigint")


def _weight(levels: list[str], weights: dict[tuple[str, ...], int]) -> Column:
    """Weight of the node that ends with ``levels``; names are matched from the root, or from
    the last level alone; 1 where none is given."""
    out = F.lit(1)
    named = sorted(((k, w) for k, w in weights.items() if len(k) == len(levels)), reverse=True)
    for path, weight in named:
        on = F.lit(True)
        for level, name in zip(levels, path):
            on = on & ((F.col(level) == name) if name != "*" else F.lit(True))
        out = F.when(on, weight).otherwise(out)
    return out.cast("bigint")


def _floor_share(amount: Column, weight: Column, total: Column) -> Column:
    return F.call_function("div", amount.cast(_BIG) * weight, F.greatest(total, F.lit(1)).cast(_BIG)).cast("bigint")


def share_out(nodes: DataFrame, parent: list[str], name: str) -> DataFrame:
    """Split ``__budget`` of each parent over its children by ``__weight`` within ``__capacity``.

    The children are filled in order of capacity per weight: those that come before the level at
    which the budget runs out are full, the others share what is left.
    """
    by = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    weight = F.greatest(F.col("__weight"), F.lit(1)).cast(_BIG)  # one of weight 0 has no capacity
    rate = F.call_function("div", F.col("__capacity").cast(_BIG) * 1_000_000, weight)
    before = by.orderBy("__rate", name).rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("bigint")
    placed = (
        nodes.withColumn("__rate", rate)
        .withColumn("__before_c", F.coalesce(F.sum("__capacity").over(before), zero))
        .withColumn("__before_w", F.coalesce(F.sum("__weight").over(before), zero))
        .withColumn("__all_w", F.sum("__weight").over(by))
        .withColumn(
            "__full",
            F.col("__capacity").cast(_BIG) * (F.col("__all_w") - F.col("__before_w"))
            <= (F.col("__budget") - F.col("__before_c")).cast(_BIG) * F.col("__weight"),
        )
        .withColumn("__full_c", F.sum(F.when(F.col("__full"), F.col("__capacity")).otherwise(0)).over(by))
        .withColumn("__free_w", F.sum(F.when(F.col("__full"), 0).otherwise(F.col("__weight"))).over(by))
    )
    part = _floor_share(F.col("__budget") - F.col("__full_c"), F.col("__weight"), F.col("__free_w"))
    share = F.when(F.col("__full"), F.col("__capacity")).otherwise(F.greatest(part, zero))
    return placed.withColumn("__share", share).drop(
        "__rate", "__before_c", "__before_w", "__all_w", "__full", "__full_c", "__free_w"
    )


def leaf_targets(
    leaves: DataFrame, levels: list[str], weights: dict[tuple[str, ...], int], budget: Column, max_epochs: int
) -> DataFrame:
    """Leaves (levels, ``__size`` in tokens) with ``__target``; ``budget`` is over all leaves' sum."""
    if min(weights.values(), default=0) < 0:
        raise ValueError("weights cannot be negative")
    closed = F.lit(False)
    for depth in range(1, len(levels) + 1):
        closed = closed | (_weight(levels[:depth], weights) == 0)
    at = leaves.withColumn("__leaf_capacity", F.when(closed, 0).otherwise(F.col("__size") * max_epochs).cast("bigint"))
    # One row, whatever the number of leaves.
    zero = F.lit(0).cast("bigint")
    size, capacity = at.agg(*[F.coalesce(F.sum(c), zero) for c in ("__size", "__leaf_capacity")]).first()
    most = F.lit(capacity).cast("bigint")
    at = at.withColumn("__target", F.least(budget(F.lit(size).cast("bigint")), most))
    for depth in range(1, len(levels) + 1):
        path = levels[:depth]
        node = at.groupBy(*path).agg(
            F.sum("__leaf_capacity").alias("__capacity"), F.first("__target").alias("__budget")
        ).withColumn("__weight", _weight(path, weights))
        shared = share_out(node, path[:-1], path[-1]).select(*path, F.col("__share").alias("__target"))
        at = at.drop("__target").join(shared, path)
    return at.drop("__leaf_capacity")


def plan(
    narrow: DataFrame,
    levels: list[str],
    weights: dict[tuple[str, ...], int],
    budget_share: float,
    max_epochs: int,
    seed: int,
) -> DataFrame:
    """One row per leaf: ``__epochs`` in full, and the last key of the part that follows.

    ``narrow`` has doc_id, the levels and ``__tokens``.
    """
    thousandths = round(budget_share * 1000)
    leaves = stored(narrow.groupBy(*levels).agg(F.sum("__tokens").alias("__size")), "mix-sizes")

    def budget(total: Column) -> Column:
        return F.call_function("div", total.cast(_BIG) * thousandths, F.lit(1000).cast(_BIG)).cast("bigint")

    one = F.greatest(F.col("__size"), F.lit(1))
    at = stored(
        leaf_targets(leaves, levels, weights, budget, max_epochs)
        .withColumn("__epochs", F.call_function("div", F.col("__target"), one).cast("bigint"))
        .withColumn("__left", F.col("__target") % one)
        .withColumn("__prefix", F.lit(0).cast("bigint")),
        "mix-leaves",
    )
    keyed = narrow.join(at.where("__left > 0").select(*levels, "__epochs"), levels).select(
        *levels, "doc_id", "__tokens", order_key(seed, F.col("__epochs"), F.col("doc_id")).alias("__key")
    )
    cut = at.where("__left > 0").select(*levels, "__left", "__prefix")
    for digit in range(1, _DIGITS + 1):
        shift = _KEY_BITS - digit * _DIGIT_BITS
        inside = keyed.withColumn("__at", F.shiftright("__key", shift))
        sums = (
            inside.join(cut, levels)
            .where(F.shiftright("__at", _DIGIT_BITS) == F.col("__prefix"))
            .groupBy(*levels, "__at")
            .agg(F.sum("__tokens").alias("__sum"), F.first("__left").alias("__left"))
        )
        running = F.sum("__sum").over(Window.partitionBy(*levels).orderBy("__at"))
        cut = stored(
            sums.withColumn("__running", running)
            .where(F.col("__running") > F.col("__left"))
            .groupBy(*levels)
            .agg(
                F.min("__at").alias("__prefix"),
                F.min_by(F.col("__left") - F.col("__running") + F.col("__sum"), "__at").alias("__left"),
            ),
            "mix-cut",
        )
    shift = _KEY_BITS - _DIGITS * _DIGIT_BITS
    id_of = F.coalesce(F.col("doc_id"), F.lit(-_LAST_ID - 1))
    order = Window.partitionBy(*levels).orderBy("__key", "__id")
    # Rows of one identifier have one place; they are one row here, so that it fits as a whole or not.
    last = (
        keyed.join(cut, levels)
        .where(F.shiftright("__key", shift) == F.col("__prefix"))
        .groupBy(*levels, "__key", id_of.alias("__id"))
        .agg(F.sum("__tokens").alias("__tokens"), F.first("__left").alias("__left"))
        .withColumn("__run", F.sum("__tokens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        .where(F.col("__run") <= F.col("__left"))
        .groupBy(*levels)
        .agg(F.max(F.struct("__key", "__id")).alias("__end"))
    )
    start = F.struct((F.shiftleft("__prefix", shift) - 1).alias("__key"), F.lit(_LAST_ID).alias("__id"))
    ends = cut.join(last, levels, "left").select(*levels, F.coalesce("__end", start).alias("__end"))
    none = F.struct(F.lit(-1).cast("bigint").alias("__key"), F.lit(_LAST_ID).alias("__id"))
    return stored(
        at.join(ends, levels, "left").select(
            *levels, "__size", "__target", "__epochs", F.coalesce("__end", none).alias("__end")
        ),
        "mix-plan",
    )


def copies(seed: int) -> Column:
    """How often a row is read, next to the columns of its leaf's plan."""
    key = order_key(seed, F.col("__epochs"), F.col("doc_id"))
    place = F.struct(key.alias("__key"), F.coalesce(F.col("doc_id"), F.lit(-_LAST_ID - 1)).alias("__id"))
    return F.col("__epochs") + F.when(place <= F.col("__end"), 1).otherwise(0)


def mix(
    docs: DataFrame,
    levels: dict[str, Column],
    weights: dict[tuple[str, ...], int],
    budget_share: float,
    max_epochs: int = 2,
    seed: int = 1,
) -> DataFrame:
    """One row per document: its levels, ``n_tokens``, the leaf's tokens and target, ``copies``.

    ``levels`` names the columns of the tree from the root; ``weights`` maps a path of names
    (``*`` for any) to a whole number. The budget is ``budget_share`` of all tokens.
    """
    path = list(levels)
    narrow = stored(
        docs.select(
            F.col("doc_id").cast("bigint").alias("doc_id"),
            *[F.coalesce(c.cast("string"), F.lit("")).alias(n) for n, c in levels.items()],
            token_count(F.col("text")).alias("__tokens"),
        ),
        "mix-tokens",
    )
    leaf_plan = plan(narrow, path, weights, budget_share, max_epochs, seed)
    return narrow.join(leaf_plan, path).select(
        "doc_id",
        *path,
        F.col("__tokens").alias("n_tokens"),
        F.col("__size").alias("leaf_tokens"),
        F.col("__target").alias("leaf_target"),
        copies(seed).alias("copies"),
    )


def take_mix(
    docs: DataFrame,
    levels: dict[str, Column],
    weights: dict[tuple[str, ...], int],
    budget_share: float,
    seed: int = 1,
) -> DataFrame:
    """The documents of the mix, at most one epoch of each, with all their columns."""
    names = {f"__level_{i}": c for i, c in enumerate(levels.values())}
    keyed = docs.withColumns({n: F.coalesce(c.cast("string"), F.lit("")) for n, c in names.items()})
    narrow = stored(
        keyed.select(F.col("doc_id").cast("bigint").alias("doc_id"), *names, token_count(F.col("text")).alias("__tokens")),
        "mix-tokens",
    )
    leaf_plan = plan(narrow, list(names), weights, budget_share, 1, seed)
    return keyed.join(leaf_plan, list(names)).where(copies(seed) > 0).select(*docs.columns)
