"""Quality rules by learned decision lists (native: DataFrame functions only).

Statistics of every text are column expressions inside one row. Rules are learned by sequential
covering: on the labelled rows, cut into bins at the quantiles of every statistic, a conjunction
of thresholds is grown literal by literal by information gain on two thirds of the rows, pruned
back to the prefix that does best on the other third, and accepted if it is precise enough there;
the rows it covers are then set aside. Each step is one aggregation to counts per (statistic,
bin), so what the driver sees is bounded by their number. The list becomes one ordered
``CASE WHEN`` expression.

The rules are learned from what the base rules let pass.

Results: a null text has no words, so it fails the base rules; so does an empty one. Labels that
are null, or of documents that are not there, teach nothing; a document with several labels
counts once for each. Without labels no rule is learned and the base rules decide alone.
Repeated windows are told apart by 64-bit hashes within one document. Repeated rows are judged
each; extra columns do not matter.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlake.llm.common import SPACE, let, stored

WINDOW = 8
SYMBOLS = "#*$%&|<>"
MARKS = "!?.,;:"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
DIGITS = "0123456789"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
# What the rules look at, as shares, so that they hold for texts of any length.
FEATURES = {
    "symbol_share": "n_symbols / word_chars",
    "repeat_share": "n_repeat_words / n_words",
    "dup_line_share": "n_dup_lines / n_lines",
    "mean_word": "word_chars / n_words",
    "mark_share": "n_marks / word_chars",
    "upper_share": "n_upper / word_chars",
    "digit_share": "n_digits / word_chars",
    "distinct_share": "n_distinct / n_words",
}


def _removed(text: Column, chars: str) -> Column:
    """How many characters of ``chars`` the text has."""
    return (F.length(text) - F.length(F.translate(text, chars, ""))).cast("bigint")


def _words(text: Column) -> Column:
    return F.filter(F.split(F.translate(text, SPACE[1:], " " * (len(SPACE) - 1)), " "), lambda w: w != "")


def _repeat_words(words: Column, k: int) -> Column:
    """Words covered by windows of ``k`` words that the text has twice or more."""

    def covered(hashes: Column) -> Column:
        pairs = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def repeated(s: Column) -> Column:
            def position(e: Column, j: Column) -> Column:
                same = [F.coalesce(F.get(s, j + d)["h"] == e["h"], F.lit(False)) for d in (-1, 1)]
                return F.when(same[0] | same[1], e["i"])

            return F.array_sort(F.filter(F.transform(s, position), lambda p: p.isNotNull()))

        def total(starts: Column) -> Column:
            steps = F.transform(
                starts, lambda p, j: F.least(F.lit(k), F.coalesce(F.get(starts, j + 1) - p, F.lit(k)))
            )
            return F.aggregate(steps, F.lit(0).cast("bigint"), lambda a, x: a + x)

        return let(let(pairs, repeated), total)

    def of(hashes: Column) -> Column:
        none = F.size(F.array_distinct(hashes)) == F.size(hashes)
        return F.when(none, F.lit(0).cast("bigint")).otherwise(covered(hashes))

    def windows(h: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(h) - (k - 1))
        return let(F.transform(starts, lambda i: F.xxhash64(F.slice(h, i, k))), of)

    hashed = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(F.size(words) > k, let(hashed, windows)).otherwise(F.lit(0).cast("bigint"))


def with_statistics(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(SPACE)) != "")

    def parts(w: Column) -> Column:
        return F.struct(
            F.size(w).cast("bigint").alias("n_words"),
            F.size(F.array_distinct(w)).cast("bigint").alias("n_distinct"),
            _repeat_words(w, WINDOW).alias("n_repeat_words"),
        )

    def line_parts(of: Column) -> Column:
        return F.struct(
            F.size(of).cast("bigint").alias("n_lines"),
            (F.size(of) - F.size(F.array_distinct(of))).cast("bigint").alias("n_dup_lines"),
        )

    return docs.withColumns(
        {"__words": let(_words(text), parts), "__lines": let(lines, line_parts)}
    ).withColumns(
        {f"__{n}": F.col("__words")[n] for n in ("n_words", "n_distinct", "n_repeat_words")}
        | {f"__{n}": F.col("__lines")[n] for n in ("n_lines", "n_dup_lines")}
        | {
            "__word_chars": F.length(text).cast("bigint") - _removed(text, SPACE),
            "__n_symbols": _removed(text, SYMBOLS),
            "__n_marks": _removed(text, MARKS),
            "__n_upper": _removed(text, UPPER),
            "__n_digits": _removed(text, DIGITS),
        }
    ).drop("__words", "__lines")


def feature(name: str) -> Column:
    above, below = FEATURES[name].split(" / ")
    return F.coalesce(F.try_divide(F.col(f"__{above}"), F.col(f"__{below}")), F.lit(0.0)).cast("double")


def base_failed() -> Column:
    return (F.col("__n_words") < 20) | (100 * F.col("__n_repeat_words") > 30 * F.col("__n_words"))


@dataclass(frozen=True)
class Literal:
    feature: str
    above: bool
    threshold: float
    bin: int  # the threshold is the upper edge of this bin

    def column(self) -> Column:
        value = feature(self.feature)
        return value > self.threshold if self.above else value <= self.threshold

    def on_bins(self) -> Column:
        value = F.col(self.feature)
        return value > self.bin if self.above else value <= self.bin


@dataclass(frozen=True)
class Rule:
    literals: tuple[Literal, ...]
    covered: int
    bad: int

    def column(self) -> Column:
        return _all([x.column() for x in self.literals])


def _all(conditions: list[Column]) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & c
    return out


def learn_rules(
    labelled: DataFrame,
    n_bins: int = 32,
    max_rules: int | None = None,
    max_literals: int = 3,
    min_precision: float = 0.9,
    min_covered: int = 5,
) -> list[Rule]:
    """Rules for bad texts, from ``with_statistics`` rows with a boolean ``__bad``.

    All labelled rows count. ``min_precision`` is the share of bad rows, by Laplace's rule, that
    a pruned rule must have among the rows it covers in the pruning part.
    """
    names = list(FEATURES)
    quantiles = [i / n_bins for i in range(1, n_bins)]
    edges = labelled.agg(*[F.percentile_approx(feature(n), quantiles, 20_000).alias(n) for n in names]).first()
    cuts = {n: sorted(set(edges[n] or [])) for n in names}

    def bin_of(n: str) -> Column:
        return sum((F.when(feature(n) > c, 1).otherwise(0) for c in cuts[n]), F.lit(0)).cast("int").alias(n)

    grow_part = F.pmod(F.hash(F.col("doc_id"), F.lit(29)), F.lit(3)) > 0
    # Rows with the same bins are one row from here on.
    cells = stored(
        labelled.select(grow_part.alias("__grow"), F.col("__bad"), *[bin_of(n) for n in names])
        .groupBy("__grow", *names)
        .agg(F.count_if(F.col("__bad")).alias("__p"), F.count_if(~F.col("__bad")).alias("__n")),
        "rule-cells",
    )
    rules: list[Rule] = []
    free = F.lit(True)
    # First literals that led to no rule, as (feature, direction): at most two a feature, and what
    # rows a later rule takes away does not bring them back.
    failed: set[tuple[str, bool]] = set()
    while max_rules is None or len(rules) < max_rules:
        grown = _grow(cells.where(F.col("__grow") & free), names, cuts, max_literals, failed)
        literals, p, n = _prune(cells.where(~F.col("__grow") & free), grown)
        if not literals:
            break
        if p + n < min_covered or (p + 1) / (p + n + 2) < min_precision:
            failed.add((grown[0].feature, grown[0].above))
            continue
        rules.append(Rule(tuple(literals), p + n, p))
        free = free & ~_all([x.on_bins() for x in literals])
    return rules


def _grow(
    cells: DataFrame, names: list[str], cuts: dict, max_literals: int, not_first: set[tuple[str, bool]] = frozenset()
) -> list[Literal]:
    """The conjunction found by taking the literal of greatest gain, again and again; a feature and
    direction of ``not_first`` does not begin it."""
    literals: list[Literal] = []
    while len(literals) < max_literals:
        rows = (
            cells.where(_all([x.on_bins() for x in literals]))
            .select(F.explode(F.array(*[F.struct(F.lit(n).alias("f"), F.col(n).alias("b")) for n in names])).alias("x"), "__p", "__n")
            .groupBy("x.f", "x.b")
            .agg(F.sum("__p").alias("p"), F.sum("__n").alias("n"))
            .collect()
        )
        counts = {(r["f"], r["b"]): (r["p"], r["n"]) for r in rows}
        p0 = sum(p for (f, _), (p, _n) in counts.items() if f == names[0])
        n0 = sum(n for (f, _), (_p, n) in counts.items() if f == names[0])
        if not p0 or not n0:
            break
        best, top = None, 0.0
        for f in names:
            p = n = 0
            for b, cut in enumerate(cuts[f]):
                p, n = p + counts.get((f, b), (0, 0))[0], n + counts.get((f, b), (0, 0))[1]
                for above, (p1, n1) in ((True, (p0 - p, n0 - n)), (False, (p, n))):
                    if not literals and (f, above) in not_first:
                        continue
                    gain = p1 * (math.log2(p1 / (p1 + n1)) - math.log2(p0 / (p0 + n0))) if p1 else 0.0
                    if gain > top + 1e-9:
                        best, top = Literal(f, above, cut, b), gain
        if best is None:
            break
        literals.append(best)
    return literals


def _prune(cells: DataFrame, literals: list[Literal]) -> tuple[list[Literal], int, int]:
    if not literals:
        return [], 0, 0
    prefixes = [literals[:k] for k in range(1, len(literals) + 1)]
    sums = []
    for k, prefix in enumerate(prefixes):
        on = _all([x.on_bins() for x in prefix])
        sums += [F.sum(F.when(on, F.col(f"__{c}")).otherwise(0)).alias(f"{c}{k}") for c in "pn"]
    row = cells.agg(*sums).first()
    scored = [((row[f"p{k}"] or 0), (row[f"n{k}"] or 0), k) for k in range(len(prefixes))]
    p, n, k = max(scored, key=lambda s: ((s[0] + 1) / (s[0] + s[1] + 2), s[0], -s[2]))
    return prefixes[k], p, n


def verdict(rules: list[Rule]) -> Column:
    """True where no rule of the list applies; the list as one ordered conditional expression."""
    if not rules:
        return F.lit(True)
    case = F.when(rules[0].column(), False)
    for rule in rules[1:]:
        case = case.when(rule.column(), False)
    return case.otherwise(True)


def label_rows(statistics_of: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of statistics with ``__bad``; ``labels`` has doc_id and quality (1 good, 0 bad)."""
    known = labels.where(F.col("quality").isNotNull()).select("doc_id", (F.col("quality") == 0).alias("__bad"))
    return statistics_of.join(known, "doc_id")


def judge(docs: DataFrame, labels: DataFrame, **learning) -> DataFrame:
    """One row per document: the base statistics, ``base_failed``, ``kept`` and the features."""
    of = stored(with_statistics(docs.select("doc_id", "text")).drop("text"), "statistics")
    rules = learn_rules(label_rows(of.where(~base_failed()), labels), **learning)
    return of.select(
        "doc_id",
        *[F.col(f"__{c}").alias(c) for c in COUNTS],
        base_failed().alias("base_failed"),
        (~base_failed() & verdict(rules)).alias("kept"),
        *[feature(n).alias(n) for n in FEATURES],
    )


def keep_good(docs: DataFrame, labels: DataFrame, **learning) -> DataFrame:
    """The documents that pass, with all their columns."""
    of = stored(with_statistics(docs.select("doc_id", "text")).drop("text"), "statistics")
    rules = learn_rules(label_rows(of.where(~base_failed()), labels), **learning)
    passing = with_statistics(docs).where(~base_failed() & verdict(rules))
    return passing.select(*docs.columns)
