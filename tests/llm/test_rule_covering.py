"""Covering goes on as long as rules are precise."""

from helpers import table

from fleetlake.llm import quality


def test_more_than_twelve_rules(spark, monkeypatch):
    rules = [[quality.Literal("mean_word", True, float(i), i)] for i in range(15)]
    grown = iter([*rules, []])
    monkeypatch.setattr(quality, "_grow", lambda *_: next(grown))
    monkeypatch.setattr(quality, "_prune", lambda _, literals: (literals, 50 if literals else 0, 0))
    docs = quality.with_statistics(table(spark, ["a b", "c d"])).withColumn("__bad", quality.F.lit(True))
    assert [list(r.literals) for r in quality.learn_rules(docs)] == rules


def test_a_rule_that_is_not_precise_does_not_end_the_covering(spark, monkeypatch):
    good = [quality.Literal("mean_word", True, float(i), i) for i in range(3)]
    poor = quality.Literal("symbols", True, 1.0, 1)
    asked = []

    def grow(cells, names, cuts, most, not_first):
        asked.append(set(not_first))
        wanted = [good[0], poor, good[1], quality.Literal("symbols", False, 2.0, 2), good[2]]
        return [wanted[len(asked) - 1]] if len(asked) <= len(wanted) else []

    monkeypatch.setattr(quality, "_grow", grow)
    monkeypatch.setattr(quality, "_prune", lambda _, x: (x, 50 if x else 0, 90 if x and x[0].feature == "symbols" else 0))
    docs = quality.with_statistics(table(spark, ["a b", "c d"])).withColumn("__bad", quality.F.lit(True))
    assert [r.literals[0] for r in quality.learn_rules(docs)] == good
    assert asked[-1] == {("symbols", True), ("symbols", False)}


def test_first_literals_are_left_out_and_ties_go_to_the_first_feature(spark):
    # Two features tell good from bad equally well; the first by name order of the list wins.
    rows = [(b, b, 10 if b else 0, 0 if b else 10) for b in (0, 1)]
    cells = spark.createDataFrame(rows, "f1 int, f2 int, __p long, __n long")
    cuts = {"f1": [0.5], "f2": [0.5]}
    literal = lambda f: quality.Literal(f, True, 0.5, 0)
    assert quality._grow(cells, ["f1", "f2"], cuts, 3) == [literal("f1")]
    assert quality._grow(cells, ["f1", "f2"], cuts, 3, {("f1", True)}) == [literal("f2")]
    assert quality._grow(cells, ["f1", "f2"], cuts, 3, {("f1", True), ("f2", True)}) == []
