"""Many patterns at once: against RE2 alone, and with texts made to be slow."""

import random
import time

import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from fleetlake.functions.multipattern import MultiPattern
from fleetlake.functions.patterns import DEFAULT_PATTERN, PATTERN_LIBRARY, match_all, matches
from fleetlake.functions.re2 import needed_literals, parse, to_jvm


def re2(pattern, texts):
    return pc.match_substring_regex(pa.array(texts, pa.string()), pattern).to_pylist()


def test_needed_literals():
    assert needed_literals("UNION") == [{"UNION"}]
    assert needed_literals(r"\bOR\b.*=.*\bOR\b") == [{"OR"}, {"="}]
    assert needed_literals(r"<(b|i|em)>[^<]*</") == [{"<b>", "<i>", "<em>"}, {"</"}]
    assert needed_literals(r"INSERT( +INTO){0,1}x") == [{"INSERT"}, {"x"}]
    assert set(needed_literals("abc+d?e")) == {frozenset(x) for x in ({"ab"}, {"c"}, {"e", "de"})}
    assert needed_literals("(foo|ba[rz])qux") == [{"fooqux", "barqux", "bazqux"}]
    assert needed_literals("(ab){2,}") == [{"ab"}]
    for nothing in ("a*", "a?|b", "", "^$", r"\d+", "(a|)", "(?i)select", r"\pL", "[[:alpha:]]x", "x{0}", r"\Qa.b\E"):
        assert needed_literals(nothing) == []


def random_pattern(rng, depth=0):
    if depth > 3 or rng.random() < 0.35:
        return rng.choice(["a", "b", "ab", "ba", ".", r"\d", "[ab]", "[^a]", "[a-c]", "1", r"\.", "é", "c", r"\b", "^", "$", r"\s", "x"])
    kind = rng.randrange(4)
    if kind == 0:
        return "".join(random_pattern(rng, depth + 1) for _ in range(rng.randrange(1, 4)))
    if kind == 1:
        return "(" + "|".join(random_pattern(rng, depth + 1) for _ in range(rng.randrange(1, 4))) + ")"
    one = rng.choice(["a", "b", "[ab]", ".", "(ab)", "(a|b)", r"\w", "(?:b1|c)"])
    return one + rng.choice(["*", "+", "?", "{2}", "{0,2}", "{1,}", "*?", "{0}"])


def fuzz(rng, n):
    out = []
    while len(out) < n:
        pattern = random_pattern(rng)
        try:
            re2(pattern, [""])
        except pa.ArrowInvalid:
            continue
        out.append(pattern)
    return out


def fuzz_texts(rng, n):
    return [None, ""] + ["".join(rng.choice("aabbcx1. \né\t") for _ in range(rng.randrange(12))) for _ in range(n)]


def test_same_as_re2_alone():
    rng = random.Random(6)
    texts = fuzz_texts(rng, 300)
    for at in range(0, 1500, 25):
        patterns = fuzz(rng, 25)
        got = MultiPattern(tuple(patterns))(pa.array(texts, pa.string()))
        for pattern, row in zip(patterns, got):
            assert row.tolist() == [bool(x) for x in re2(pattern, texts)], pattern


def test_jvm_forms_are_the_same_as_re2(spark):
    rng = random.Random(7)
    patterns = [p for p in fuzz(rng, 2500) if to_jvm(p) is not None][:150]
    assert len(patterns) == 150
    texts = fuzz_texts(rng, 150)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").coalesce(1)
    for at in range(0, 150, 50):
        part = patterns[at : at + 50]
        rows = df.select("i", *[F.col("t").rlike(to_jvm(p)).alias(f"p{n}") for n, p in enumerate(part)]).collect()
        for n, pattern in enumerate(part):
            expected = re2(pattern, texts)
            assert all(r[f"p{n}"] == expected[r["i"]] for r in rows), pattern


HOSTILE = [
    "a*a*b", "(a+)+b", "a{0,999}a{0,999}a{0,999}b", "(a|a)*b", ".*.*=.*", "(a*)*(a*)*b", r"\b[a-z]+\b.*[0-9]", "(x+x+)+y",
    "[^;]*;", "a*$", r"'('')*[^']*$", "(.*)(.*)(.*)(.*)z",
]


@pytest.mark.parametrize("pattern", HOSTILE)
def test_hostile_texts_take_linear_time(spark, pattern):
    n = 100_000
    texts = ["a" * n, "'" * n, "x" * n, "=" * n, "ab" * (n // 2), " a" * (n // 2)]
    df = spark.createDataFrame([(t,) for t in texts], "t string").coalesce(1)
    df.select(matches(F.col("t"), "(warm)+up")).collect()  # a Python worker is running
    started = time.time()
    got = [r[0] for r in df.select(matches(F.col("t"), pattern)).collect()]
    assert time.time() - started < 5
    assert got == re2(pattern, texts)


def test_ten_patterns_share_a_pass(spark):
    patterns = [f"(needle{i}|pin{i}+)[a-z]*end" for i in range(10)]
    df = spark.createDataFrame([("x needle3 needle3abcend",), (None,), ("pin7777end pin",)], "t string")
    columns = [c.alias(f"p{i}") for i, c in enumerate(match_all(F.col("t"), patterns))]
    rows = df.select(*columns)
    assert rows._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    assert [[i for i in range(10) if r[f"p{i}"]] for r in rows.collect()] == [[3], [], [7]]


def test_literals_with_every_separator():
    patterns = tuple(f"a*{c}{c}x+" for c in "\0\1\2\3\4\5\6\7") + ("a*\n+y",)
    texts = ["\0\0x", "a\n\ny", "\7\7xx", "\7x", None]
    got = MultiPattern(patterns)(pa.array(texts, pa.string()))
    for pattern, row in zip(patterns, got):
        assert row.tolist() == [bool(x) for x in re2(pattern, texts)]


def test_shipped_patterns_are_understood():
    for pattern in [DEFAULT_PATTERN, *PATTERN_LIBRARY.values()]:
        assert parse(pattern) is not None
    assert needed_literals(PATTERN_LIBRARY["union_attacks"]) == [{"UNION"}, {"SELECT"}]
