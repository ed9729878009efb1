"""Source mixing against SQL and brute force; quality rules against brute force."""

import hashlib
import random
from collections import Counter, defaultdict

import duckdb
import pytest
from helpers import odd_texts, rows_of, table, words
from pyspark.sql import functions as F

from fleetlake.llm import mixing, quality, queries, sql

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op1_hierarchical_mixing"])
def test_mixing_equals_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    got = queries.queries()[name](spark, SF)
    expected = con.execute(queries.oracle_sql()[name]).df()
    columns = sorted(got.columns)
    assert sorted(map(tuple, got.select(columns).toPandas().values.tolist())) == sorted(
        map(tuple, expected[columns].values.tolist())
    )


def test_shortages_go_to_siblings_first(spark):
    # a: x is short of its half, so y takes it; b keeps its own half.
    leaves = spark.createDataFrame([("a", "x", 10), ("a", "y", 500), ("b", "z", 500)], "d string, s string, __size long")
    got = mixing.leaf_targets(leaves, ["d", "s"], {}, lambda total: F.lit(400).cast("bigint"), 1)
    assert {(r["d"], r["s"]): r["__target"] for r in got.collect()} == {("a", "x"): 10, ("a", "y"): 190, ("b", "z"): 200}


def test_shortage_goes_on_to_ancestors(spark):
    leaves = spark.createDataFrame([("a", "x", 10), ("a", "y", 20), ("b", "z", 500)], "d string, s string, __size long")
    got = mixing.leaf_targets(leaves, ["d", "s"], {}, lambda total: F.lit(400).cast("bigint"), 1)
    assert {(r["d"], r["s"]): r["__target"] for r in got.collect()} == {("a", "x"): 10, ("a", "y"): 20, ("b", "z"): 370}


def test_weights_and_epochs(spark):
    leaves = spark.createDataFrame([("a", 100), ("b", 100), ("c", 0)], "d string, __size long")
    got = mixing.leaf_targets(leaves, ["d"], {("a",): 3}, lambda total: F.lit(200).cast("bigint"), 2)
    # c has nothing: its share is split 3 : 1.
    assert {r["d"]: r["__target"] for r in got.collect()} == {"a": 150, "b": 50, "c": 0}


def test_prefix_of_the_seeded_order(spark):
    texts = [" ".join(["w"] * (i % 7)) for i in range(300)] + odd_texts()
    docs = table(spark, texts)
    got = {r["doc_id"]: r for r in mixing.mix(docs, {"source": F.col("source")}, {}, 1.3, 2, seed=5).collect()}
    sizes = {i: len(words(t)) for i, t in enumerate(texts)}
    left = sum(sizes.values()) * 1300 // 1000 - sum(sizes.values())
    taken, at = set(), 0
    for i in sorted(sizes, key=lambda i: (int(hashlib.md5(f"5|1|{i}".encode()).hexdigest()[:12], 16), i)):
        at += sizes[i]
        if at > left:
            break
        taken.add(i)
    assert {i for i, r in got.items() if r["copies"] == 2} == taken
    assert all(r["copies"] >= 1 for r in got.values())


def test_mix_edges(spark):
    docs = table(spark, ["a b", "a b", None, "", "c d e"], ids=[1, 1, None, 3, 4], lang=None, source=None)
    got = mixing.mix(docs, {"lang": F.col("lang"), "source": F.col("source")}, {}, 1.0)
    assert got.count() == 5 and {r["copies"] for r in got.collect()} == {1}
    assert mixing.mix(table(spark, []), {"lang": F.col("lang")}, {}, 0.5).count() == 0
    taken = mixing.take_mix(docs, {"lang": F.col("lang")}, {}, 0.5)
    assert taken.columns == docs.columns and taken.count() < 5


MIXES = [
    ({}, 0.5, 1), ({("a",): 0}, 0.7, 2), ({("*", "x"): 0, ("b", "y"): 5}, 0.6, 2), ({("a",): 0, ("b",): 0, ("",): 0, ("c",): 0}, 0.5, 1),
    ({("c",): 9, ("c", "y"): 0}, 1.9, 2), ({("*", "x"): 3}, 0.31, 1),
]


@pytest.mark.parametrize("weights, share, epochs", MIXES)
def test_repeated_and_null_ids_and_weight_zero_equal_sql(spark, weights, share, epochs):
    rng = random.Random(len(weights) + epochs)
    rows = []
    for i in range(400):
        doc_id = None if i % 9 == 0 else rng.randrange(60) if i % 3 else 1000 + i
        text = " ".join(["w"] * rng.randrange(30)) if i % 11 else None
        rows.append((doc_id, text, rng.choice(["a", "b", "c", None]), rng.choice(["x", "y"])))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    columns = {"lang": F.col("lang"), "source": F.col("source")}
    con = duckdb.connect()
    con.register("documents", docs.toPandas())
    query = sql.mixing({"lang": "lang", "source": "source"}, weights, share, epochs, 3)
    # pandas holds whole numbers with nulls as floats.
    query = query.replace("SELECT doc_id, coalesce(lang", "SELECT CAST(doc_id AS BIGINT) AS doc_id, coalesce(lang", 1)
    expected = sorted(map(repr, con.execute(query).fetchall()))
    names = [d[0] for d in con.description]
    mixed = mixing.mix(docs, columns, weights, share, epochs, 3)
    assert sorted(map(repr, map(tuple, mixed.select(names).collect()))) == expected
    # What is taken never exceeds a leaf's target.
    taken = mixed.groupBy("lang", "source").agg(F.sum(F.col("copies") * F.col("n_tokens")).alias("n"), F.first("leaf_target").alias("t"))
    assert all(r["n"] <= r["t"] for r in taken.collect())


def test_negative_weights_are_refused(spark):
    with pytest.raises(ValueError, match="negative"):
        mixing.mix(table(spark, ["a"]), {"lang": F.col("lang")}, {("en",): -1}, 0.5)


def plain_statistics(text):
    text = text or ""
    w = words(text)
    windows = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    covered = set()
    for i in range(len(w) - 7):
        if windows[tuple(w[i : i + 8])] > 1:
            covered.update(range(i, i + 8))
    lines = [x for x in text.split("\n") if words(x)]
    repeated = len(covered)
    failed = len(w) < 20 or 100 * repeated > 30 * len(w)
    return (
        len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), repeated, failed
    )


def test_base_statistics(spark):
    texts = odd_texts() + ["a b c d e f g h " * 5, "x " * 50, "# a\n# a\n \n\n# b $%", " ".join("ab" * 9)]
    docs = table(spark, texts)
    names = [*quality.COUNTS, "base_failed"]
    labels = spark.createDataFrame([], "doc_id long, quality int")
    got = {r["doc_id"]: r for r in quality.judge(docs, labels).collect()}
    for i, text in enumerate(texts):
        assert tuple(got[i][n] for n in names) == plain_statistics(text)
        assert got[i]["kept"] == (not got[i]["base_failed"])  # no labels: the base decides


def test_query_statistics_and_rules(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in queries.op2_learned_decision_list(spark, SF).collect():
        assert tuple(r[n] for n in [*quality.COUNTS, "base_failed"]) == plain_statistics(docs[r["doc_id"]])
        assert not (r["base_failed"] and r["kept"])


def test_rules_are_learned_in_order_and_applied(spark):
    good = [" ".join(f"w{(i * 31 + j * 7) % 997}" for j in range(60)) for i in range(150)]
    symbols = [t.replace(" ", " ### ") for t in good[:80]]
    shouting = [t.upper() for t in good[80:150]]
    texts = good + symbols + shouting
    docs = table(spark, texts)
    labels = spark.createDataFrame([(i, int(i < 150)) for i in range(len(texts))] + [(9999, 0), (3, None)], "doc_id long, quality int")
    of = quality.with_statistics(docs.select("doc_id", "text")).drop("text")
    rules = quality.learn_rules(quality.label_rows(of, labels))
    assert len(rules) == 2 and all(r.bad == r.covered for r in rules)
    kept = {r["doc_id"] for r in quality.judge(docs, labels).where("kept").collect()}
    assert kept == set(range(150))
    left = quality.keep_good(docs, labels)
    assert left.columns == docs.columns and {r["doc_id"] for r in left.collect()} == kept


def test_quality_edges(spark):
    labels = spark.createDataFrame([(1, 0), (1, 1), (None, 1)], "doc_id long, quality int")
    docs = table(spark, ["a b c " * 20, None, ""], ids=[1, 1, None])
    assert quality.judge(docs, labels).count() == 3
    assert quality.keep_good(table(spark, []), labels).count() == 0
    assert rows_of(quality.judge(table(spark, []), labels)) == []


def test_levels_of_the_query_are_dealt_alike(spark):
    got = defaultdict(set)
    for r in queries.op1_hierarchical_mixing(spark, SF).collect():
        got[r["source"]].add(r["domain"])
    assert all(len(d) == 1 for d in got.values())
