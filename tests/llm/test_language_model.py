"""Hidden Markov model: likelihoods against direct enumeration, training, base scores."""

import itertools
import math
import zlib
from collections import Counter

import numpy as np
import pytest
from helpers import odd_texts, table
from pyspark.sql import functions as F

from fleetlake.llm import hmm, queries

SF = "/root/testdata/sf0.001"


def small_model(states=3, classes=4, seed=0):
    rng = np.random.default_rng(seed)

    def rows(*shape):
        x = rng.random(shape) + 0.1
        return x

    start, move, emit = rows(states), rows(states, states), rows(classes, states)
    return hmm.Model(start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))


def paths(model, chain):
    for path in itertools.product(range(len(model.start)), repeat=len(chain)):
        p = model.start[path[0]] * model.emit[chain[0], path[0]]
        for (a, b), x in zip(zip(path, path[1:]), chain[1:]):
            p *= model.move[a, b] * model.emit[x, b]
        yield path, p


def test_forward_sums_over_all_paths():
    model = small_model()
    chains = [np.array(c) for c in ([0], [1, 2, 3], [3, 3, 0, 1, 2], [2, 0])]
    got = hmm.forward(model, chains)
    assert np.allclose(got, [math.log10(sum(p for _, p in paths(model, c))) for c in chains])


def test_probabilities_of_all_texts_of_a_length_sum_to_one():
    model = small_model()
    chains = [np.array(c) for c in itertools.product(range(4), repeat=3)]
    assert np.isclose((10 ** hmm.forward(model, chains)).sum(), 1)


def test_forward_over_segments(monkeypatch):
    model, rng = small_model(), np.random.default_rng(4)
    chains = [rng.integers(0, 4, n) for n in (1, 5, 12, 7, 30)]
    whole = hmm.forward(model, chains)
    monkeypatch.setattr(hmm, "SEGMENT", 5)
    assert np.allclose(hmm.forward(model, chains), whole)


def test_expected_counts_equal_enumeration():
    model = small_model()
    chains = [np.array(c) for c in ([3, 3, 0, 1, 2], [1, 2, 3], [2, 0], [1])]
    sums = hmm.Expectations(model)
    sums.add(chains)
    start, move, emit = np.zeros(3), np.zeros((3, 3)), np.zeros((4, 3))
    for chain in chains:
        total = sum(p for _, p in paths(model, chain))
        for path, p in paths(model, chain):
            start[path[0]] += p / total
            for state, x in zip(path, chain):
                emit[x, state] += p / total
            for a, b in zip(path, path[1:]):
                move[a, b] += p / total
    assert np.allclose(sums.start, start) and np.allclose(sums.move, move) and np.allclose(sums.emit, emit)


def plain(docs, held_out):
    counts = Counter()
    for d, t in docs:
        if not held_out(d):
            counts.update([*(t or "").encode().lower().split(), b"\n"])
    n, v = sum(counts.values()), len(counts)
    out = {}
    for d, t in docs:
        tokens = [*(t or "").encode().lower().split(), b"\n"]
        base = sum(math.log10((counts[x] + 0.1) / (n + 0.1 * (v + 1))) for x in tokens)
        out[d] = (len(tokens), sum(counts[x] > 0 for x in tokens), n, base)
    return out


@pytest.mark.parametrize("own, shared, dictionary", [(16384, 2048, 262144), (20, 7, 60), (5, 3, 0)])
def test_base_scores(spark, own, shared, dictionary):
    texts = odd_texts() + ["A b c " * 30, "unseen é", "x" * 100 + " x"]
    docs = table(spark, texts)
    held = F.col("doc_id") % 4 == 1
    got = {r["doc_id"]: r for r in hmm.score_documents(docs, held, 2, 2, own, shared, dictionary).collect()}
    for d, (n, known, total, base) in plain(list(enumerate(texts)), lambda d: d % 4 == 1).items():
        r = got[d]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (n, known, total)
        assert math.isclose(r["base_score"], base, rel_tol=1e-9, abs_tol=1e-9)
        assert r["held_out"] == (d % 4 == 1) and -math.inf < r["score"] < 0


def test_training_raises_the_likelihood(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    totals = hmm.stored(hmm.token_totals(docs), "t")
    vocabulary = hmm.learn_vocabulary(totals, docs.count(), 2000, 64, 5000)
    encoded = hmm.stored(hmm.encode(docs, F.lit(False), vocabulary), "e")
    model, seen = hmm.train(encoded, vocabulary, 4, 4)
    assert all(b > a for a, b in zip(seen, seen[1:]))
    assert np.allclose(model.emit.sum(axis=0), 1) and np.allclose(model.move.sum(axis=1), 1)


def test_query_beats_the_base_on_held_out(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    expected = plain(docs, lambda d: zlib.crc32(str(d).encode()) % 10 == 0)
    rows = queries.op3_hidden_markov_model(spark, SF).collect()
    assert len(rows) == len(docs)
    for r in rows:
        n, known, total, base = expected[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (n, known, total)
        assert math.isclose(r["base_score"], base, rel_tol=1e-9)
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 10 == 0)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_edges(spark):
    rows = hmm.score_documents(table(spark, ["a", "a", None], ids=[1, 1, None]), F.lit(True), 2, 1).collect()
    assert len(rows) == 3 and {r["train_tokens"] for r in rows} == {0}
    assert hmm.score_documents(table(spark, []), F.lit(False), 2, 1).count() == 0
