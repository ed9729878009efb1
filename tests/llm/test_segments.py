"""Training over segments of a document equals training over the whole."""

import numpy as np
from test_language_model import small_model

from fleetlake.llm import hmm


def test_expected_counts_do_not_depend_on_segments(spark, monkeypatch):
    model, rng = small_model(), np.random.default_rng(7)
    chains = [rng.integers(0, 4, n) for n in (23, 12, 11, 10, 6, 5, 1)]
    whole = hmm.Expectations(model)
    whole.add(chains)
    rows = spark.createDataFrame([(bytearray(c.astype("<u2").tobytes()),) for c in chains], "classes binary")
    monkeypatch.setattr(hmm, "SEGMENT", 5)
    parts = hmm.Expectations(model)
    parts.add(chains)
    assert np.isclose(parts.likelihood, whole.likelihood) and np.allclose(parts.emit, whole.emit)
    assert np.allclose(parts.start, whole.start) and np.allclose(parts.move, whole.move)
    monkeypatch.setattr(hmm, "SEGMENT", 512)
    long = [np.tile(c, 100) for c in chains]
    rows = spark.createDataFrame([(bytearray(c.astype("<u2").tobytes()),) for c in long], "classes binary")
    got = {r["key"]: r for r in hmm.expected_counts(rows, model).collect()}
    assert np.isclose(sum(got[-4][f"s{s}"] for s in range(3)), len(long))
    moves = sum(got[-1 - i][f"s{s}"] for i in range(3) for s in range(3))
    assert np.isclose(moves, sum(len(c) - 1 for c in long))


def test_few_steps_for_chains_of_many_lengths():
    # One chain in fifty is long; they come in any order.
    rng = np.random.default_rng(2)
    lengths = np.where(rng.random(8000) < 0.02, rng.integers(2000, 20_001, 8000), rng.integers(1, 600, 8000))
    groups = list(hmm.groups_of_like_length(np.full(n, i % 7, "<u2") for i, n in enumerate(lengths.tolist())))
    assert sorted(len(c) for g in groups for c in g) == sorted(lengths.tolist())
    assert max(map(len, groups)) <= hmm.SIDE_BY_SIDE
    assert all(len(a) >= len(b) for g in groups for a, b in zip(g, g[1:]))
    steps = sum(len(g[0]) for g in groups)
    ordered = np.sort(lengths)[::-1]
    assert steps <= 1.1 * ordered[:: hmm.SIDE_BY_SIDE].sum()
