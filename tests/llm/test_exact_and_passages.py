"""Exact duplicates and repeated passages against SQL and brute force."""

import hashlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from helpers import odd_texts, table, words
from hypothesis import given, settings
from hypothesis import strategies as st

from fleetlake.llm import exact_dedup, membership, queries, substring_dedup
from fleetlake.llm.text import Words, sliding_min

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.mark.parametrize("name", ["op4_chunk_recipe_dedup", "op7_seed_and_extend"])
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    got = queries.queries()[name](spark, SF)
    columns = sorted(got.columns)
    expected = con.execute(queries.oracle_sql()[name]).df()[columns].values.tolist()
    assert sorted(map(tuple, got.select(columns).toPandas().values.tolist())) == sorted(map(tuple, expected))


# With one-byte digests many chunks clash, and only their contents tell them apart.
@pytest.mark.parametrize("sizes, digest_bytes", [((1024, 12, 16384), 16), ((16, 4, 64), 16), ((16, 4, 64), 1)])
def test_exact_duplicates(spark, sizes, digest_bytes):
    texts = odd_texts() + ["x" * 5000, "X" * 5000, "x" * 5001] + [f"text {i % 40} " * 30 for i in range(80)]
    got = {r["doc_id"]: r for r in exact_dedup.exact_duplicates(table(spark, texts), sizes, digest_bytes).collect()}
    groups = defaultdict(list)
    for i, text in enumerate(texts):
        groups[(text or "").translate(LOWER)].append(i)
    for text, members in groups.items():
        for i in members:
            r = got[i]
            assert (r["keep_id"], r["group_size"], r["kept"]) == (max(members), len(members), i == max(members))
            assert r["text_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_exact_duplicate_edges(spark):
    docs = table(spark, ["a", "A", "b", "b", None], ids=[None, 2, 3, 3, None])
    got = sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in exact_dedup.exact_duplicates(docs).collect()), key=repr)
    assert got == sorted([(None, 2, 2, False), (2, 2, 2, True), (3, 3, 2, True), (3, 3, 2, True), (None, None, 1, True)], key=repr)
    assert exact_dedup.exact_duplicates(table(spark, [])).count() == 0


@settings(max_examples=80, deadline=None)
@given(st.lists(st.binary(max_size=400), min_size=1, max_size=6), st.binary(max_size=60))
def test_chunks_cover_and_depend_on_the_text_alone(texts, other):
    alone = [exact_dedup.cut_points([t], 16, 4, 64)[0] for t in texts]
    assert exact_dedup.cut_points([*texts, other], 16, 4, 64)[:-1] == alone
    for text, ends in zip(texts, alone):
        assert ends[-1] == len(text) and all(0 < b - a <= 64 for a, b in zip([0, *ends], ends) if text)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text(alphabet="ab \n\té", max_size=30), min_size=1, max_size=8))
def test_words_and_windows(texts):
    found = Words([t.encode() for t in texts])
    plain = [w for t in texts for w in words(t)]
    by_hash = dict(zip(found.hashes.tolist(), plain))
    assert [by_hash[h] for h in found.hashes.tolist()] == plain
    assert found.text.tolist() == [i for i, t in enumerate(texts) for _ in words(t)]
    starts, hashes = found.windows(2)
    by_window = dict(zip(hashes.tolist(), ((plain[s], plain[s + 1]) for s in starts)))
    assert [by_window[h] for h in hashes.tolist()] == [(plain[s], plain[s + 1]) for s in starts]
    assert len(starts) == sum(max(0, len(words(t)) - 1) for t in texts)


def test_sliding_min():
    values = np.random.default_rng(0).integers(0, 9, 200).astype(np.uint64)
    assert sliding_min(values, 5).tolist() == [i + int(np.argmin(values[i : i + 5])) for i in range(196)]


def test_membership_finds_every_key(spark):
    keys = np.random.default_rng(1).integers(-(2**63), 2**63 - 1, 5000)
    df = spark.createDataFrame([(int(k),) for k in keys], "k long")
    filter_ = membership.build(df, "k")
    assert filter_(keys).all()
    assert filter_(keys + 1).mean() < 0.1
    assert not membership.build(df.where("false"), "k")(keys).any()


def plain_removal(docs, length=13):
    first = {}
    for i, text in docs:
        w = words(text)
        for s in range(len(w) - length + 1):
            k = tuple(w[s : s + length])
            first[k] = min(first.get(k, i), i)
    out = {}
    for i, text in docs:
        w, gone = words(text), set()
        for s in range(len(w) - length + 1):
            if first[tuple(w[s : s + length])] < i:
                gone.update(range(s, s + length))
        out[i] = (len(w), len(gone), [x for j, x in enumerate(w) if j not in gone])
    return out


def test_passages(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    other = " ".join(f"q{i}" for i in range(13))
    texts = odd_texts() + [
        f"start {passage} end", f"{passage}\n{other}", f"x {other} y {other}", passage, "same " * 40, "same " * 13, f"{passage} {passage}",
    ]
    got = {r["doc_id"]: r for r in substring_dedup.remove_repeats(table(spark, texts), with_text=True).collect()}
    for i, (n, removed, kept) in plain_removal(list(enumerate(texts))).items():
        r = got[i]
        assert (r["n_words"], r["n_removed"], r["text"]) == (n, removed, " ".join(kept))
        assert r["kept_sha256"] == hashlib.sha256(" ".join(kept).encode()).hexdigest()
        assert sum(s["words"] for s in r["spans"]) == removed


@pytest.mark.parametrize("seed", range(3))
def test_random_passages(spark, seed):
    rng = np.random.default_rng(seed)
    texts = [" ".join(f"{rng.integers(0, 2)}" for _ in range(rng.integers(0, 60))) for _ in range(60)]
    got = {r["doc_id"]: r for r in substring_dedup.remove_repeats(table(spark, texts), 9, 3).collect()}
    for i, (n, removed, _) in plain_removal(list(enumerate(texts)), 9).items():
        assert (got[i]["n_words"], got[i]["n_removed"]) == (n, removed)


def test_passage_edges(spark):
    text = " ".join(f"w{i}" for i in range(20))
    got = substring_dedup.remove_repeats(table(spark, [text, text, text], ids=[None, 4, 4])).collect()
    assert sorted((r["doc_id"] is None, r["n_removed"]) for r in got) == [(False, 20), (False, 20), (True, 0)]
    assert substring_dedup.remove_repeats(table(spark, [])).count() == 0
