"""Token counts, packing, language identification: no shuffle, checked against plain versions."""

import math
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import regex
from helpers import odd_texts, table
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from fleetlake.llm import language, packing, queries, token_counts

SF = "/root/testdata/sf0.001"
RANKS = public_tokenizers.path(queries.RANKS)
BPE = public_tokenizers.path(queries.BPE)


@pytest.fixture(scope="module")
def scores():
    return token_counts.load_scores(RANKS)


def plain_count(word: bytes, scores) -> int:
    best = [(0.0, 0)]
    for end in range(1, len(word) + 1):
        found = [
            (best[s][0] + scores[word[s:end]], -best[s][1] - 1)
            for s in range(max(0, end - 200), end)
            if word[s:end] in scores
        ]
        score, fewest = max(found)
        best.append((score, -fewest))
    return best[-1][1]


def test_trie_shares_prefixes_and_counts_right(scores):
    counter = token_counts.TrieCounter(scores)
    words = ["the", "then", "thence", "thenceforth", " the", "thx", "中文", "a" * 300]
    counter.add(set(words))
    assert {w: counter.terminals[w] for w in words} == {w: plain_count(w.encode(), scores) for w in words}
    paths = {w.encode()[:i] for w in words for i in range(1, len(w.encode()) + 1)}
    assert counter.nodes == len(paths)  # each trie node once


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="abthe ", min_size=1, max_size=9), min_size=1, max_size=30))
def test_trie_equals_plain_dynamic_programming(scores, found):
    counter = token_counts.TrieCounter(scores, max_terminals=7)  # emptied in between
    for word in found:
        counter.add({word})
        assert counter.terminals[word] == plain_count(word.encode(), scores)


def test_token_counts(spark, scores):
    texts = odd_texts()
    got = {
        r["doc_id"]: (r["n_pretokens"], r["n_tokens"])
        for r in token_counts.token_counts(table(spark, texts), RANKS, public_tokenizers.PATTERN).collect()
    }
    for i, text in enumerate(texts):
        parts = regex.findall(public_tokenizers.PATTERN, text or "")
        known = {p: plain_count(p.encode(), scores) for p in set(parts)}
        assert got[i] == (len(parts), sum(known[p] for p in parts))


def check_packing(docs, rows, window):
    tokenizer = Tokenizer.from_file(BPE)
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append(r)
    padded = 0
    for doc_id, text in docs:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        at = 0
        for r in sorted(pieces[doc_id], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
    for rows_ in sequences.values():
        at = 0
        for r in sorted(rows_, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= window
        padded += at & (at - 1) != 0
    return padded


def test_packing_covers_each_id_once(spark):
    texts = [t for t in odd_texts() if t != "one"] + ["text with <|endoftext|> inside"]
    docs = table(spark, texts).coalesce(1)
    rows = packing.pack(docs, BPE, RANKS, public_tokenizers.PATTERN).collect()
    assert check_packing(list(enumerate(texts)), rows, 1024) <= 1


def test_packing_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    rows = queries.op6_multi_length_packing(spark, SF).collect()
    assert check_packing(docs, rows, 1024) <= 1
    groups = defaultdict(lambda: defaultdict(set))
    for r in rows:
        groups[r["tier"]][r["step_group"]].add(r["sequence_id"])
    for tier, members in groups.items():
        sizes = sorted(len(s) * tier for s in members.values())
        assert all(s == packing.STEP_TOKENS for s in sizes[1:])  # all but one of a tier are full


def test_packing_repeated_rows_are_documents_of_their_own(spark):
    rows = packing.pack(table(spark, ["a b", "a b"], ids=[5, 5]).coalesce(1), BPE).collect()
    assert sum(r["length"] for r in rows) == 2 * rows[0]["doc_tokens"]


def test_language_query_on_held_out(spark):
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries.op9_compression_language_id(spark, SF).collect()
    assert len(rows) == len(docs) and all(0 <= r["score"] <= 1 for r in rows)
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
    held = [r for r in rows if r["held_out"]]
    right = sum(r["lang_pred"] == docs[r["doc_id"]]["lang"] for r in held)
    assert right >= 0.9 * len(held)
    sure = [r for r in held if r["accepted"]]
    assert sum(r["lang_pred"] == docs[r["doc_id"]]["lang"] for r in sure) >= 0.95 * len(sure)


def test_language_edge_cases(spark):
    dictionaries = {"en": b"the house is on the hill and the dog", "de": b"das haus ist auf dem berg und der hund"}
    texts = [None, "", "123 !!", "the house and the dog is on the hill", "das haus und der hund auf dem berg"]
    got = {r["doc_id"]: r for r in language.identify(table(spark, texts), dictionaries).collect()}
    assert [got[i]["lang_pred"] for i in range(5)] == ["und", "und", "und", "en", "de"]
    assert not got[0]["accepted"] and got[0]["score"] == 0
    nothing = language.identify(table(spark, texts), {}).collect()
    assert {r["lang_pred"] for r in nothing} == {"und"}
    learned = language.train_dictionaries(table(spark, ["abc", None, "d"], lang=None), F.lit(True))
    assert learned == {}
    assert math.isclose(sum(1 for r in got.values() if r["accepted"]), 2)


def test_empty_tables(spark):
    empty = table(spark, [])
    assert token_counts.token_counts(empty, RANKS, public_tokenizers.PATTERN).count() == 0
    assert packing.pack(empty, BPE).count() == 0
    assert language.identify(empty, {"en": b"x"}).count() == 0
