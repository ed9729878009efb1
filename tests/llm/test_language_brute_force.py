"""Compression classification against one compressor call per text, block and language."""

import math

import pytest
import zstandard
from helpers import odd_texts, table

from fleetlake.llm import language, queries

SF = "/root/testdata/sf0.001"


def plain(text, dictionaries, block=language.BLOCK, level=language.LEVEL, min_margin=language.MIN_MARGIN):
    if not text or not dictionaries or not any(c.isalpha() for c in text):
        return "und", 0.0, False
    data = text.lower().encode()
    sizes = {}
    for lang, content in dictionaries.items():
        held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        held.precompute_compress(level=level)
        sizes[lang] = 0
        for i in range(0, len(data), block):
            one = zstandard.ZstdCompressor(dict_data=held, write_content_size=False)
            sizes[lang] += len(one.compress(data[i : i + block]))
    ranked = sorted((n, lang) for lang, n in sizes.items())
    best, lang = ranked[0]
    score = 1 / sum(math.exp(-20 * (n - best) / best) for n, _ in ranked)
    return lang, score, len(ranked) == 1 or (ranked[1][0] - best) / ranked[1][0] >= min_margin


def test_every_text_as_one_by_one(spark):
    docs = queries.documents(spark, SF)
    dictionaries = language.train_dictionaries(docs, docs.doc_id % 3 > 0)
    assert len(dictionaries) == 4
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in language.identify(docs, dictionaries).collect():
        lang, score, accepted = plain(texts[r["doc_id"]], dictionaries)
        assert (r["lang_pred"], r["accepted"]) == (lang, accepted) and math.isclose(r["score"], score)


@pytest.mark.parametrize("block", [64, 4096])
def test_odd_texts_and_ties(spark, block):
    # Two languages of one content: every size is equal, so the first in order wins and none is accepted.
    same = {"b": b"the quick brown fox", "a": b"the quick brown fox"}
    texts = odd_texts() + ["123 456", "...", "the fox", "x" * 300_000]
    for r in language.identify(table(spark, texts), same, block=block).collect():
        lang, score, accepted = plain(texts[r["doc_id"]], same, block)
        assert (r["lang_pred"], r["accepted"]) == (lang, accepted) and math.isclose(r["score"], score)
        assert r["lang_pred"] in ("und", "a") and not r["accepted"]
    assert {r["lang_pred"] for r in language.identify(table(spark, texts), {}).collect()} == {"und"}


def test_columns_of_the_query(spark):
    assert queries.op9_compression_language_id(spark, SF).columns == ["doc_id", "held_out", "lang_pred", "score", "accepted"]
