"""Language identification by compression (free style: Arrow batches).

For every language a raw-content zstandard dictionary is cut from a bounded sample of labelled
texts. A text is encoded with each dictionary, in blocks so that the dictionary keeps its weight
in a long text, and the language with the smallest total wins. Where the runner-up is within
``min_margin`` of the winner the text is rejected (``accepted`` is false).

The sample is the only bounded part: at most ``sample_rows`` rows and ``dictionary_bytes`` bytes
a language, whichever ends first, taken from all labelled rows by the hash of their identifier: of
each row a piece of twice its share of the bytes, so that short texts still fill the dictionary; where
all texts are long, half of the rows do. Prediction encodes
every whole text and needs no shuffle.

Results: a null text, or one without a letter, is ``und`` with score 0; so is every text if
nothing could be learned. Equal sizes: the language first in order wins. Rows with a null
language teach nothing. Repeated rows are predicted each. Other columns are ignored.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

UNDETERMINED = "und"
SAMPLE_ROWS = 256
DICTIONARY_BYTES = 65_536
BLOCK = 4096
LEVEL = 6
MIN_MARGIN = 0.02
# Sharpness of the score: code lengths differ by some hundredths of a bit per byte of text.
_SHARPNESS = 20.0
SCHEMA = "doc_id bigint, lang_pred string, score double, accepted boolean"


def train_dictionaries(
    docs: DataFrame,
    usable: Column,
    sample_rows: int = SAMPLE_ROWS,
    dictionary_bytes: int = DICTIONARY_BYTES,
) -> dict[str, bytes]:
    """Language → dictionary content, from rows where ``usable`` holds and lang is not null."""
    rank = F.hash(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(17)).cast("long") + (1 << 31)
    labelled = docs.where(usable & F.col("lang").isNotNull() & (F.length("text") > 0)).select(
        F.col("lang").cast("string").alias("lang"), "doc_id", "text", rank.alias("__rank")
    )
    counts = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return {}
    # A language with many rows is thinned by hash before the rows of a language meet.
    share = F.lit(None).cast("double")
    for lang, n in sorted(counts.items()):
        share = F.when(F.col("lang") == lang, min(1.0, 4 * sample_rows / n)).otherwise(share)
    piece = max(1, dictionary_bytes // sample_rows * 2)
    order = Window.partitionBy("lang").orderBy("__rank", "doc_id", "__piece")
    # The piece comes from a place given by the hash, not from the front.
    at = (F.col("__rank") % F.greatest(F.length("text") - piece + 1, F.lit(1))).cast("int") + 1
    sample = (
        labelled.where(F.col("__rank") < share * float(1 << 32))
        .select("lang", "doc_id", "__rank", F.lower(F.substring("text", at, F.lit(piece))).alias("__piece"))
        .withColumn("__n", F.row_number().over(order))
        .where(F.col("__n") <= sample_rows)
        .orderBy("lang", "__n")
        .collect()
    )
    content: dict[str, list[bytes]] = {}
    for row in sample:
        content.setdefault(row["lang"], []).append(row["__piece"].encode())
    return {lang: b"\n".join(pieces)[:dictionary_bytes] for lang, pieces in content.items()}


@functools.lru_cache(maxsize=4)
def _compressors(dictionaries: tuple[tuple[str, bytes], ...], level: int):
    made = []
    for lang, content in dictionaries:
        dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        dictionary.precompute_compress(level=level)
        made.append((lang, zstandard.ZstdCompressor(dict_data=dictionary, write_content_size=False).compress))
    return made


def classify(text: str | None, compressors, block: int, min_margin: float) -> tuple[str, float, bool]:
    if not text or not compressors or not any(map(str.isalpha, text)):
        return UNDETERMINED, 0.0, False
    data = text.lower().encode()
    parts = [data[i : i + block] for i in range(0, len(data), block)]
    sizes = [(sum(len(encode(p)) for p in parts), lang) for lang, encode in compressors]
    best, lang = min(sizes)
    ordered = sorted(s for s, _ in sizes)
    margin = 1.0 if len(ordered) == 1 else (ordered[1] - best) / ordered[1]
    score = 1 / sum(math.exp(-_SHARPNESS * (s - best) / best) for s in ordered)
    return lang, score, margin >= min_margin


def identify(
    docs: DataFrame,
    dictionaries: dict[str, bytes],
    block: int = BLOCK,
    level: int = LEVEL,
    min_margin: float = MIN_MARGIN,
) -> DataFrame:
    """``doc_id``, ``lang_pred`` (the smallest code), ``score`` and ``accepted`` of every row."""
    learned = tuple(sorted(dictionaries.items()))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressors = _compressors(learned, level)
        for batch in batches:
            found = [classify(t, compressors, block, min_margin) for t in batch.column("text").to_pylist()]
            langs, scores, accepted = zip(*found) if found else ((), (), ())
            yield pa.record_batch(
                [
                    batch.column("doc_id"),
                    pa.array(langs, pa.string()),
                    pa.array(scores, pa.float64()),
                    pa.array(accepted, pa.bool_()),
                ],
                names=["doc_id", "lang_pred", "score", "accepted"],
            )

    return docs.selectExpr("cast(doc_id as bigint) doc_id", "cast(text as string) text").mapInArrow(work, SCHEMA)
