"""From raw documents to packed training sequences, in stages.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; what a stage returns is written
as Parquet and read again as the ``docs`` of the next one. All but the last return the columns of
``documents``.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake.llm import bagminhash, fuzzy_lines, mixing, packing, quality
from fleetlake.llm.common import documents, stored
from fleetlake.llm.queries import BPE, MIX_SEED, MIX_WEIGHTS, RANKS, mix_levels

# Share of the words that reach the mix which it takes.
MIX_BUDGET_SHARE = 0.8
# Rows that go to Python at once. Documents are long: the default of 10,000 takes tens of megabytes in
# every buffer on either side, which executors keep from one stage to the next.
ARROW_ROWS = 1_000

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _in_small_batches(stage: Stage) -> Stage:
    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
        return stage(spark, docs, sf_dir)

    return run


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the learned decision list."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that repeat, or nearly repeat, an earlier one."""
    cut = fuzzy_lines.remove_lines(docs)
    n_chars = F.when(F.col("__n_removed") > 0, F.length("text")).otherwise(F.col("n_chars")).cast("bigint")
    return cut.withColumn("n_chars", n_chars).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return bagminhash.keep_one_of_each(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the target mix, each at most once."""
    return mixing.take_mix(docs, mix_levels(), MIX_WEIGHTS, MIX_BUDGET_SHARE, MIX_SEED)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all sequences."""
    return packing.pack(
        docs, public_tokenizers.path(BPE), public_tokenizers.path(RANKS), public_tokenizers.PATTERN
    )


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", _in_small_batches(line_dedup)),
    ("near_dedup", _in_small_batches(near_dedup)),
    ("source_mix", source_mix),
    ("pack", _in_small_batches(pack)),
]

# A learned decision list, edit distances and a tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stored(docs, f"stage-{name}")
    return docs
