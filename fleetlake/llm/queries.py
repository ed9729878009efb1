"""Queries over the operators of this package, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake.llm import (
    bagminhash,
    centroid_clustering,
    exact_dedup,
    fill_in_middle,
    fuzzy_lines,
    hmm,
    language,
    mixing,
    packing,
    quality,
    secret_scan,
    sql,
    substring_dedup,
    token_counts,
)
from fleetlake.llm.common import crc_remainder, documents

Query = Callable[[SparkSession, str], DataFrame]

BPE = "byte_bpe_50k.json"
RANKS = "byte_bpe_50k.tiktoken"


# The mix: domains are dealt from the source name; * stands for any name at its level.
MIX_LEVELS_SQL = {
    "domain": "'domain' || CAST(CAST('0x' || substr(md5(coalesce(source, '')), 1, 4) AS BIGINT) % 3 AS VARCHAR)",
    "lang": "lang",
    "source": "source",
}
MIX_WEIGHTS = {
    ("domain0",): 5,
    ("domain1",): 3,
    ("domain2",): 2,
    ("*", "en"): 8,
    ("*", "de"): 4,
    ("*", "fr"): 4,
    ("*", "es"): 4,
    ("*", "*", "src0"): 3,
}
MIX_BUDGET_SHARE = 0.6
MIX_EPOCHS = 2
MIX_SEED = 11


def mix_levels() -> dict[str, Column]:
    name = F.coalesce(F.col("source"), F.lit("")).cast("binary")
    number = F.conv(F.substring(F.md5(name), 1, 4), 16, 10).cast("bigint") % 3
    return {"domain": F.concat(F.lit("domain"), number), "lang": F.col("lang"), "source": F.col("source")}


def op1_hierarchical_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(
        documents(spark, sf_dir), mix_levels(), MIX_WEIGHTS, MIX_BUDGET_SHARE, MIX_EPOCHS, MIX_SEED
    )


def op2_learned_decision_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.judge(documents(spark, sf_dir), labels)


def op3_hidden_markov_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm.score_documents(documents(spark, sf_dir), crc_remainder(F.col("doc_id"), 10) == 0)


def op4_chunk_recipe_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(documents(spark, sf_dir)).drop("n_chunks")


def op5_bagminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bagminhash.near_classes(documents(spark, sf_dir)).drop("key")


def op6_multi_length_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(
        documents(spark, sf_dir),
        public_tokenizers.path(BPE),
        public_tokenizers.path(RANKS),
        public_tokenizers.PATTERN,
    )


def op7_seed_and_extend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(documents(spark, sf_dir)).drop("spans")


def op8_simhash_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fuzzy_lines.remove_lines(documents(spark, sf_dir)).select(
        "doc_id",
        F.col("__n_lines").alias("n_lines"),
        F.col("__n_removed").alias("n_removed"),
        F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"),
    )


def op9_compression_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held_out = crc_remainder(F.col("doc_id"), 4) == 2
    dictionaries = language.train_dictionaries(docs, ~held_out)
    found = language.identify(docs, dictionaries).withColumn("held_out", held_out)
    return found.select("doc_id", "held_out", "lang_pred", "score", "accepted")


def op10_trie_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(
        documents(spark, sf_dir), public_tokenizers.path(RANKS), public_tokenizers.PATTERN
    )


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle.fill_in_middle(documents(spark, sf_dir)).select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(F.col("restored").cast("binary"), 256).alias("restored_sha256"),
    )


def op12_markov_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = secret_scan.scan(docs, secret_scan.train(docs))
    spans = F.col("spans")
    kinds = F.transform(spans, lambda s: s["kind"])
    ruled = F.filter(spans, lambda s: s["kind"] != "markov")
    return found.select(
        "doc_id",
        *[(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("bigint").alias(f"n_{k}") for k in secret_scan.KINDS],
        F.sha2(secret_scan.span_text(ruled).cast("binary"), 256).alias("base_sha256"),
        secret_scan.span_text(spans).alias("spans"),
    )


def op13_equal_average_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroid_clustering.cluster(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


_QUERIES: dict[str, Query] = {
    "op1_hierarchical_mixing": op1_hierarchical_mixing,
    "op2_learned_decision_list": op2_learned_decision_list,
    "op3_hidden_markov_model": op3_hidden_markov_model,
    "op4_chunk_recipe_dedup": op4_chunk_recipe_dedup,
    "op5_bagminhash": op5_bagminhash,
    "op6_multi_length_packing": op6_multi_length_packing,
    "op7_seed_and_extend": op7_seed_and_extend,
    "op8_simhash_lines": op8_simhash_lines,
    "op9_compression_language_id": op9_compression_language_id,
    "op10_trie_token_counts": op10_trie_token_counts,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_markov_secret_scan": op12_markov_secret_scan,
    "op13_equal_average_clustering": op13_equal_average_clustering,
}

_SQL: dict[str, str] = {
    "op7_seed_and_extend": sql.REPEATS,
    "op4_chunk_recipe_dedup": sql.EXACT_DUPLICATES,
    "op1_hierarchical_mixing": sql.mixing(
        MIX_LEVELS_SQL, MIX_WEIGHTS, MIX_BUDGET_SHARE, MIX_EPOCHS, MIX_SEED
    ),
    "op11_fill_in_middle": sql.FILL_IN_MIDDLE,
    "op13_equal_average_clustering": sql.clustering(),
}


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
