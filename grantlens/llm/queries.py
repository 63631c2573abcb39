"""The registered queries of this subpackage and their checking SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from grantlens.llm import (
    alignment,
    divergence,
    language,
    minhash,
    mixing,
    packing,
    pii,
    quality,
    simhash,
    substring,
    suffix,
    topk,
    toxicity,
)
from grantlens.llm import sql as checking
from grantlens.llm.common import read_table

TOKENIZER = "word_bpe_49k.json"
BYTE_TOKENIZER, PIECE_TOKENIZER = "byte_bpe_50k.json", "piece_bpe_32k.model"


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.graded(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.without_repeats(read_table(spark, sf_dir, "documents"))


def op3_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.integer_vectors(read_table(spark, sf_dir, "embeddings"))
    return topk.top_k(vectors, vectors.where("vec_id % 100 = 0"))


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(read_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op5_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonym_report(read_table(spark, sf_dir, "documents"))


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.with_components(read_table(spark, sf_dir, "documents"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.fingerprints(read_table(spark, sf_dir, "documents"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.without_repeats(read_table(spark, sf_dir, "documents"))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identified(read_table(spark, sf_dir, "documents"))


def op10_sequence_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(read_table(spark, sf_dir, "documents"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = (public_tokenizers.path(name) for name in (BYTE_TOKENIZER, PIECE_TOKENIZER))
    return alignment.alignment_digests(read_table(spark, sf_dir, "documents"), *paths)


def op13_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.with_quality(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_toxicity, op2_suffix_dedup, op3_exact_top_k, op4_source_mixing, op5_pseudonyms, op6_minhash, op7_simhash,
        op8_substring_dedup, op9_language, op10_sequence_packing, op11_divergence,
        op12_alignment, op13_quality,
    )} | {"pipeline": corpus_pipeline.run}


def all_sql() -> dict[str, str]:
    return {"op3_exact_top_k": checking.TOP_K, "op4_source_mixing": checking.MIXING, "op11_divergence": checking.DIVERGENCE}
