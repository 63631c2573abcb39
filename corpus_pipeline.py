"""From raw documents to packed training sequences: five stages, each an operator of grantlens.llm.

A stage takes the session, the documents its predecessor kept and the folder of the tables. All but
the last return the columns of ``documents``. Null, empty and repeated rows are treated as the
operators say: texts without a letter are rejected by the first stage, repeated rows by the second.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from grantlens.llm import language, minhash, mixing, packing, pii
from grantlens.llm.common import read_table, stored

TOKENIZER = "word_bpe_49k.json"

#: Language models, sets of shingles, Feistel networks and merges are not expressible in SQL; see tests/llm.
ORACLE_SQL = None


def identify_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised."""
    return language.accepted(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return minhash.one_of_each(docs)


def replace_private_values(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with pseudonyms for personal data."""
    return pii.with_pseudonyms(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of the sources takes them."""
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences."""
    return packing.pack(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("language", identify_languages),
    ("near_dedup", drop_near_copies),
    ("pseudonyms", replace_private_values),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of the last stage; each stage's result is written before the next one reads it."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
