"""A training corpus from raw documents: the stages, in order, each on all that the last one kept.

Every stage but the last returns the columns of `documents`. A stage's result is written and read
again before the next one, so each starts from a table that no lost executor takes along.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from keepsake.llm import minhash, mixing, quality, tiling, tokens
from keepsake.llm.tables import read, stored
from keepsake.session import new_shared_path


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted on labelled ones, doesn't reject."""
    return quality.accepted(docs, read(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return minhash.representatives(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found."""
    return tiling.decontaminated(docs, read(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their sources takes them: not at all, once or repeatedly."""
    return mixing.mixed(docs)


def write_token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of all documents; a row for each document read back from them."""
    path = new_shared_path(spark, "tokens")
    tokens.write_tokens(docs, path, public_tokenizers.path("byte_bpe_50k.json"))
    return tokens.read_documents(spark, path)


STAGES = [
    ("quality_classifier", keep_quality),
    ("near_duplicates", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("source_mixing", mix_sources),
    ("token_files", write_token_files),
]

# The classifier and the tokenizer cannot be written in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
