"""The corpus pipeline: language ID, exact dedup, near-dedup, mixing, SentencePiece encoding.

Each stage takes (spark, docs, sf_dir) and returns the documents that stay, with the columns of
documents; the last returns their ids. Mixing repeats rows of sources that are taken several times.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from cellweave.llm.exact_dedup import drop_exact
from cellweave.llm.language_id import accepted_documents, fit
from cellweave.llm.mixing import mix_documents
from cellweave.llm.near_dedup import drop_near
from cellweave.llm.piece_viterbi import encode_documents
from cellweave.llm.shared import written


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; null, letterless and doubtful ones go."""
    return accepted_documents(docs, fit(docs))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest identifier."""
    return drop_exact(docs, keep="largest")


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by similarity, the one with the smallest identifier."""
    return drop_near(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights, shuffled within output shards."""
    return mix_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document."""
    return encode_documents(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [("language_id", language), ("exact_dedup", exact), ("near_dedup", near), ("mixing", mix), ("piece_ids", encode)]

#: SQL can't express language ID, verified near-duplicates or piece encoding; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
