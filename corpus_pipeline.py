"""From documents to packed token sequences: five stages, each written as Parquet and read by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from salvor.llm import dedup, langid, minhash, mixing, packing
from salvor.llm.common import staged, table

LEAST_LANGUAGE_SCORE = 0.3
# Workers that ran the other stages have less room for words than those that only pack.
KEPT_WORDS = 100_000


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a language that the model knows; texts without a letter, and those that no language claims, go."""
    return langid.recognised(docs, langid.fit(docs), least=LEAST_LANGUAGE_SCORE)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each normalised text, that with the smallest id."""
    return dedup.keep_first(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class, that with the smallest id."""
    return minhash.keep_classes(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights: a row for each time the mix takes a document."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token ids in sequences of 2048."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), keep_ids=True, kept_words=KEPT_WORDS)


STAGES = [("language", language), ("exact", exact), ("near", near), ("mix", mix), ("pack", pack)]

# Trained models, tokenizers and components are beyond SQL; the tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
