"""From raw documents to packed training sequences, as stages that each read what the one before has written.

The stages share executors, so those with Python tasks bound the batches that Spark sends to them by bytes.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.llm import exact_dups, langid, near_dups, packing, quality
from clickloom.llm.batches import bound_batches
from clickloom.session import scratch_path, stored

LEAST_QUALITY = 0.3


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop what the quality classifier, trained on the labelled documents, rejects."""
    bound_batches(spark)
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = quality.with_quality(docs, model, score_col="__score")
    return scored.where(F.col("__score") >= LEAST_QUALITY).select(docs.columns)


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a letter and those far from every language; with no labelled one, no language is known and none is far."""
    bound_batches(spark)
    model = langid.train(docs)
    if not model.languages:
        return docs
    # columns named like the model's keep their values under other names meanwhile
    aside = {c: f"__own_{c}" for c in docs.columns if c in ("lang_pred", "score", "rejected")}
    kept = langid.with_language(docs.withColumnsRenamed(aside), model).where(~F.col("rejected"))
    return kept.select(*(F.col(f"`{aside.get(c, c)}`").alias(c) for c in docs.columns))


def no_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one of each group of equal texts."""
    return exact_dups.without_copies(docs).select(docs.columns)


def no_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near copies."""
    bound_batches(spark)
    return near_dups.without_near_copies(docs).select(docs.columns)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Fill training sequences with documents that share words."""
    bound_batches(spark)
    return packing.packed(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality", good_quality),
    ("language", known_language),
    ("exact_dups", no_exact_copies),
    ("near_dups", no_near_copies),
    ("packing", packed_sequences),
]

#: SQL cannot train the classifiers; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), scratch_path(spark, f"stage-{name}"))
    return STAGES[-1][1](spark, docs, sf_dir)
