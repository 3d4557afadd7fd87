"""The documents of a corpus, from raw rows to packed training sequences, stage by stage.

Each stage's rows are written to the shared folder and read again as the next one's ``docs``; a
lost executor costs a stage at most what it was doing. All but the last stage return the columns
of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from spendlake.llm import importance, minhash, packing, quality_rules, secrets
from spendlake.session import drop_stored, stored, stored_tables


def good_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.keep_good(docs)


def drawn_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling draws."""
    return importance.keep_drawn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def distinct_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    return minhash.keep_first(docs)


def masked_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked."""
    return secrets.mask_secrets(docs)


def packed_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where the tokens of each document go."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", good_text),
    ("quality_classifier", drawn_text),
    ("near_dedup", distinct_text),
    ("secret_scan", masked_text),
    ("best_fit_packing", packed_text),
]

# Importance weights, MinHash and packing are beyond SQL; the tests hold each stage's operator against plain Python.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of ``documents`` after all stages.

    What a stage stored for itself goes when its rows are written, and these when the next stage's are.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for name, stage in STAGES[:-1]:
        with stored_tables(spark) as kept:
            docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
            kept.append(docs)
        if before is not None:
            drop_stored(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
