"""A corpus made ready for training: each stage is one operator, works on all that the stage before kept, and is
written to the shared folder before the next one starts.

All stages but the last return the columns of documents. A document without words fails the quality rules.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.llm import jaccard_join, packing, quality, secrets, toxicity
from tributary.llm.common import Stage, table

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
END_ID = 1
#: Words a worker remembers while it encodes: few, as it has worked for other stages and keeps its memory.
REMEMBERED = 100_000
NEAR = jaccard_join.Similar(words=5, percent=80)


def harmless(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Toxic documents go."""
    return toxicity.clean(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))


def well_formed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the quality rules go."""
    return quality.kept(docs, quality.learn(docs, table(spark, sf_dir, "labels")))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of linked documents the one with the smallest id stays."""
    return jaccard_join.representatives(docs, NEAR)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked; n_chars, where there is such a column, follows the text."""
    masked = secrets.redacted(docs, secrets.learn_from(docs))
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else masked


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in sequences of 2048."""
    return packing.pack_documents(docs, WORD_BPE, END_ID, remembered=REMEMBERED)


Step = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Step]] = [
    ("toxicity", harmless),
    ("quality", well_formed),
    ("near_duplicates", without_near_copies),
    ("secrets", without_secrets),
    ("packing", packed),
]

#: The models, the tokenizer and the packing are beyond SQL; tests compare the stages with plain versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    stage = Stage(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    before = None
    for name, step in STAGES:
        docs = stage.keep(step(spark, docs, sf_dir), name)
        if before:
            stage.drop(before)
        before = name
    return docs
