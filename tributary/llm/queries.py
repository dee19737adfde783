"""One query for each operator, over whole tables, and the SQL that checks those SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.llm import (
    byte_bpe, collocations, html_text, jaccard_join, packing, permutation_index, quality, secrets, sharding, substring_dedup, token_files, toxicity,
    vector_codes,
)
from tributary.llm.common import table
from tributary.llm.oracles import ORACLES
from tributary.session import scratch_path

__all__ = ["ORACLES", "QUERIES"]

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.tiktoken")
END_ID = 1
SHARDS = [f"shard-{i:03}" for i in range(64)]


def op1_secret_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return secrets.scan(docs, secrets.learn_from(docs))


def op2_permutation_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shard of every document, and its shard once the last one is gone."""
    docs = table(spark, sf_dir, "documents").select("doc_id")
    placed = sharding.place(docs, ["doc_id"], SHARDS)
    return sharding.place(placed, ["doc_id"], SHARDS[:-1], shard_col="shard_without_last").select(
        "doc_id", sharding.slot_of(F.col("doc_id")).alias("slot"), "shard", "shard_without_last"
    )


def op3_ordinal_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.round_trip(table(spark, sf_dir, "documents"), BYTE_BPE, public_tokenizers.PATTERN)


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-store")
    token_files.write_tokens(table(spark, sf_dir, "documents"), path, WORD_BPE, END_ID)
    return token_files.read_tokens(spark, path, with_ids=False)


def op6_boosted_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.judge(docs, quality.learn(docs, table(spark, sf_dir, "labels")))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), WORD_BPE, END_ID, with_ids=False)


def op8_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return permutation_index.nearest(table(spark, sf_dir, "embeddings"), every=50, k=5)


def op9_html_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.link(table(spark, sf_dir, "documents"), jaccard_join.Similar(words=3, percent=90))


def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = substring_dedup.parse(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return parsed.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = vector_codes.compress(table(spark, sf_dir, "embeddings"))
    return coded.select("vec_id", "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"))


def op13_phrase_stripes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secret_formats": op1_secret_formats,
    "op2_permutation_table": op2_permutation_table,
    "op3_ordinal_toxicity": op3_ordinal_toxicity,
    "op4_byte_bpe": op4_byte_bpe,
    "op5_token_files": op5_token_files,
    "op6_boosted_quality": op6_boosted_quality,
    "op7_packing": op7_packing,
    "op8_permutation_index": op8_permutation_index,
    "op9_html_layout": op9_html_layout,
    "op10_jaccard_join": op10_jaccard_join,
    "op11_substring_dedup": op11_substring_dedup,
    "op12_vector_codes": op12_vector_codes,
    "op13_phrase_stripes": op13_phrase_stripes,
}
