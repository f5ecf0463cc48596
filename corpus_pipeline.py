"""The corpus pipeline: documents in, token ids out, each stage on all that its predecessor kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from shiplake.llm import bpe, jaccard_join, mixing, passages, quality
from shiplake.llm.common import stage, table


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality rules: documents that they reject go."""
    return quality.quality_rules(docs).where("kept").select(*docs.columns)


def keep_distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join on five-word shingles at 0.8: one document of each group stays."""
    return jaccard_join.keep_one(docs, width=5, percent=80)


def cut_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Substring dedup: passages that an earlier document holds are cut out of the later one."""
    return with_length(passages.remove_repeats(docs, least_words=50, least=0.8))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing: one row for each time the mix takes a document, whole."""
    return mixing.mixed_copies(mixing.mix_sources(docs, weight=mixing.symbol_weight(), whole=True), docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE: the token ids of every row, and checksums of the ids and of what they decode to."""
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    decoded = bpe.decode_documents(bpe.encode_documents(docs, ranks, public_tokenizers.PATTERN), ranks)
    return decoded.select(
        "doc_id", "n_tokens", "token_ids", F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def with_length(docs: DataFrame) -> DataFrame:
    """n_chars follows the text."""
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


STAGES = [
    ("quality rules", keep_good),
    ("n-gram Jaccard join", keep_distinct),
    ("substring dedup", cut_passages),
    ("source mix", mix),
    ("byte-level BPE", tokens),
]

# near-duplicate search by signatures and the merges of byte pairs have no form in SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name.lower().replace(" ", "-"))
    return docs
