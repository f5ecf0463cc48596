"""One query per corpus operator, over its whole table, and the SQL twins."""

from __future__ import annotations

from pyspark.sql import functions as F

import public_tokenizers

from shiplake.llm import (
    bitplanes, bpe, classifier, jaccard_join, language, lexical_search, main_text, mixing, passages, pivot_search, quality, sharding, urls,
)
from shiplake.llm.common import table
from shiplake.llm.oracles import ORACLES


def op1_pivot_search(spark, sf_dir):
    return pivot_search.top_k(table(spark, sf_dir, "embeddings"), k=5, every=50)


def op2_url_filter(spark, sf_dir):
    return urls.judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"), urls.RULES).drop("url")


def op3_main_text(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return main_text.extract(pages, main_text.fit(pages, sample=400))


def op4_source_mix(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    mixed = mixing.mix_sources(docs, weight=mixing.symbol_weight(), carry=["doc_id", "source"])
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op5_quality_rules(spark, sf_dir):
    judged = quality.quality_rules(table(spark, sf_dir, "documents"), carry=["doc_id"])
    return judged.select("doc_id", *quality.ADDED)


def op6_jaccard_join(spark, sf_dir):
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents"), width=4, percent=85)


def op7_feistel_shards(spark, sf_dir):
    return sharding.shard_rows(table(spark, sf_dir, "documents"), shards=16)


def op8_quality_classifier(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = classifier.fit(docs, table(spark, sf_dir, "labels"), sample=20_000)
    return classifier.score_documents(docs, model)


def op9_byte_bpe(spark, sf_dir):
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    encoded = bpe.encode_documents(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)
    return bpe.decode_documents(encoded, ranks).select(
        "doc_id", "n_tokens", F.sha2("token_ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op10_repeated_passages(spark, sf_dir):
    return passages.repeated_passages(table(spark, sf_dir, "documents"), least_words=50, least=0.8)


def op11_rank_order_language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").withColumn(
        "held_out", F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False)))
    profiles = language.fit(docs.where(F.crc32(F.col("doc_id").cast("string")) % 4 != 2))
    return language.predict(docs, profiles, carry=["doc_id", "held_out"])


def op12_shared_term_search(spark, sf_dir):
    return lexical_search.top_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=20)


def op13_bitplane_clusters(spark, sf_dir):
    found = bitplanes.centroid_clusters(table(spark, sf_dir, "embeddings"), clusters=40, rounds=5, salt=2)
    return found.withColumn("centroid_sha256", bitplanes.digest()).drop("centroid")


QUERIES = {f.__name__: f for f in (
    op1_pivot_search, op2_url_filter, op3_main_text, op4_source_mix, op5_quality_rules, op6_jaccard_join, op7_feistel_shards, op8_quality_classifier, op9_byte_bpe, op10_repeated_passages,
    op11_rank_order_language, op12_shared_term_search, op13_bitplane_clusters,
)}
