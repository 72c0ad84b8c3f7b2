"""Each operator on its whole table, with production parameters, and the SQL that must return the same rows."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hammerprice.llm import (
    alignment,
    byte_bpe,
    conversation_trie,
    exact_dedup,
    near_dedup,
    neighbours,
    packing,
    quality,
    sharding,
    suffix_dedup,
    token_counts,
    toxicity,
    url_filter,
)
from hammerprice.queries.registry import Query
from hammerprice.session import scratch_path

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def _query(sql: str | None = None):
    def register(run: Query) -> Query:
        QUERIES[run.__name__] = run
        if sql:
            ORACLES[run.__name__] = sql
        return run

    return register


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query()
def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    coded = byte_bpe.round_trip(documents, path, public_tokenizers.PATTERN)
    return coded.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@_query()
def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    path = public_tokenizers.path("piece_bpe_32k.model")
    return token_counts.token_counts(documents, path, scratch_path(spark, "token-counts"))


URL_RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]
_TREE = {"min_rows": 20, "min_values": 20, "z": 3.0, "weight": 10.0, "threshold": 0.8}


@_query(url_filter.rules_sql(URL_RULES, **_TREE))
def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter.judge_urls(_table(spark, sf_dir, "pages"), URL_RULES, **_TREE)
    return judged.select("page_id", "host", "path", "rule", "verdict")


@_query(
    """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = max(doc_id) OVER g AS kept,
  sha256(t) AS text_sha256
FROM (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents)
WINDOW g AS (PARTITION BY t)"""
)
def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(_table(spark, sf_dir, "documents"))


@_query()
def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack(_table(spark, sf_dir, "documents"), path).drop("ids")


@_query()
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    learned = labels.where(~toxicity.held_out(F.col("doc_id"))).select("doc_id", F.col("toxic").alias("label"))
    scored = toxicity.toxicity(documents, learned)
    return scored.select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
        "evidence",
    )


@_query()
def op8_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    embeddings = _table(spark, sf_dir, "embeddings")
    return neighbours.nearest(embeddings, F.pmod(F.col("vec_id"), F.lit(20)) == 0, k=20)


@_query()
def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality.quality(_table(spark, sf_dir, "documents"))
    return scored.select("doc_id", F.round("score", 6).alias("score"), "kept")


@_query()
def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_groups(_table(spark, sf_dir, "documents"), words=3, percent=85)


@_query()
def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.without_repeats(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@_query()
def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = sharding.assign_shards(_table(spark, sf_dir, "documents"), n_shards=40)
    return shards.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@_query()
def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = conversation_trie.ordered_turns(_table(spark, sf_dir, "conversations"))
    borrowed = F.pmod(F.crc32(F.col("conv_id").cast("string")), F.lit(4))
    return conversation_trie.trie(conversation_trie.rebuilt_paths(turns, borrowed, every=20))


@_query()
def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return alignment.linked_counts(_table(spark, sf_dir, "documents"), *paths).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )
