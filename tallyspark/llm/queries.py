"""The registered queries of the training-data operators, and their oracle SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.llm import (centroids, filter_audit, html_extract, huffman, jaccard_join, line_dedup, packing, piece_dropout,
                            positional_index, quality_rules, syncmers, token_counts, toxicity)
from tallyspark.llm.common import read_table
from tallyspark.session import scratch_path

#: Public tokenizer files (see their README); the operators take any path.
BYTE_BPE, WORD_BPE, PIECE_BPE = "byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.score_quality(read_table(spark, sf_dir, "documents"), host_column="source")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(read_table(spark, sf_dir, "documents"), min_words=50)
    return out.select("doc_id", F.coalesce(F.size(F.split("text", "\n")), F.lit(0)).cast("long").alias("n_lines"),
                      F.size("removed").cast("long").alias("n_removed"), F.col("clean_text").alias("text"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op4_piece_dropout(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    digest = F.sha2(F.coalesce("text", F.lit("")), 256)
    model = tokenizer_path(PIECE_BPE)
    encoded = piece_dropout.encode(docs.select("doc_id", "text", digest.alias("digest")), model, seed=17, dropout=0.1, keep=("digest",))
    return piece_dropout.decode(encoded, model).select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_ids"), F.crc32("ids").alias("ids_crc32"),
        F.length("decoded").cast("long").alias("n_chars"), (F.sha2("decoded", 256) == F.col("digest")).alias("is_lossless"))


def op5_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_pages(read_table(spark, sf_dir, "pages"))


def op6_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.fingerprint_documents(read_table(spark, sf_dir, "documents"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    cache = scratch_path(spark, f"llm-token-cache-{uuid.uuid4().hex}")
    return token_counts.count_tokens(read_table(spark, sf_dir, "documents"), tokenizer_path(BYTE_BPE), cache, limit=512)


def op8_huffman_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = huffman.scratch_files(spark)
    huffman.write_ids(read_table(spark, sf_dir, "documents"), tokenizer_path(WORD_BPE), path, end_id=2)
    return huffman.read_ids(spark, path)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"), tokenizer_path(WORD_BPE), end_id=2, capacity=4096)


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(read_table(spark, sf_dir, "documents"), k=4, num=85, den=100)


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster_vectors(read_table(spark, sf_dir, "embeddings"), k=40, rounds=5, dims=64, scale=256, seed=2)


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return positional_index.decontaminate(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_line_dedup": op2_line_dedup,
    "op3_toxicity": op3_toxicity,
    "op4_piece_dropout": op4_piece_dropout,
    "op5_html_extract": op5_html_extract,
    "op6_syncmers": op6_syncmers,
    "op7_token_counts": op7_token_counts,
    "op8_huffman_ids": op8_huffman_ids,
    "op9_packing": op9_packing,
    "op10_jaccard_join": op10_jaccard_join,
    "op11_centroids": op11_centroids,
    "op12_filter_audit": op12_filter_audit,
    "op13_decontamination": op13_decontamination,
}

ORACLE_SQL: dict[str, str] = {
    "op1_quality_rules": quality_rules.ORACLE_SQL,
    "op2_line_dedup": line_dedup.ORACLE_SQL,
    "op10_jaccard_join": jaccard_join.oracle_sql(4, 85, 100),
    "op11_centroids": centroids.oracle_sql(40, 5, 64, 256, 2),
    "op12_filter_audit": filter_audit.ORACLE_SQL,
    "op13_decontamination": positional_index.ORACLE_SQL,
}
