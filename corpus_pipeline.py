"""Corpus pipeline: quality rules, toxicity, line de-duplication, near duplicates, packing.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a
DataFrame.  ``run`` writes every stage's result as Parquet below the shared checkpoint
folder and reads it back as the next stage's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyspark.llm import jaccard_join, line_dedup, packing, quality_rules, toxicity
from tallyspark.llm.common import read_table, write_table
from tallyspark.llm.queries import WORD_BPE, tokenizer_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that pass the quality rules of their host."""
    return quality_rules.keep_good(docs, host_column="source")


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that the classifier, fitted on the labelled ones among them, scores below 0.5."""
    return toxicity.drop_toxic(docs, read_table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes out later copies of runs of lines of 50 words or more; documents that are nothing else go."""
    return line_dedup.drop_repeated_lines(docs, min_words=50)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest id of each group linked by five-word shingles at similarity 0.8."""
    return jaccard_join.keep_one(docs, k=5, num=4, den=5)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left into sequences of 4096 tokens: one row per piece."""
    return packing.pack(docs, tokenizer_path(WORD_BPE), end_id=2, capacity=4096, share_memory=True)


STAGES = [("quality_rules", quality), ("toxicity", toxic), ("line_dedup", lines),
          ("jaccard_join", near_duplicates), ("packing", pack)]

#: Toxicity scores and token ids are beyond SQL; tests hold each stage to a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = write_table(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
