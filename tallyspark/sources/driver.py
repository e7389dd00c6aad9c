"""Readers for the driver's parquet tables.

Every reader returns a lazy DataFrame over one parquet path.  Column pruning and
predicate pushdown are left to Catalyst: callers ``select``/``where`` and the
scan's ``ReadSchema`` / ``PushedFilters`` shrink accordingly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown driver table {name!r}")
    return spark.read.parquet(table_path(sf_dir, name))
