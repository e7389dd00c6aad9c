"""Helpers shared by the training-data operators.

Conventions every operator follows:

* it selects only the columns it needs, so further columns of its input, whatever
  their names, neither collide with its own nor change its result;
* null text counts as the empty text;
* rows are told apart by ``row_key``: rows with the same id *and* the same text are
  repetitions and share one verdict.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.session import scratch_path

#: White space that separates words (fixed by the query contracts): space and \t \n \v \f \r.
WHITE_SPACE = r"[\x20\x09-\x0D]+"
LONG_MAX = (1 << 63) - 1
#: Bytes of an Arrow batch on its way to a Python worker where texts are sent, unless the session sets its own.
BATCH_KEY, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 4_000_000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def write_table(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write ``df`` as Parquet below ``spark.checkpoint.dir`` and read it back.

    A lost executor then re-reads files instead of recomputing, and several readers
    share one computation.  The folder is new for each call.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Jobs that run inside send rows to Python workers in batches of about ``BATCH_BYTES``.

    An Arrow buffer of texts doubles as it fills and lies outside the heap, twice while it
    grows, and a JVM keeps much of what it once took.  Rows and their order stay as they are.
    """
    own = spark.conf.get(BATCH_KEY, None)
    if own is None:
        spark.conf.set(BATCH_KEY, str(BATCH_BYTES))
    try:
        yield
    finally:
        if own is None:
            spark.conf.unset(BATCH_KEY)


def key_columns(doc_id: Column, text: Column) -> list[Column]:
    """Sortable, non-null identity of a row: null ids last, then the id, then a text hash."""
    return [doc_id.isNull().alias("k_null"), F.coalesce(doc_id, F.lit(LONG_MAX)).alias("k_id"),
            F.xxhash64(F.coalesce(text, F.lit(""))).alias("k_hash")]


def boxed(rows: DataFrame) -> DataFrame:
    """Every row as one struct column ``row``, so that no working column can clash with its names."""
    return rows.select(F.struct(*(F.col(f"`{c}`") for c in rows.columns)).alias("row"))


KEY = ["k_null", "k_id", "k_hash"]


def words_of(text: Column) -> Column:
    """The words of a text (null: none)."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), WHITE_SPACE), lambda w: w != "")


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once per row and pass it to ``body``.

    Higher-order functions re-evaluate an outer expression for every element; binding it
    as a lambda variable keeps the work linear.
    """
    return F.transform(F.array(value), body)[0]


def is_broadcastable(rows: int, max_rows: int = 1_000_000) -> bool:
    """Whether a counted table of narrow rows (ids, labels) may be broadcast: at most
    ``max_rows`` rows of a few tens of bytes.  Larger ones take the shuffle join."""
    return rows <= max_rows
