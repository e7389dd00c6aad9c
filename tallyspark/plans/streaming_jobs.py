"""Streaming queries X1, X2: run over the transactions staged as files, compared with batch."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.plans.fraud import V2_SQL
from tallyspark.plans.registry import register
from tallyspark.session import materialize, scratch_path
from tallyspark.sources.shaped import transactions, with_views
from tallyspark.sources.sinks import read_table
from tallyspark.streaming import pipelines as sp


def stage_transactions(spark: SparkSession, sf_dir: str, n_files: int = 8) -> tuple[str, object]:
    """Write the transactions as files that arrive in event-time order (the stream's input).

    Each event-time range is written as its own append, so file modification
    times follow event time the way a live feed's do.
    """
    t = materialize(transactions(spark, sf_dir))  # each range reads its own row groups
    path = scratch_path(spark, f"stream-src-{uuid.uuid4().hex}")
    bounds = t.agg(F.percentile_approx("step", [i / n_files for i in range(1, n_files)], 1000).alias("b")).first()["b"]
    edges = [None, *sorted(set(bounds)), None]
    for lo, hi in zip(edges[:-1], edges[1:]):
        part = t
        if lo is not None:
            part = part.where(F.col("step") >= lo)
        if hi is not None:
            part = part.where(F.col("step") < hi)
        part.write.mode("append").parquet(path)
    return path, t.schema


X1_SQL = with_views("SELECT txn_id, is_flagged_rule FROM scored_transactions", "transactions")


@register("x1_streaming_rule_flags", X1_SQL, ids=("X1", "P24", "A16"))
def x1_streaming_rule_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    src, schema = stage_transactions(spark, sf_dir)
    out = scratch_path(spark, f"stream-flags-{uuid.uuid4().hex}")
    q = sp.start_flagging(sp.read_transaction_stream(spark, src, schema), out, out + "_ckpt")
    q.awaitTermination()
    return spark.read.parquet(out).select("txn_id", "is_flagged_rule")


@register("x2_streaming_daily_kpis", V2_SQL, ids=("X2", "V2"))
def x2_streaming_daily_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    src, schema = stage_transactions(spark, sf_dir)
    table = scratch_path(spark, f"stream-kpis-{uuid.uuid4().hex}")
    q = sp.start_daily_kpis(sp.read_transaction_stream(spark, src, schema), table, table + "_ckpt")
    q.awaitTermination()
    k = read_table(spark, table)
    return k.select("txn_day", "txn_type", "txn_count", "fraud_count",
                    F.col("total_amount").cast("double").alias("total_amount"))


# arrivals of the accounted stream: every 31st transaction of the first quarter of the hours is held back
# to the end (late), every 50th of the others comes a second time at the end (repeated)
X1A_SQL = with_views("""
SELECT COUNT(*) + COUNT(*) FILTER (WHERE again) AS n_arrived, COUNT(*) FILTER (WHERE NOT held) AS n_flagged,
       COUNT(*) FILTER (WHERE again) AS n_repeated, COUNT(*) FILTER (WHERE held) AS n_late, COUNT(*) FILTER (WHERE held) AS n_repaired,
       CAST(SUM(is_flagged_rule) AS BIGINT) AS n_rule
FROM (SELECT s.txn_id, is_flagged_rule, held, NOT held AND s.txn_id % 50 = 0 AS again
      FROM scored_transactions s
      JOIN (SELECT txn_id, txn_id % 31 = 0 AND step < lo + (hi - lo) // 4 AS held
            FROM transactions, (SELECT MIN(step) AS lo, MAX(step) AS hi FROM transactions) e) h ON h.txn_id = s.txn_id) a""",
                     "transactions")


def stage_arrivals(spark: SparkSession, sf_dir: str, n_files: int = 4) -> tuple[str, object]:
    """The transactions as files by hour range, one a batch, then a file of held back and repeated rows."""
    t = materialize(transactions(spark, sf_dir))
    path = scratch_path(spark, f"stream-arrivals-{uuid.uuid4().hex}")
    lo, hi = t.agg(F.min("step"), F.max("step")).first()
    held = (F.col("txn_id") % 31 == 0) & (F.col("step") < lo + (hi - lo) // 4)
    for i in range(n_files):
        a, b = (lo + (hi + 1 - lo) * j // n_files for j in (i, i + 1))
        t.where(~held & (F.col("step") >= a) & (F.col("step") < b)).coalesce(1).write.mode("append").parquet(path)
    t.where(held | (~held & (F.col("txn_id") % 50 == 0))).coalesce(1).write.mode("append").parquet(path)
    return path, t.schema


@register("x1_arrivals_accounted", X1A_SQL, ids=("X1", "P24", "A16"))
def x1_arrivals_accounted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every arrival is flagged, repeated or late; the repair run then puts the late ones in."""
    src, schema = stage_arrivals(spark, sf_dir)
    out = scratch_path(spark, f"stream-accounted-{uuid.uuid4().hex}")
    q = sp.start_accounting(sp.read_transaction_stream(spark, src, schema, max_files_per_trigger=1), out, out + "_ckpt")
    q.awaitTermination()
    sp.repair_late(spark, out, out + "_repaired")
    first = spark.read.parquet(out).select("status", "is_flagged_rule", F.lit(1).alias("n"))
    fixed = spark.read.parquet(out + "_repaired").where("status = 'repaired'").select("status", "is_flagged_rule", F.lit(0).alias("n"))
    count = lambda s: F.count_if(F.col("status") == s)
    return first.unionByName(fixed).agg(
        F.sum("n").cast("long").alias("n_arrived"), count("flagged").alias("n_flagged"), count("repeated").alias("n_repeated"),
        count("late").alias("n_late"), count("repaired").alias("n_repaired"),
        F.sum(F.when(F.col("status").isin("flagged", "repaired"), F.col("is_flagged_rule"))).cast("long").alias("n_rule"))
