"""Structured Streaming re-aims of the batch jobs.

X1 - rule flags on arriving transactions: file source -> event time as a
     ``timestamp`` instant (watermarks reject ``timestamp_ntz``) -> watermark ->
     ``dropDuplicatesWithinWatermark(txn_id)`` -> the same rule Column as batch
     -> append to a Parquet sink.  ``start_accounting`` puts out every arrival with its
     status, flagged, repeated or late, and ``repair_late`` runs later over the late ones.
X2 - daily KPIs per transaction type: tumbling 1-day event-time windows with a
     watermark, **update** mode (append would hold back the newest windows), and
     a keyed upsert of the changed (day, type) rows into the KPI table inside
     ``foreachBatch``.  The table is bucketed by day, so a batch rewrites its own days
     only, and its manifest keeps the number of the last batch, so a replay does nothing.

Both run with ``trigger(availableNow=True)`` for bounded backfills and with a
processing-time trigger in production; checkpoints live in the shared folder.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from datetime import datetime, timezone

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import ArrayType, LongType, StructType

from tallyspark.functions.risk import rule_flag
from tallyspark.sources.buckets import BucketTable
from tallyspark.sources.shaped import STEP_ANCHOR

DEDUP_WATERMARK, DEDUP_MEMORY = "2 hours", "30 days"
_ANCHOR_EPOCH_S = int(datetime.fromisoformat(STEP_ANCHOR).replace(tzinfo=timezone.utc).timestamp())
KPI_WATERMARK = "2 days"
STATE_BUCKETS = 1024  # states that share the ids flagged


def event_time(step: str = "step") -> F.Column:
    """Simulated hour -> event instant (UTC anchor + step hours) as TIMESTAMP, the type
    watermarks require; built from epoch seconds so the session time zone plays no part."""
    return F.timestamp_seconds(F.lit(_ANCHOR_EPOCH_S) + F.col(step).cast("long") * 3600)


def read_transaction_stream(spark: SparkSession, path: str, schema: StructType,
                            max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema).format("parquet")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path).withColumn("event_time", event_time())


def flag_stream(stream: DataFrame, watermark: str = DEDUP_WATERMARK) -> DataFrame:
    """X1 transformation: dedup by id within the watermark, then the shared rule expression."""
    return (stream.withWatermark("event_time", watermark)
                  .dropDuplicatesWithinWatermark(["txn_id"])
                  .withColumn("is_flagged_rule", rule_flag()))


def start_flagging(stream: DataFrame, out_path: str, checkpoint: str, available_now: bool = True,
                   watermark: str = DEDUP_WATERMARK):
    """A transaction that arrives later than ``watermark`` behind the newest is left to a batch run."""
    w = (flag_stream(stream, watermark).drop("event_time").writeStream.format("parquet").outputMode("append")
         .option("path", out_path).option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def arrival_status(stream: DataFrame, watermark: str = DEDUP_WATERMARK, remember: str | None = DEDUP_MEMORY) -> DataFrame:
    """X1 with nothing dropped: every arrival with its rule flag and ``status``.

    ``repeated`` - its id has been flagged before, exactly, whatever the event times;
    ``late`` - its event time lies behind the watermark, so it is left to ``repair_late``;
    ``flagged`` - the first arrival of its id.  The ids flagged are kept in ``STATE_BUCKETS``
    keyed states by the id's hash, so a batch calls Python once a bucket and not once an id; an
    id is forgotten after ``remember`` without a further arrival (None: never).  The timer
    runs on processing time: an event-time one would have Spark drop late rows unseen.  With
    timers a query goes on for ever, so bounded runs have none; a checkpoint belongs to one
    of the two.
    """
    flagged = stream.withColumn("is_flagged_rule", rule_flag())
    columns = flagged.columns
    schema = StructType([*flagged.schema.fields]).add("status", "string")
    kept = StructType().add("ids", ArrayType(flagged.schema["txn_id"].dataType)).add("seen", ArrayType(LongType()))
    keep_ms = int(pd.Timedelta(remember).total_seconds() * 1000) if remember else None

    def account(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        known = dict(zip(*state.get)) if state.exists else {}  # id -> time of its last arrival
        now = state.getCurrentProcessingTimeMs() if keep_ms else 0
        for frame in () if state.hasTimedOut else frames:
            late = frame["event_time"].astype("datetime64[ns]").astype("int64") // 1_000_000 < state.getCurrentWatermarkMs()
            status = []
            for i, x in zip(frame["txn_id"].tolist(), late):
                i = None if key[0] < 0 else i
                status.append("repeated" if i in known else "late" if x else "flagged")
                if status[-1] != "late":
                    known[i] = now
            yield frame[columns].assign(status=status)
        if keep_ms:
            known = {i: t for i, t in known.items() if t + keep_ms > now}
        if known:
            state.update(([*known], [*known.values()]))
            if keep_ms:
                state.setTimeoutDuration(max(1, min(known.values()) + keep_ms - now))
        elif state.exists:
            state.remove()

    # rows without an id have a bucket of their own: pandas would turn the ids beside them into floats
    bucket = F.when(F.col("txn_id").isNull(), F.lit(-1)).otherwise(F.pmod(F.xxhash64("txn_id"), F.lit(STATE_BUCKETS)))
    return flagged.withWatermark("event_time", watermark).withColumn("_bucket", bucket.cast("int")).groupBy("_bucket").applyInPandasWithState(
        account, schema, kept, "append",
        GroupStateTimeout.ProcessingTimeTimeout if keep_ms else GroupStateTimeout.NoTimeout)


def start_accounting(stream: DataFrame, out_path: str, checkpoint: str, available_now: bool = True,
                     watermark: str = DEDUP_WATERMARK, remember: str = DEDUP_MEMORY):
    """Every arrival lands below ``out_path/status=...``: flagged, repeated or late."""
    w = (arrival_status(stream, watermark, None if available_now else remember).drop("event_time").writeStream.format("parquet").outputMode("append")
         .partitionBy("status").option("path", out_path).option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def repair_late(spark: SparkSession, out_path: str, repaired_path: str) -> None:
    """Batch run over the late arrivals: the first of each id that was never flagged is ``repaired``,
    the others are ``repeated``.  Written as one table partitioned by status, over an earlier run's."""
    landed = spark.read.parquet(out_path)
    late = landed.where("status = 'late'").drop("status")
    done = landed.where("status = 'flagged'").select(F.col("txn_id").alias("done_id"))
    new = late.join(done, F.col("txn_id") == F.col("done_id"), "left_anti")
    columns = [F.col(f"`{c}`") for c in late.columns]
    per_id = new.groupBy("txn_id").agg(F.count(F.lit(1)).alias("n"), F.min_by(F.struct(*columns), F.struct("step", F.xxhash64(*columns))).alias("row"))
    repaired = per_id.select("row.*", F.lit("repaired").alias("status"), (F.col("n") - 1).alias("n_repeated"))
    repeated = late.join(done, F.col("txn_id") == F.col("done_id"), "left_semi").select(
        "*", F.lit("repeated").alias("status"), F.lit(1).cast("long").alias("n_repeated"))
    repaired.unionByName(repeated).write.mode("overwrite").partitionBy("status").parquet(repaired_path)


def daily_kpi_stream(stream: DataFrame, watermark: str = KPI_WATERMARK) -> DataFrame:
    """X2 aggregation: one row per (day window, type) with counts and amount."""
    return (stream.withWatermark("event_time", watermark)
                  .groupBy(F.window("event_time", "1 day"), "txn_type")
                  .agg(F.count(F.lit(1)).cast("bigint").alias("txn_count"),
                       F.sum("is_fraud").cast("bigint").alias("fraud_count"),
                       F.sum("amount").alias("total_amount"))
                  # windows are aligned to UTC epoch days; the day number gives the date directly
                  .select(F.date_from_unix_date(F.floor(F.unix_seconds(F.col("window.start")) / 86400).cast("int"))
                          .alias("txn_day"), "txn_type", "txn_count",
                          "fraud_count", "total_amount"))


def upsert_batch(table_dir: str, keys: list[str]):
    """foreachBatch body: replace the rows of the changed keys, keep all others.

    Every attempt writes a folder of its own and then moves the ``_current`` marker, so
    a failure in the middle never touches the table that readers see.  A replayed batch
    puts the same rows in again, which changes nothing.  Folders that neither the marker
    nor its predecessor names are removed.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        from tallyspark.sources.sinks import _fs

        marker, fs = _fs(spark, f"{table_dir}/_current")
        changed = batch.dropDuplicates(keys)
        previous = None
        if fs.exists(marker):
            stream = fs.open(marker)
            previous = str(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))  # noqa: SLF001
            stream.close()
            current = spark.read.parquet(previous)
            merged = current.join(changed.select(*keys), keys, "left_anti").unionByName(changed)
        else:
            merged = changed
        version = f"{table_dir}/batch-{batch_id}-{uuid.uuid4().hex}"
        merged.write.parquet(version)
        out = fs.create(marker, True)
        out.write(bytearray(version.encode()))
        out.close()
        keep = {path.rsplit("/", 1)[-1] for path in (version, previous) if path}
        for entry in fs.listStatus(marker.getParent()):  # a few folders
            name = entry.getPath().getName()
            if name.startswith("batch-") and name not in keep:
                fs.delete(entry.getPath(), True)

    return write


def upsert_days(table_dir: str, writer: str = "daily_kpis"):
    """foreachBatch body: put the changed (day, type) rows into a table bucketed by day."""
    keys = ["txn_day", "txn_type"]

    def write(batch: DataFrame, batch_id: int) -> None:
        table = BucketTable(batch.sparkSession, table_dir)
        if table.manifest() is None:
            table.create(batch.limit(0), keys, n_buckets=1, by="unix_date(txn_day)")
        table.update(batch, [c for c in batch.columns if c not in keys], insert=True, replace_nulls=True, batch=(writer, batch_id))

    return write


def start_daily_kpis(stream: DataFrame, table_dir: str, checkpoint: str, available_now: bool = True,
                     watermark: str = KPI_WATERMARK):
    """Rows later than ``watermark`` behind the newest do not change their day; a batch run puts them in."""
    w = (daily_kpi_stream(stream, watermark).writeStream.outputMode("update")
         .foreachBatch(upsert_days(table_dir))
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
