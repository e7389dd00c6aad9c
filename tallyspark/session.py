"""SparkSession helpers.

The library never creates a session behind the caller's back except through
``get_session`` (tests, bench, CLI).  On a cluster the session is created by the
platform, and we only *read* settings from it (e.g. ``spark.checkpoint.dir``).
"""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession

# Defaults that matter for correctness (UTC, ANSI) and for scale (AQE, skew join,
# partition coalescing).  Shuffle partitions are sized for local tests; on a
# cluster the platform value wins because ``getOrCreate`` keeps an existing session.
_DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # remove reliable-checkpoint files once their DataFrames are garbage collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int = 8,
                app_name: str = "tallyspark") -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in _DEFAULT_CONF.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("TALLYSPARK_DRIVER_MEMORY", "16g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting points at shared storage and is respected as is.
    Only a ``local`` session may do without: it gets a scratch folder that goes with
    the process.  Executors elsewhere could not read such a folder, so any other
    master without the setting is an error.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        current = _local_folder(spark.sparkContext.master)
        spark.conf.set("spark.checkpoint.dir", current)
    spark.sparkContext.setCheckpointDir(current)
    return current


def _local_folder(master: str) -> str:
    if not re.fullmatch(r"local(\[[^\]]*\])?", master):
        raise ValueError(f"set spark.checkpoint.dir to a folder that every executor of {master} can read")
    folder = tempfile.mkdtemp(prefix="tallyspark-ckpt-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-path of the shared checkpoint folder for materialised intermediate tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"


def materialize(df):
    """Cut lineage at a reuse point: write ``df`` to the shared folder and read it back.

    Parquet rather than ``checkpoint()``: later passes prune columns and push
    filters, and a lost executor re-reads files instead of recomputing.
    """
    path = scratch_path(df.sparkSession, f"table-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def side_by_side(work: Callable, items: Iterable, at_once: int = 8) -> list:
    """``work`` of every item, in order; up to ``at_once`` run at the same time.

    For work made of many short Spark jobs (model fits, small loads): one alone leaves the
    executors idle between its jobs.
    """
    with ThreadPoolExecutor(at_once) as pool:
        return list(pool.map(work, items))
