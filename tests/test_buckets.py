"""Bucketed tables: updates rewrite only touched buckets, duplicates are rejected, versions are atomic."""

import os
import uuid

import pytest
from pyspark.sql import functions as F

from tallyspark.session import scratch_path
from tallyspark.sources.buckets import BucketTable


@pytest.fixture()
def table(spark):
    t = BucketTable(spark, scratch_path(spark, f"test-buckets-{uuid.uuid4().hex}"))
    df = spark.range(1000).select("id", (F.col("id") * 2).alias("v"), F.lit("old").alias("note"))
    assert t.create(df, ["id"], n_buckets=8) == 1000
    return t


def _files(t):
    found = {}
    for b, folder in t.manifest().folders.items():
        at = f"{folder}/_bucket={b}"
        found[b] = {f: os.stat(f"{at}/{f}").st_mtime_ns for f in os.listdir(at) if f.endswith(".parquet")}
    return found


def test_only_touched_buckets_are_rewritten(spark, table):
    before, folders = _files(table), dict(table.manifest().folders)
    counts = table.update(spark.createDataFrame([(5, 500), (5000, 1)], "id long, v long"), ["v"])
    after = _files(table)
    assert (counts.updated, counts.unmatched, counts.rejected_keys) == (1, 1, 0)
    assert {b for b in before if before[b] != after[b]} <= set(map(str, counts.touched)) and len(counts.touched) <= 2
    assert sum(table.manifest().folders[b] == folders[b] for b in folders) >= 6
    rows = {r.id: (r.v, r.note) for r in table.read().collect()}
    assert len(rows) == 1000 and rows[5] == (500, "old") and all(rows[i] == (2 * i, "old") for i in rows if i != 5)


def test_duplicate_and_null_keys_change_nothing(spark, table):
    staged = spark.createDataFrame([(1, 10), (2, 20), (2, 21), (2, None), (None, 9), (3, None)], "id long, v long")
    counts = table.update(staged, ["v"])
    assert (counts.updated, counts.rejected_keys, counts.rejected_rows) == (2, 1, 3)
    rows = {r.id: r.v for r in table.read().collect()}
    assert (rows[1], rows[2], rows[3]) == (10, 4, 6)                # a NULL leaves the old value
    assert [(r.id, r._n) for r in table.rejects().collect()] == [(2, 3)]
    table.update(spark.createDataFrame([(3, None)], "id long, v long"), ["v"], replace_nulls=True)
    assert {r.id: r.v for r in table.read().collect()}[3] is None


def test_every_row_staged_in_many_small_groups(spark, table):
    table.group_rows = 150
    counts = table.update(spark.range(1000).select("id", (F.col("id") * 3).alias("v"), F.lit(1.5).alias("score")), ["v", "score"])
    assert counts.updated == 1000 and table.read().columns == ["id", "v", "note", "score"]
    assert table.read().where("v = id * 3 AND score = 1.5").count() == 1000


def test_a_new_column_is_null_where_nothing_was_staged(spark, table):
    table.update(spark.createDataFrame([(7, 0.5)], "id long, score double"), ["score"])
    assert {r.id: r.score for r in table.read().collect() if r.score is not None} == {7: 0.5} and table.read().count() == 1000


def test_inserts_and_repeated_batches(spark, table):
    staged = spark.createDataFrame([(2, 1), (2000, 2), (3000, 3)], "id long, v long")
    counts = table.update(staged, ["v"], insert=True, batch=("w", 4))
    assert (counts.updated, counts.inserted) == (1, 2)
    current = table.manifest()
    again = table.update(staged, ["v"], insert=True, batch=("w", 4))
    assert again.touched == [] and table.manifest() == current
    rows = {r.id: (r.v, r.note) for r in table.read().collect()}
    assert len(rows) == 1002 and rows[2] == (1, "old") and rows[2000] == (2, None)


def test_a_failed_update_leaves_the_old_version(spark, table):
    before = table.manifest()
    with pytest.raises(Exception, match="boom"):
        table.update(spark.range(3).select("id", F.raise_error(F.lit("boom")).cast("long").alias("v")), ["v"])
    assert table.manifest() == before and table.read().agg(F.sum("v")).first()[0] == 999_000


def test_derived_columns_and_vacuum(spark, table, capsys):
    assert table.derive("big", F.col("v") > 1000) == 1000
    assert table.read().where("big").count() == 499
    assert table.vacuum() == 1 and table.read().count() == 1000
    empty = BucketTable(spark, scratch_path(spark, f"test-buckets-{uuid.uuid4().hex}"))
    assert empty.create(spark.createDataFrame([], "id long, v long"), ["id"]) == 0 and empty.read().collect() == []
    assert empty.update(spark.createDataFrame([(1, 2)], "id long, v long"), ["v"], insert=True).inserted == 1
    assert [tuple(r) for r in empty.read().collect()] == [(1, 2)]


def test_the_table_is_not_shuffled_by_an_update(spark, table, monkeypatch):
    plans = []
    write = BucketTable._write

    def spy(self, df, folder):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(self, df, folder)

    monkeypatch.setattr(BucketTable, "_write", spy)
    table.update(spark.range(1000).select("id", F.col("id").alias("v")), ["v"])
    assert len(plans) == 2 and "Exchange hashpartitioning" in plans[0]
    assert "BroadcastHashJoin" in plans[1] and "hashpartitioning" not in plans[1]
