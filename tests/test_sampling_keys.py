"""Sampling, splitting and key-assignment properties (order- and partition-independent)."""

import pytest
from pyspark.sql import functions as F

from tallyspark.operators.cleaning import keep_first
from tallyspark.operators.profile import hash_top_n, key_hash, stratified_split
from tallyspark.plans.tables import surrogate_keys


def _ids(spark, n, parts):
    return spark.range(n).withColumnRenamed("id", "k").withColumn("y", (F.col("k") % 4 == 0).cast("int")).repartition(parts)


@pytest.mark.parametrize("parts", [1, 6])
def test_hash_top_n_equals_order_by_limit(spark, parts):
    df = _ids(spark, 3000, parts)
    got = {r.k for r in hash_top_n(df, "k", 250).collect()}
    want = {r.k for r in df.orderBy(F.md5(F.col("k").cast("string"))).limit(250).collect()}
    assert got == want


def test_stratified_split_exact_shares(spark):
    df = _ids(spark, 2003, 5)
    s = stratified_split(df, "k", "y", 0.2)
    counts = {(r.y, r.split): r.n for r in s.groupBy("y", "split").agg(F.count("*").alias("n")).collect()}
    n1, n0 = df.where("y = 1").count(), df.where("y = 0").count()
    assert counts[(1, "test")] == round(0.2 * n1) and counts[(0, "test")] == round(0.2 * n0)
    again = stratified_split(df.repartition(2), "k", "y", 0.2)
    assert {r.k for r in s.where("split = 'test'").collect()} == {r.k for r in again.where("split = 'test'").collect()}


def test_surrogate_keys_consecutive(spark):
    df = spark.createDataFrame([(t, d) for t in "CAB" for d in range(5)], "t string, d int").repartition(3)
    ids = surrogate_keys(df, "t", "d", "id").orderBy("id").collect()
    assert [r.id for r in ids] == list(range(1, 16))
    assert [(r.t, r.d) for r in ids] == sorted((t, d) for t in "ABC" for d in range(5))


@pytest.mark.parametrize("parts", [1, 7])
def test_keep_first_hot_key(spark, parts):
    rows = [(1, 100 - i, f"v{i}") for i in range(60)] + [(2, 5, "x"), (3, 1, "y")]
    df = spark.createDataFrame(rows, "id long, seq long, v string").repartition(parts)
    got = {r.id: (r.seq, r.v) for r in keep_first(df, ["id"], "seq").collect()}
    assert got == {1: (41, "v59"), 2: (5, "x"), 3: (1, "y")}


def test_key_hash_matches_hex_order(spark):
    df = spark.range(200).withColumn("h", key_hash("id")).withColumn("m", F.md5(F.col("id").cast("string")))
    a = [r.id for r in df.orderBy("h").collect()]
    b = [r.id for r in df.orderBy("m").collect()]
    assert a == b
