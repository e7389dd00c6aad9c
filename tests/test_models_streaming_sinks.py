"""Model quality properties, sinks idempotence, streaming = batch, forecasting fit."""

import os
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyspark.operators import forecast as fc
from tallyspark.operators import iforest
from tallyspark.sources.sinks import add_columns, keyed_update, read_table, rejected_duplicates, write_snapshot


def test_isolation_forest_ranks_planted_outliers_first(spark):
    rng = np.random.default_rng(0)
    pts = rng.normal(size=(2000, 3))
    pts[:10] += 12.0  # planted outliers
    df = spark.createDataFrame([(int(i), *map(float, p)) for i, p in enumerate(pts)], "k long, a double, b double, c double")
    nodes = iforest.fit(df, ["a", "b", "c"], "k", n_trees=50)
    s = iforest.score_and_flag(df, nodes, ["a", "b", "c"], 256, contamination=0.005, n_trees=50, carry=["k"])
    top = [r.k for r in s.orderBy(F.desc("anomaly_score")).limit(10).collect()]
    assert set(top) == set(range(10))
    assert s.where("is_flagged_iforest = 1").count() == 10  # 0.5 % of 2000


def test_isolation_forest_is_deterministic_and_order_free(spark):
    rng = np.random.default_rng(1)
    rows = [(int(i), float(x)) for i, x in enumerate(rng.normal(size=500))]
    a = spark.createDataFrame(rows, "k long, a double").repartition(3)
    b = spark.createDataFrame(rows[::-1], "k long, a double").repartition(7)
    sa, sb = ({r.k: r.anomaly_score for r in iforest.score_and_flag(
        d, iforest.fit(d, ["a"], "k", 20), ["a"], 256, 0.01, 20, carry=["k"]).collect()} for d in (a, b))
    assert sa == pytest.approx(sb)


def test_keyed_update_schema_evolution_and_rejects(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id long, v string")
    staged = spark.createDataFrame([(1, 0.5), (2, 0.7), (2, 0.9)], "id long, score double")
    out = {r.id: r.score for r in keyed_update(t, staged, "id", ["score"]).collect()}
    assert out == {1: 0.5, 2: None, 3: None}  # duplicate key 2 rejected, 3 untouched
    assert rejected_duplicates(staged, "id").count() == 2
    again = keyed_update(keyed_update(t, staged, "id", ["score"]), staged, "id", ["score"])
    assert {r.id: r.score for r in again.collect()} == out  # idempotent
    assert "x" in add_columns(t, {"x": "smallint"}).columns


def test_snapshot_write_and_read(spark):
    d = tempfile.mkdtemp(prefix="tallyspark-snap-")
    df = spark.range(5).withColumnRenamed("id", "k")
    assert write_snapshot(df, d) == 5
    assert write_snapshot(df.where("k < 2"), d) == 2
    assert read_table(spark, d).count() == 2


def test_arima_recovers_ar1():
    rng = np.random.default_rng(3)
    y = np.zeros(3000)
    for t in range(1, len(y)):
        y[t] = 0.6 * y[t - 1] + rng.normal()
    f = fc.fit_arma(y, 1, 0, 0)
    assert f["phi"][0] == pytest.approx(0.6, abs=0.05)
    fc.fit_arma(np.cumsum(np.ones(50) * 2.0), 2, 0, 0)  # a degenerate series does not raise


def test_chosen_orders_do_not_depend_on_the_unit(spark):
    rng = np.random.default_rng(4)
    walks = {f"w{i}": np.cumsum(rng.normal(size=160)) + 50 for i in range(6)}
    rows = [(f"{n}*{k}", i, float(v * k), "train") for n, y in walks.items() for k in (0.001, 1, 1000) for i, v in enumerate(y)]
    df = spark.createDataFrame(rows, "series string, obs int, value double, split string")
    best = {r.series: (r.p, r.d, r.q) for r in fc.best_orders(fc.arima_orders(df)).collect()}
    for n in walks:
        assert len({best[f"{n}*{k}"] for k in (0.001, 1, 1000)}) == 1


def test_failed_fit_and_short_series_are_reported(spark):
    rows = [("flat", f"2024-01-{i + 1:02d}", 5.0) for i in range(28)] + [("short", "2024-01-01", 1.0)]
    s = spark.createDataFrame(rows, "series string, trade_date string, value double").withColumn("trade_date", F.to_date("trade_date"))
    split = fc.holdout_split(s, holdout=5)
    assert [r.series for r in fc.rejected_series(split).collect()] == ["short"]
    orders = fc.best_orders(fc.arima_orders(split))
    forecast = fc.arima_forecasts(split, orders)
    assert {r.arima for r in forecast.collect()} == {None}
    table = fc.naive_forecasts(split).join(forecast, ["series", "trade_date"], "left")
    status = {r.model: (r.rmse, r.status) for r in fc.evaluation(fc.to_long(table, ["arima", "naive_last_value"])).collect()}
    assert status == {"arima": (None, "failed"), "naive_last_value": (0.0, "ok")}


@pytest.mark.parametrize("rows", [300, 5000, 60_000])
def test_forest_sampling_has_one_rule_at_every_size(spark, rows):
    df = spark.range(rows).select(F.col("id").alias("k"), (F.col("id") % 97).cast("double").alias("x"))
    got = iforest.subsample(df, "k", rows, n_trees=12, psi=128).groupBy("tree").agg(
        F.count("*").alias("n"), F.countDistinct("k").alias("d")).collect()
    assert len(got) == 12 and all(r.n == r.d == 128 for r in got)
    if rows < 60_000:  # trees draw independently, so some rows serve several
        assert iforest.subsample(df, "k", rows, n_trees=12, psi=128).groupBy("k").count().where("count > 1").count() > 0


def test_upsert_replay_and_failure_leave_a_whole_table(spark):
    from tallyspark.streaming.pipelines import upsert_batch
    d = tempfile.mkdtemp(prefix="tallyspark-upsert-")
    write = upsert_batch(d, ["k"])
    first = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    second = spark.createDataFrame([(2, "c"), (3, "d")], "k long, v string")
    write(first, 0)
    write(second, 1)
    write(second, 1)                                # the same batch again
    assert sorted(map(tuple, read_table(spark, d).collect())) == [(1, "a"), (2, "c"), (3, "d")]
    broken = second.select("k", F.raise_error(F.lit("lost")).cast("string").alias("v"))
    with pytest.raises(Exception):
        write(broken, 2)
    assert sorted(map(tuple, read_table(spark, d).collect())) == [(1, "a"), (2, "c"), (3, "d")]
    assert len([f for f in os.listdir(d) if f.startswith("batch-")]) <= 3


def test_only_local_sessions_may_lack_a_checkpoint_folder():
    from tallyspark.session import _local_folder
    assert os.path.isdir(_local_folder("local[4]"))
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]", "k8s://x"):
        with pytest.raises(ValueError):
            _local_folder(master)


def test_segment_labels_that_do_not_fit_raise(spark, monkeypatch):
    from tallyspark.operators import segments
    profile = spark.createDataFrame([(0, 5.0, 100.0), (1, 1.0, 10.0)], "cluster int, avg_frequency double, avg_monetary double")
    assert segments.label_clusters(profile).count() == 2
    monkeypatch.setattr(segments, "SEGMENT_MAX_LEN", 5)
    with pytest.raises(Exception, match="longer than 5"):
        segments.label_clusters(profile).collect()


def test_portfolio_weights_must_name_the_tickers(spark):
    from tallyspark.operators.market import portfolio_returns
    rows = [(t, f"2024-01-0{i}", r) for t, rs in (("A", (0.1, 0.2)), ("B", (0.3, 0.4))) for i, r in enumerate(rs, 1)]
    prices = spark.createDataFrame(rows, "ticker string, trade_date string, daily_return double")
    got = {r.trade_date: r.daily_return for r in portfolio_returns(prices, {"A": 3, "B": 1}).collect()}
    assert got == pytest.approx({"2024-01-01": 0.15, "2024-01-02": 0.25})
    for weights in ({"A": 1.0}, {"A": 1.0, "B": 1.0, "C": 1.0}):
        with pytest.raises(ValueError, match="differ"):
            portfolio_returns(prices, weights)


def test_streaming_kpis_equal_batch_over_several_batches(spark):
    from tallyspark.plans.fraud import fraud_kpis
    from tallyspark.plans.streaming_jobs import stage_transactions
    from tallyspark.streaming import pipelines as sp
    sf = "/root/testdata/sf0.001"
    src, schema = stage_transactions(spark, sf, n_files=4)
    table = tempfile.mkdtemp(prefix="tallyspark-kpi-")
    stream = sp.read_transaction_stream(spark, src, schema, max_files_per_trigger=1)
    q = sp.start_daily_kpis(stream, table, os.path.join(table, "_ckpt"))
    q.awaitTermination()
    got = {(r.txn_day, r.txn_type): (r.txn_count, r.fraud_count) for r in read_table(spark, table).collect()}
    want = {(r.txn_day, r.txn_type): (r.txn_count, r.fraud_count) for r in fraud_kpis(spark, sf).collect()}
    assert got == want


def test_streaming_flags_dedup_replayed_files(spark):
    """A file delivered twice must not duplicate transactions; flags equal the batch rule."""
    from tallyspark.plans.streaming_jobs import stage_transactions
    from tallyspark.sources.shaped import scored_transactions
    from tallyspark.streaming import pipelines as sp
    sf = "/root/testdata/sf0.001"
    src, schema = stage_transactions(spark, sf, n_files=3)
    files = [f for f in os.listdir(src) if f.endswith(".parquet")]
    import shutil
    shutil.copy(os.path.join(src, files[0]), os.path.join(src, "replayed-" + files[0]))
    out = tempfile.mkdtemp(prefix="tallyspark-flags-")
    q = sp.start_flagging(sp.read_transaction_stream(spark, src, schema), os.path.join(out, "data"),
                          os.path.join(out, "_ckpt"))
    q.awaitTermination()
    got = spark.read.parquet(os.path.join(out, "data"))
    assert got.count() == got.select("txn_id").distinct().count()
    want = {r.txn_id: r.is_flagged_rule for r in scored_transactions(spark, sf).collect()}
    assert {r.txn_id: r.is_flagged_rule for r in got.collect()} == want
