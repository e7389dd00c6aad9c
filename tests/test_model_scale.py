"""Model queries whose time must not grow by a pass a feature, seed or tree."""

import threading
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import DenseVector
from pyspark.sql import functions as F

from tallyspark.operators import credit as cr
from tallyspark.operators import evaluation as ev


def _auc(y, p):
    pos, neg = p[y == 1], p[y == 0]
    return ((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg))


def test_grouped_auc_equals_each_groups_own(spark):
    rng = np.random.default_rng(0)
    rows = [(int(g), int(y), float(p)) for g, y, p in zip(rng.integers(0, 3, 300), rng.integers(0, 2, 300), rng.integers(0, 40, 300))]
    df = spark.createDataFrame(rows, "g int, y int, p double")
    a = np.array(rows)
    for r in ev.auc(df, score="p", keys=["g"]).collect():
        part = a[a[:, 0] == r.g]
        assert r.auc == pytest.approx(_auc(part[:, 1], part[:, 2]))


def test_permutation_importance_scores_all_features_in_one_pass(spark):
    rng = np.random.default_rng(1)
    x = np.round(rng.normal(size=(200, 3)), 2)
    y = (x[:, 0] + rng.normal(size=200) > 0).astype(int)
    model = SimpleNamespace(coefficients=DenseVector([2.0, -0.5, 0.0]), intercept=0.1)  # no Spark model is asked for its scores
    test = spark.createDataFrame([(i, int(y[i]), x[i].tolist()) for i in range(200)], "loan_id long, default int, a array<double>").select(
        "loan_id", "default", array_to_vector("a").alias("features"))
    got = {r.feature: r.auc_loss for r in cr.permutation_importances(model, test, ["a", "b", "c"]).collect()}
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    h = [r.h for r in spark.range(200).select("id", F.xxhash64("id", F.lit(cr.RANDOM_STATE)).alias("h")).orderBy("id").collect()]
    other = np.empty_like(x)
    for part in range(n):
        rows = sorted((i for i in range(200) if h[i] % n == part), key=lambda i: h[i])
        other[rows] = x[rows[1:] + rows[:1]]
    w = np.array(model.coefficients.toArray())
    for i, name in enumerate("abc"):
        mixed = x.copy()
        mixed[:, i] = other[:, i]
        assert got[name] == pytest.approx(_auc(y, x @ w) - _auc(y, np.round(mixed @ w, 9)), abs=1e-3)
    assert got["c"] == 0.0


def test_fits_side_by_side_keep_the_best_seed_of_each_k(spark):
    from pyspark.ml.clustering import KMeans

    from tallyspark.operators import segments as sg
    rng = np.random.default_rng(2)
    points = spark.createDataFrame([(x.tolist(),) for x in rng.normal(size=(120, 2))], "a array<double>").select(
        array_to_vector("a").alias("features")).coalesce(1)
    want = [min(KMeans(k=k, seed=7 + i, maxIter=5).fit(points).summary.trainingCost for i in range(2)) for k in (2, 3)]
    models = sg.fit_kmeans_range(points, [2, 3], seed=7, n_init=2, max_iter=5)
    assert [m.summary.trainingCost for m in models] == pytest.approx(want)


def test_work_side_by_side_runs_at_once_and_keeps_its_order():
    from tallyspark.session import side_by_side
    both = threading.Barrier(2, timeout=30)
    assert side_by_side(lambda i: (both.wait() >= 0, i), [3, 1]) == [(True, 3), (True, 1)]


def test_landing_lets_no_table_wait_for_another(spark, monkeypatch):
    from tallyspark.plans import load_jobs as lj
    started, landing = threading.Barrier(4, timeout=120), lj.typed_landing

    def together(*args):
        started.wait()
        return landing(*args)

    monkeypatch.setattr(lj, "typed_landing", together)
    rows = lj.s9_landing_all_tables(spark, "/root/testdata/sf0.001").collect()
    assert [r.table_name for r in rows] == list(lj.LANDING) and all(r.n_landed for r in rows)


def test_forest_rows_are_dealt_to_tasks_by_key(spark, monkeypatch):
    from tallyspark.plans import fraud_models as fm

    class Seen(Exception):
        pass

    def stop(df):
        raise Seen(df._jdf.queryExecution().optimizedPlan().toString())

    monkeypatch.setattr(fm, "materialize", stop)
    with pytest.raises(Seen, match="RepartitionByExpression"):
        fm.forest_scores(spark, "/root/testdata/sf0.001")


def test_trees_are_fitted_on_few_partitions(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(cr.GBTClassifier, "fit", lambda self, df: seen.append(df.rdd.getNumPartitions()))
    rows = spark.range(600).repartition(6).select((F.col("id") % 2).cast("int").alias("default"),
                                                  array_to_vector(F.array(F.col("id").cast("double"))).alias("features"))
    cr.train_gbt(rows)
    monkeypatch.setattr(cr, "FIT_PART_ROWS", 200)
    cr.train_gbt(rows)
    assert seen == [1, 3]


def test_models_are_compared_side_by_side(spark, monkeypatch):
    from tallyspark.plans import models as m
    both, train = threading.Barrier(2, timeout=200), cr.train_gbt

    def together(rows, n_trees):
        both.wait()
        return train(rows, n_trees=2)

    monkeypatch.setattr(cr, "train_gbt", together)
    got = m.m17_model_comparison(spark, "/root/testdata/sf0.001").collect()
    assert [r.model for r in got] == ["logistic_regression", "gradient_boosted_trees", "gradient_boosted_trees_with_grade"]
    assert len({r.tp + r.fp + r.fn + r.tn for r in got}) == 1
