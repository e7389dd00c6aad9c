"""Goldens and properties for the distributed order statistics and metrics."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyspark.operators import evaluation as ev
from tallyspark.operators.ranking import percent_ranks_multi, range_quantiles
from tallyspark.operators.selection import exact_quantiles, exact_quantiles_wide


def _vals(spark, xs, parts=3):
    return spark.createDataFrame([(i, float(x)) for i, x in enumerate(xs)], "k long, x double").repartition(parts)


@pytest.mark.parametrize("parts", [1, 4, 13])
def test_percent_rank_matches_window_with_ties(spark, parts):
    xs = [5, 1, 3, 3, 3, 9, 1, 7, 7, 2, 10, 3]
    df = _vals(spark, xs, parts)
    got = {r.k: r.pr for r in percent_ranks_multi(df, {"pr": ("x", True)}, n_buckets=3).collect()}
    want = {r.k: r.pr for r in df.select("k", F.percent_rank().over(Window.orderBy("x")).alias("pr")).collect()}
    assert got == pytest.approx(want)
    got_d = {r.k: r.pr for r in percent_ranks_multi(df, {"pr": ("x", False)}, n_buckets=2).collect()}
    want_d = {r.k: r.pr for r in df.select("k", F.percent_rank().over(Window.orderBy(F.desc("x"))).alias("pr")).collect()}
    assert got_d == pytest.approx(want_d)


@pytest.mark.parametrize("fn", [exact_quantiles, range_quantiles])
def test_quantiles_match_numpy_linear(spark, fn):
    rng = np.random.default_rng(7)
    xs = np.round(rng.normal(size=997), 3)
    xs[:300] = 0.5  # a hot value holding a third of the rows
    df = _vals(spark, xs, 5)
    qs = [0.01, 0.25, 0.5, 0.9, 0.99]
    got = {round(r.q, 6): r.quantile for r in fn(df, "x", qs).collect()}
    for q in qs:
        assert got[round(q, 6)] == pytest.approx(float(np.percentile(xs, q * 100)), abs=1e-12)


def test_auc_with_ties_golden(spark):
    # pairs (pos, neg): ties count one half
    rows = [(1, 0.9), (1, 0.5), (0, 0.5), (0, 0.1), (1, 0.3), (0, 0.3)]
    df = spark.createDataFrame(rows, "y int, score double")
    auc = ev.auc(df).first().auc
    # brute force over all pos/neg pairs
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    want = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p in pos for n in neg) / (len(pos) * len(neg))
    assert auc == pytest.approx(want)


def test_best_fbeta_honours_beta_and_prefers_smallest_threshold(spark):
    rows = [(1, 0.9), (0, 0.8), (1, 0.7), (0, 0.2), (1, 0.1)]
    df = spark.createDataFrame(rows, "y int, score double")
    b2 = ev.best_fbeta_threshold(df, beta=2.0).first()
    b05 = ev.best_fbeta_threshold(df, beta=0.5).first()
    assert b2.threshold == pytest.approx(0.1)  # recall-favouring
    assert b05.threshold >= 0.7


def test_confusion_zero_division(spark):
    df = spark.createDataFrame([(0, 0), (0, 0)], "y int, pred int")
    r = ev.confusion_matrix(df).first()
    assert (r.tp, r.fp, r.fn, r.tn) == (0, 0, 0, 2) and r.precision == 0.0 and r.recall == 0.0


def test_exact_quantiles_wide_matches_numpy(spark):
    rng = np.random.default_rng(11)
    a = np.round(rng.normal(size=1500), 2)
    a[:500] = 0.25  # hot value
    b = np.round(rng.exponential(size=1500), 3)
    rows = [(float(x), None if i % 7 == 0 else float(y)) for i, (x, y) in enumerate(zip(a, b))]
    df = spark.createDataFrame(rows, "a double, b double").repartition(4)
    qs = [0.01, 0.5, 0.99]
    got = {(r.column, round(r.q, 6)): r.quantile for r in exact_quantiles_wide(df, ["a", "b"], qs).collect()}
    bb = np.array([y for (_, y) in rows if y is not None])
    for q in qs:
        assert got[("a", q)] == pytest.approx(float(np.percentile(a, q * 100)), abs=1e-12)
        assert got[("b", q)] == pytest.approx(float(np.percentile(bb, q * 100)), abs=1e-12)
