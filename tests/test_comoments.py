"""Tiled correlations against pandas and brute force."""

import itertools
import math

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyspark.operators import comoments as co


def _long(spark, frame: pd.DataFrame):
    rows = [(s, int(t), None if pd.isna(v) else float(v)) for s in frame for t, v in frame[s].items()]
    return spark.createDataFrame(rows, "s string, t long, v double").repartition(3)


def _frame(n_series, n_times, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n_times, 1)) + rng.normal(size=(n_times, n_series)) * 3 + 1000
    x = np.round(x, 1)
    x[rng.random(x.shape) < 0.2] = np.nan
    names = [f"s{i}" for i in range(n_series - 3)] + ["it's", 'a"b', "`c`"]
    return pd.DataFrame(x, columns=names, index=np.arange(n_times) * 2)


def _tau(x, y):
    c = sum(np.sign(x[i] - x[j]) * np.sign(y[i] - y[j]) for i, j in itertools.combinations(range(len(x)), 2))
    a = sum(x[i] != x[j] for i, j in itertools.combinations(range(len(x)), 2))
    b = sum(y[i] != y[j] for i, j in itertools.combinations(range(len(x)), 2))
    return c / math.sqrt(a * b) if a and b else None


@pytest.mark.parametrize("tile,block", [(4, 16), (100, 1024), (1, 7), (None, 1024)])
def test_pearson_is_pairwise_complete_whatever_the_tiles(spark, tile, block):
    frame = _frame(11, 60)
    out = co.pair_correlations(_long(spark, frame), "s", "t", "v", tile=tile, block=block).collect()
    want = frame.corr()
    assert len(out) == 121
    for r in out:
        assert r.correlation == pytest.approx(want.loc[r.a, r.b], abs=1e-9)
        assert r.n == (frame[r.a].notna() & frame[r.b].notna()).sum()


@pytest.mark.parametrize("method", ["spearman", "kendall"])
def test_rank_correlations_rank_the_common_rows(spark, method):
    frame = _frame(7, 40, seed=3).round(0)  # many ties
    out = co.pair_correlations(_long(spark, frame), "s", "t", "v", method=method, tile=3).collect()
    assert len(out) == 49
    for r in out:
        both = frame[[r.a, r.b]].dropna() if r.a != r.b else frame[[r.a]].dropna().assign(y=frame[r.a])
        x, y = both.iloc[:, 0].to_numpy(), both.iloc[:, 1].to_numpy()
        want = _tau(x, y) if method == "kendall" else np.corrcoef(pd.Series(x).rank(), pd.Series(y).rank())[0, 1]
        assert r.correlation == pytest.approx(want, abs=1e-12)


def test_constant_missing_and_disjoint_series(spark):
    rows = [("flat", t, 0.1) for t in range(9)] + [("up", t, float(t)) for t in range(9)] + [("late", t, float(-t)) for t in range(50, 55)]
    rows += [("none", t, None) for t in range(9)] + [("nan", t, math.nan) for t in range(9)] + [(None, 3, 1.0), ("one", 4, 7.0)]
    df = spark.createDataFrame(rows, "s string, t long, v double")
    for method, tile in (("pearson", 2), ("pearson", None), ("spearman", 2), ("kendall", 2)):
        got = {(r.a, r.b): (r.n, r.correlation) for r in co.pair_correlations(df, "s", "t", "v", method=method, tile=tile).collect()}
        assert {a for a, _ in got} == {"flat", "up", "late", "one"}
        assert ("late", "up") not in got and got["late", "late"] == (5, pytest.approx(1.0)) and got["up", "up"] == (9, pytest.approx(1.0))
        assert got["flat", "up"] == got["up", "flat"] == (9, None) and got["one", "up"] == (1, None)
    assert co.pair_correlations(df.where("false"), "s", "t", "v").collect() == []
    with pytest.raises(ValueError):
        co.pair_correlations(df, "s", "t", "v", method="cosine")


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(-3, 3), st.integers(-3, 3)), min_size=1, max_size=40))
def test_tau_and_inversions_equal_counting_pairs(points):
    x, y = (np.array(c, float) for c in zip(*points))
    assert co.inversions(y) == sum(y[i] > y[j] for i, j in itertools.combinations(range(len(y)), 2))
    want, got = _tau(x, y), co.kendall_tau_b(x, y)
    assert math.isnan(got) if want is None else got == pytest.approx(want)


def test_two_thousand_series(spark):
    n, days = 2000, 6
    df = spark.range(n * days).selectExpr("concat('t', id div 6) AS s", "id % 6 AS t", "sin(id * id) AS v").repartition(8)
    pairs = co.pair_correlations(df, "s", "t", "v")
    got = pairs.selectExpr("count(*) AS n", "count_if(a = b AND abs(correlation - 1) < 1e-9) AS own", "min(n) AS least").first()
    assert (got.n, got.own, got.least) == (n * n, n, days)


def test_columns_of_a_wide_table(spark):
    frame = _frame(6, 50, seed=9)
    frame["s0"] = frame["s0"].where(frame.index % 3 == 0)
    rows = [tuple(None if pd.isna(v) else float(v) for v in r) for r in frame.itertuples(index=False)]
    df = spark.createDataFrame(rows, "a double, `b c` double, d double, e double, f double, g double").repartition(4)
    out = {(r.a, r.b): r.correlation for r in co.column_correlations(df, df.columns).collect()}
    want = frame.set_axis(df.columns, axis=1).corr()
    assert len(out) == 36 and all(v == pytest.approx(want.loc[k], abs=1e-9) for k, v in out.items())
