"""Hypothesis properties: distributed order statistics equal their single-node definitions."""

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyspark.operators.ranking import percent_ranks_multi
from tallyspark.operators.selection import exact_quantiles

values = st.lists(st.integers(min_value=-50, max_value=50), min_size=1, max_size=120)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(xs=values, parts=st.integers(min_value=1, max_value=9), q=st.sampled_from([0.0, 0.01, 0.25, 0.5, 0.99, 1.0]))
def test_bracketed_quantile_is_numpy_linear(spark, xs, parts, q):
    df = spark.createDataFrame([(float(x),) for x in xs], "x double").repartition(parts)
    got = exact_quantiles(df, "x", [q]).first().quantile
    assert abs(got - float(np.percentile(np.array(xs, dtype=float), q * 100))) < 1e-9


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(xs=values, parts=st.integers(min_value=1, max_value=9), buckets=st.integers(min_value=1, max_value=6))
def test_percent_rank_is_window_percent_rank(spark, xs, parts, buckets):
    df = spark.createDataFrame([(i, float(x)) for i, x in enumerate(xs)], "k long, x double").repartition(parts)
    got = {r.k: r.pr for r in percent_ranks_multi(df, {"pr": ("x", False)}, n_buckets=buckets).collect()}
    want = {r.k: r.pr for r in df.select("k", F.percent_rank().over(Window.orderBy(F.desc("x"))).alias("pr")).collect()}
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-12 for k in got)
