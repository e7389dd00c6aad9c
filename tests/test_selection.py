"""Radix selection and range search against sorted lists."""

import math
import struct

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyspark.operators import selection
from tallyspark.operators.cleaning import impute_and_winsorize, impute_median, winsorize
from tallyspark.operators.ranking import bounds_below


def _table(spark, values, parts=3):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i long, x double").repartition(parts)


def _ranks(df, wanted):
    sizes, found = selection.select_ranks(df.select("x"), [], "x", lambda g, n, m: wanted)
    return sizes[()], {r: v for (_, r), v in found.items()}


@pytest.mark.parametrize("limit", [16, 1 << 16])
def test_every_magnitude_is_found_at_its_rank(spark, monkeypatch, limit):
    monkeypatch.setattr(selection, "MAX_ROWS", max(limit, 4096) if limit > 16 else 4096)
    monkeypatch.setattr(selection, "MAX_CELLS", limit)
    rng = np.random.default_rng(4)
    bits = rng.integers(0, 0x7FEF_FFFF_FFFF_FFFF, 1500)
    values = [struct.unpack("<d", struct.pack("<q", int(b)))[0] * int(s) for b, s in zip(bits, rng.choice([-1, 1], 1500))]
    values += [0.0, -0.0, 5e-324, -5e-324, 2.0 ** -1022, math.inf, -math.inf, 1.7976931348623157e308, math.nextafter(1, 0), 1.0]
    size, got = _ranks(_table(spark, values + [None] * 7), range(0, len(values), 13))
    assert size == (len(values), 7) and got == {r: sorted(values)[r] for r in got} and len(got) == len(range(0, len(values), 13))


def test_distinct_values_of_one_exponent_and_a_hot_value(spark, monkeypatch):
    monkeypatch.setattr(selection, "MAX_ROWS", 300)  # several rounds on few rows
    distinct = spark.range(40_000).select((1 + F.col("id") / 40_000).alias("x"))
    _, got = _ranks(distinct, [0, 1, 19_999, 39_999, 40_000, -1])
    assert got == {r: 1 + r / 40_000 for r in (0, 1, 19_999, 39_999)}
    hot = distinct.select(F.when(F.col("x") > 1.5, 1.5).otherwise(F.col("x")).alias("x"))
    assert _ranks(hot, [30_000, 20_001, 5])[1] == {30_000: 1.5, 20_001: 1.5, 5: 1 + 5 / 40_000}


def test_neighbouring_doubles_are_told_apart(spark, monkeypatch):
    monkeypatch.setattr(selection, "MAX_ROWS", 40)
    values = [1e15]
    for _ in range(200):
        values.append(math.nextafter(values[-1], math.inf))
    assert _ranks(_table(spark, values[::-1]), [0, 77, 200])[1] == {0: values[0], 77: values[77], 200: values[200]}


def test_no_value_is_ordered_by_a_window_or_sort(spark, capsys):
    df = spark.range(100).select(F.col("id").cast("double").alias("x"))
    data = df.withColumn("c", selection.exponent_cell(F.col("x"))).groupBy("c").count()
    data.explain()
    plan = capsys.readouterr().out
    assert "Window" not in plan and "Sort " not in plan and "HashAggregate" in plan


def test_quantiles_by_group_with_nulls_nan_and_null_groups(spark):
    rows = [("a", float(i)) for i in range(10)] + [(None, 2.0), (None, 4.0), ("empty", None), ("nan", math.nan), ("nan", 1.0)]
    df = spark.createDataFrame(rows, "g string, x double")
    got = {(r.g, r.q): r.quantile for r in selection.exact_quantiles(df, "x", [0.0, 0.5], ["g"]).collect()}
    assert math.isnan(got.pop(("nan", 0.5)))
    assert got == {("a", 0.0): 0.0, ("a", 0.5): 4.5, (None, 0.0): 2.0, (None, 0.5): 3.0, ("nan", 0.0): 1.0}
    assert selection.exact_quantiles(df.where("false"), "x", [0.5]).collect() == []


def test_many_groups_take_the_range_pass(spark, monkeypatch):
    df = spark.range(600).select((F.col("id") % 60).alias("g"), F.col("id").cast("double").alias("x"))
    want = sorted(map(tuple, selection.exact_quantiles(df, "x", [0.1, 0.5], ["g"]).collect()))
    monkeypatch.setattr(selection, "MAX_ROWS", 50)
    assert sorted(map(tuple, selection.exact_quantiles(df, "x", [0.1, 0.5], ["g"]).collect())) == want and len(want) == 120


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(-6, 6).map(float)), st.one_of(st.none(), st.floats(-9, 9))), min_size=1, max_size=40))
def test_bounds_after_imputation_follow_from_the_ranks_before(spark, rows):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i long, a double, b double")
    two = winsorize(impute_median(df, ["a"], "exact"), ["a", "b"], 0.2, 0.9, mode="exact").orderBy("i").collect()
    one = impute_and_winsorize(df, ["a"], ["a", "b"], 0.2, 0.9).orderBy("i").collect()
    for x, y in zip(one, two):
        assert (x.a is None) == (y.a is None) and (x.b is None) == (y.b is None)
        assert x.a is None or x.a == pytest.approx(y.a, abs=1e-9)
        assert x.b is None or x.b == pytest.approx(y.b, abs=1e-9)


def test_range_search_counts_the_bounds_below(spark):
    for bounds in ([], [1.0], [1.0, 1.0, 3.0], [float(i) for i in range(8)], [float(i // 3) for i in range(31)]):
        df = spark.range(-2, 70).select((F.col("id") / 2.0).alias("x"), F.array(*[F.lit(b) for b in bounds]).cast("array<double>").alias("b"))
        for r in df.select("x", bounds_below(F.col("b"), F.col("x"), len(bounds)).alias("n")).collect():
            assert r.n == sum(b < r.x for b in bounds)
