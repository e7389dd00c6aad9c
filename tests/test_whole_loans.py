"""The split of the model queries takes all closed loans."""

import pytest
from pyspark.sql import functions as F

from tallyspark.operators.profile import key_hash, stratified_split
from tallyspark.plans import models as m


def _loans(spark, rows):
    """Loans of ``rows`` (loan_id, loan_status), alike otherwise."""
    n = F.coalesce(F.col("loan_id"), F.lit(0))
    return rows.select("loan_id", "loan_status", n.cast("double").alias("loan_amount"), (n % 2 * 24 + 36).cast("int").alias("term_months"),
                       *[(n % k).cast("int").alias(c) for c, k in (("annual_income", 91), ("dti", 50), ("delinq_2yrs", 3), ("open_accounts", 20),
                                                                   ("total_accounts", 45), ("revol_util", 110))],
                       (n % 160 + 620).cast("int").alias("fico_range_low"), F.lit("B").alias("grade"),
                       *[(n % 4).cast("string").alias(c) for c in ("employment_length", "home_ownership", "verification_status", "purpose")])


def test_all_closed_loans_take_part_in_the_split(spark, monkeypatch):
    n, status = 300_500, F.when(F.col("id") % 5 == 0, "Default").otherwise("Fully Paid")
    monkeypatch.setattr(m, "loans", lambda *_: _loans(spark, spark.range(n).select(F.col("id").alias("loan_id"), status.alias("loan_status"))))
    train, test = m.split_loans(spark, "")
    counts = [{r.default: r["count"] for r in part.groupBy("default").count().collect()} for part in (train, test)]
    assert counts == [{1: n // 5 * 4 // 5, 0: n // 5 * 4 * 4 // 5}, {1: n // 5 // 5, 0: n // 5 * 4 // 5}]
    assert train.join(test, "loan_id").isEmpty()


def test_loans_without_an_id_or_of_both_classes_are_not_fitted_on_and_tested(spark, monkeypatch):
    h = {r.id: r.h for r in spark.range(400).select("id", key_hash("id", "42").alias("h")).collect()}
    rows = [(i, "Fully Paid") for i in h] + [(i, "Charged Off") for i in h if h[i] < 1 << 59] + [(None, "Default")] * 3
    monkeypatch.setattr(m, "loans", lambda *_: _loans(spark, spark.createDataFrame(rows, "loan_id long, loan_status string")))
    train, test = ([(r.loan_id, r.default) for r in part.collect()] for part in m.split_loans(spark, ""))
    kept = {(i, int(s != "Fully Paid")) for i, s in rows if i is not None}
    taken = set()
    for y in (0, 1):
        cls = sorted((h[i], i) for i, d in kept if d == y)
        taken |= {(i, y) for _, i in cls[:round(0.2 * len(cls))]}
    fitted = {i for i, _ in kept - taken}
    assert {i for i, _ in taken} & fitted  # some are in both parts
    assert sorted(train) == sorted(kept - taken)
    assert sorted(test, key=str) == sorted([r for r in taken if r[0] not in fitted] + [(None, 1)] * 3, key=str)


@pytest.mark.parametrize("fraction", [0.0, 0.2, 0.37, 1.0])
def test_a_split_of_repeated_keys_keeps_a_key_whole_in_its_class(spark, fraction):
    df = spark.range(900).select((F.col("id") % 500).alias("k"), F.when(F.col("id") % 7 == 0, "a").when(F.col("id") % 300 == 5, "b").otherwise("c").alias("y"))
    rows = [(r.k, r.y, r.h) for r in df.select("k", "y", key_hash("k", "42").alias("h")).collect()]
    cut = {}
    for y in "abc":
        hs = sorted(h for _, c, h in rows if c == y)
        cut[y] = ([-1] + hs)[int(len(hs) * fraction + 0.5)]
    want = sorted((k, y, "test" if h <= cut[y] else "train") for k, y, h in rows)
    assert sorted((r.k, r.y, r.split) for r in stratified_split(df.repartition(3), "k", "y", fraction).collect()) == want
