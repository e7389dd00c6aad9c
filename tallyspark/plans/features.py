"""Model inputs as checked outputs: M1/M2 (one-hot and scaled loan features), M9 (customer
features), the rule row of M18, permutation importance (M16) with the top k (L7)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.functions.risk import CLOSED_LOAN_STATUSES
from tallyspark.operators import credit as cr
from tallyspark.operators import evaluation as ev
from tallyspark.operators import profile as pf
from tallyspark.operators import segments as sg
from tallyspark.plans.credit import PURPOSES
from tallyspark.plans.models import model_frames
from tallyspark.plans.profiling import L6_SQL
from tallyspark.plans.registry import register
from tallyspark.plans.segments import orders_rfm
from tallyspark.session import materialize
from tallyspark.sources.shaped import loans, scored_transactions, with_views

SCALED = ["loan_amount", "annual_income", "dti"]

_MATRIX_SQL = ", ".join(
    [f"ROUND((CAST({c} AS DOUBLE) - AVG(CAST({c} AS DOUBLE)) FILTER (WHERE split = 'train') OVER ()) / "
     f"STDDEV_POP(CAST({c} AS DOUBLE)) FILTER (WHERE split = 'train') OVER (), 6) + 0.0 AS {c}" for c in SCALED]
    + [f"CAST(coalesce(purpose = '{p}', false) AS INTEGER) AS \"purpose_{p}\"" for p in PURPOSES[1:]])
M1_SQL = (f"SELECT loan_id, split, {_MATRIX_SQL} FROM ({L6_SQL}) s JOIN "
          f"({with_views('SELECT loan_id, purpose, ' + ', '.join(SCALED) + ' FROM loans', 'loans')}) l USING (loan_id)")


@register("m1_m2_feature_matrix", M1_SQL, ids=("M1", "M2", "J6"))
def m1_m2_feature_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One-hot purposes (first category dropped) and numerics scaled with the train split's mean and deviation."""
    closed = loans(spark, sf_dir).where(F.col("loan_status").isin(*CLOSED_LOAN_STATUSES)).select(
        "loan_id", "purpose", *SCALED, F.col("loan_status").isin("Charged Off", "Default").cast("int").alias("y"))
    split = materialize(pf.stratified_split(closed, "loan_id", "y"))
    train = split.where("split = 'train'")
    wide, names = cr.one_hot(split, cr.one_hot_vocabulary(train, ["purpose"]))
    scaled = cr.apply_scaler(wide, cr.fit_scaler(train, SCALED), SCALED)
    return scaled.select("loan_id", "split", *[F.round(c, 6).alias(c) for c in SCALED], *names)


M9_SQL = with_views("""
SELECT customer_id, ROUND((r - AVG(r) OVER ()) / STDDEV_POP(r) OVER (), 6) + 0.0 AS recency_z,
       ROUND((f - AVG(f) OVER ()) / STDDEV_POP(f) OVER (), 6) + 0.0 AS frequency_log_z,
       ROUND((m - AVG(m) OVER ()) / STDDEV_POP(m) OVER (), 6) + 0.0 AS monetary_log_z
FROM (SELECT customer_id, CAST(date_diff('day', last_txn_date, MAX(last_txn_date) OVER ()) AS DOUBLE) AS r,
             ln(1 + CAST(total_txn_count AS DOUBLE)) AS f, ln(1 + CAST(total_txn_value AS DOUBLE)) AS m
      FROM customer_aggregates) x""", "customer_aggregates")


@register("m9_rfm_features", M9_SQL, ids=("M9",))
def m9_rfm_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = sg.rfm_features(orders_rfm(spark, sf_dir), recency="recency_days")
    return f.select("customer_id", *[(F.round(c, 6) + F.lit(0.0)).alias(c) for c in ("recency_z", "frequency_log_z", "monetary_log_z")])


M18_SQL = with_views("""
SELECT tp, fp, fn, tn, ROUND(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS precision, ROUND(coalesce(tp / nullif(tp + fn, 0), 0), 6) AS recall,
       ROUND(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1, 'Rule engine' AS detector
FROM (SELECT COUNT(*) FILTER (WHERE hit AND bad) AS tp, COUNT(*) FILTER (WHERE hit AND NOT bad) AS fp,
             COUNT(*) FILTER (WHERE bad AND NOT hit) AS fn, COUNT(*) FILTER (WHERE NOT bad AND NOT hit) AS tn
      FROM (SELECT is_flagged_rule = 1 AS hit, is_fraud = 1 AS bad FROM scored_transactions) f) c""", "transactions")


@register("m18_rule_detector", M18_SQL, ids=("M18", "A29"))
def m18_rule_detector(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.confusion_matrix(scored_transactions(spark, sf_dir), y="is_fraud", pred="is_flagged_rule").withColumn(
        "detector", F.lit("Rule engine"))


@register("m16_permutation_importance_top5", None, ids=("M16", "L7"))
def m16_permutation_importance_top5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loss of AUC of the logistic model when one feature is permuted; the five largest."""
    train, test, names = model_frames(spark, sf_dir)
    return cr.permutation_importances(cr.train_logistic_regression(train), test, names).orderBy("rank").limit(5)
