"""Fraud anomaly detection queries: P25, M5-M7, M18, D5, D6, S14, S16, A37/A38 for the forest."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.operators import evaluation as ev
from tallyspark.operators import iforest
from tallyspark.operators.profile import bounded_values, histogram
from tallyspark.operators.selection import exact_quantiles
from tallyspark.plans.registry import register
from tallyspark.session import materialize, scratch_path
from tallyspark.sources.buckets import BucketTable
from tallyspark.sources.shaped import scored_transactions, with_views

BASE_FEATURE_COLUMNS = ["amount", "sender_bal_before", "sender_bal_after", "receiver_bal_before",
                        "receiver_bal_after", "sender_balance_delta", "sender_balance_error",
                        "receiver_balance_delta", "receiver_balance_error"]


def anomaly_features(t: DataFrame) -> DataFrame:
    """P25: ledger deltas and errors (as doubles)."""
    d = lambda c: F.col(c).cast("double")
    return t.withColumns({
        "sender_balance_delta": d("sender_bal_before") - d("sender_bal_after"),
        "sender_balance_error": d("sender_bal_after") - (d("sender_bal_before") - d("amount")),
        "receiver_balance_delta": d("receiver_bal_after") - d("receiver_bal_before"),
        "receiver_balance_error": d("receiver_bal_after") - (d("receiver_bal_before") + d("amount")),
    }).withColumns({c: d(c) for c in ("amount", "sender_bal_before", "sender_bal_after", "receiver_bal_before",
                                      "receiver_bal_after")})


def with_type_one_hot(df: DataFrame) -> tuple[DataFrame, list[str]]:
    """All transaction types one-hot (no category dropped)."""
    types = bounded_values(df, "txn_type")
    cols = [f"txn_type_{t}" for t in types]
    return df.select("*", *[(F.col("txn_type") == t).cast("double").alias(c) for t, c in zip(types, cols)]), cols


P25_SQL = with_views("""
SELECT txn_id, CAST(amount AS DOUBLE) AS amount,
       CAST(sender_bal_before AS DOUBLE) - CAST(sender_bal_after AS DOUBLE) AS sender_balance_delta,
       CAST(sender_bal_after AS DOUBLE) - (CAST(sender_bal_before AS DOUBLE) - CAST(amount AS DOUBLE)) AS sender_balance_error,
       CAST(receiver_bal_after AS DOUBLE) - CAST(receiver_bal_before AS DOUBLE) AS receiver_balance_delta,
       CAST(receiver_bal_after AS DOUBLE) - (CAST(receiver_bal_before AS DOUBLE) + CAST(amount AS DOUBLE)) AS receiver_balance_error
FROM transactions""", "transactions")


@register("p25_anomaly_features", P25_SQL, ids=("P25",))
def p25_anomaly_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = anomaly_features(scored_transactions(spark, sf_dir))
    return f.select("txn_id", "amount", "sender_balance_delta", "sender_balance_error", "receiver_balance_delta",
                    "receiver_balance_error")


M7_SQL = with_views("SELECT ROUND(AVG(is_flagged_rule), 10) AS contamination FROM scored_transactions", "transactions")


@register("m7_contamination", M7_SQL, ids=("M7",))
def m7_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored_transactions(spark, sf_dir).agg(F.round(F.avg("is_flagged_rule"), 10).alias("contamination"))


def forest_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule-flagged transactions with forest scores (M5 fit + M6 score); rows carry their labels."""
    t = scored_transactions(spark, sf_dir)
    feats, oh = with_type_one_hot(anomaly_features(t))
    cols = BASE_FEATURE_COLUMNS + oh
    kept = ["txn_id", "txn_type", "is_fraud", "is_flagged_rule"]
    # 200 trees a row are drawn and walked: as many tasks as the cluster has, not as the file has row groups
    feats = materialize(feats.select(*kept, *cols).repartition("txn_id", "amount"))
    totals = feats.agg(F.avg("is_flagged_rule").alias("share"), F.count(F.lit(1)).alias("n")).first()
    nodes = materialize(iforest.fit(feats, cols, "txn_id"))
    return iforest.score_and_flag(feats, nodes, cols, min(iforest.MAX_SAMPLES, totals["n"]),
                                  max(float(totals["share"] or 0.0), 1e-12), carry=kept)


@register("m6_iforest_scores", None, ids=("M5", "M6", "J4"))
def m6_iforest_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest_scores(spark, sf_dir).select("txn_id", F.round("anomaly_score", 6).alias("anomaly_score"),
                                               "is_flagged_iforest")


@register("s16_score_writeback", None, ids=("S14", "S16", "J3"))
def s16_score_writeback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The score columns are added to the stored transactions and set by key from the staged scores;
    staged keys that occur twice go to the reject table.  Returns the numbers of rows."""
    table = BucketTable(spark, scratch_path(spark, f"scored-{uuid.uuid4().hex}"))
    table.create(scored_transactions(spark, sf_dir), ["txn_id"])
    done = table.update(forest_scores(spark, sf_dir).select("txn_id", "anomaly_score", "is_flagged_iforest"),
                        ["anomaly_score", "is_flagged_iforest"])
    return table.read().agg(F.count(F.lit(1)).alias("n_rows"), F.count("anomaly_score").alias("n_updated"),
                            F.lit(done.rejected_rows).cast("long").alias("n_rejected"))


@register("m18_detector_comparison", None, ids=("M18", "A29", "D5"))
def m18_detector_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = forest_scores(spark, sf_dir)
    rule = ev.confusion_matrix(s, y="is_fraud", pred="is_flagged_rule").withColumn("detector", F.lit("Rule engine"))
    forest = ev.confusion_matrix(s, y="is_fraud", pred="is_flagged_iforest").withColumn("detector",
                                                                                         F.lit("Isolation Forest"))
    return rule.unionByName(forest)


@register("d5_rule_forest_crosstab", None, ids=("D5",))
def d5_rule_forest_crosstab(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = forest_scores(spark, sf_dir)
    return s.groupBy("is_flagged_rule", "is_flagged_iforest", "is_fraud").agg(F.count(F.lit(1)).cast("bigint").alias("n"))


@register("d6_anomaly_score_histogram", None, ids=("D6", "A23"))
def d6_anomaly_score_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = forest_scores(spark, sf_dir)
    out = None
    for cls in (0, 1):
        h = histogram(s.where(F.col("is_fraud") == cls), "anomaly_score", 50).withColumn("is_fraud", F.lit(cls))
        out = h if out is None else out.unionByName(h)
    return out


@register("a37_forest_residual", None, ids=("A37", "A38"))
def a37_forest_residual(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fraud the rule misses that the forest catches; forest precision in the rule's blind spot;
    median anomaly score of residual fraud vs legitimate unflagged rows."""
    s = forest_scores(spark, sf_dir)
    resid = (F.col("is_fraud") == 1) & (F.col("is_flagged_rule") == 0)
    legit = (F.col("is_fraud") == 0) & (F.col("is_flagged_rule") == 0)
    a = s.agg(F.count_if(resid).cast("bigint").alias("residual_fraud_total"),
              F.count_if(resid & (F.col("is_flagged_iforest") == 1)).cast("bigint").alias("residual_caught"),
              F.avg(F.when((F.col("is_flagged_rule") == 0) & (F.col("is_flagged_iforest") == 1), F.col("is_fraud")))
              .alias("precision_on_rule_blindspot"))
    grp = F.when(resid, F.lit("residual")).when(legit, F.lit("legitimate"))
    med = exact_quantiles(s.withColumn("grp", grp).where(F.col("grp").isNotNull()), "anomaly_score", [0.5],
                              keys=["grp"])
    medw = med.agg(F.max(F.when(F.col("grp") == "residual", F.col("quantile"))).alias("median_score_residual"),
                   F.max(F.when(F.col("grp") == "legitimate", F.col("quantile"))).alias("median_score_legitimate"))
    a = a.crossJoin(medw)  # both sides are one row
    return a.withColumn("residual_recall", F.try_divide(F.col("residual_caught").cast("double"),
                                                        F.col("residual_fraud_total").cast("double")))
