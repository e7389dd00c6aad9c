"""Evaluation queries (A29-A38) over deterministic scores (FIXTURES §B6)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.operators import evaluation as ev
from tallyspark.operators.selection import exact_quantiles
from tallyspark.plans.registry import register
from tallyspark.sources.shaped import fraud_scored, scored_labels, scored_transactions, with_views

THRESHOLD = 0.5
RATES = (0.15, 0.25, 0.35)


def _r(df: DataFrame, cols, digits=10) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), digits) for c in cols})


# A29 / A30 ------------------------------------------------------------------------
A30_SQL = with_views(f"""
SELECT tp, fp, fn, tn,
       ROUND(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END, 6) AS precision,
       ROUND(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END, 6) AS recall,
       ROUND(CASE WHEN tp > 0 THEN 2 * (tp / (tp + fp)) * (tp / (tp + fn)) / ((tp / (tp + fp)) + (tp / (tp + fn))) ELSE 0 END, 6) AS f1,
       ROUND(auc, 10) AS auc, {THRESHOLD} AS threshold
FROM (
  SELECT CAST(count(*) FILTER (WHERE score >= {THRESHOLD} AND y = 1) AS BIGINT) AS tp,
         CAST(count(*) FILTER (WHERE score >= {THRESHOLD} AND y = 0) AS BIGINT) AS fp,
         CAST(count(*) FILTER (WHERE score < {THRESHOLD} AND y = 1) AS BIGINT) AS fn,
         CAST(count(*) FILTER (WHERE score < {THRESHOLD} AND y = 0) AS BIGINT) AS tn
  FROM scored) c
CROSS JOIN (
  SELECT SUM(pos * (neg_before + neg * 0.5)) / (SUM(pos) * SUM(neg)) AS auc FROM (
    SELECT score, pos, neg, COALESCE(SUM(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_before
    FROM (SELECT score, SUM(y) AS pos, SUM(1 - y) AS neg FROM scored GROUP BY score) g) s) a""", "scored")


@register("a30_evaluate_at_threshold", A30_SQL, ids=("A30", "A29", "A31"))
def a30_evaluate_at_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = ev.evaluate_at_threshold(scored_labels(spark, sf_dir), THRESHOLD)
    return out.withColumn("auc", F.round("auc", 10))


_CURVE_CTE = """
curve_base AS (
  SELECT score AS threshold, pos, neg,
         COALESCE(SUM(pos) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos_before,
         COALESCE(SUM(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_before,
         SUM(pos) OVER () AS p_, SUM(neg) OVER () AS n_
  FROM (SELECT score, SUM(y) AS pos, SUM(1 - y) AS neg FROM {src} GROUP BY score) g
),
curve AS (
  SELECT threshold, CAST(p_ - pos_before AS BIGINT) AS tp, CAST(n_ - neg_before AS BIGINT) AS fp,
         (p_ - pos_before) / ((p_ - pos_before) + (n_ - neg_before)) AS precision,
         (p_ - pos_before) / p_ AS recall, (n_ - neg_before) / n_ AS fpr
  FROM curve_base
)"""


# A32 ROC ----------------------------------------------------------------------------
A32_SQL = with_views("""
SELECT threshold, tp, fp, ROUND(recall, 10) AS tpr, ROUND(fpr, 10) AS fpr FROM curve""", "scored",
                     extra=_CURVE_CTE.format(src="scored"))


@register("a32_roc_curve", A32_SQL, ids=("A32",))
def a32_roc_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = ev.threshold_curve(scored_labels(spark, sf_dir))
    return _r(c.select("threshold", "tp", "fp", "tpr", "fpr"), ["tpr", "fpr"])


# A33 PR curve --------------------------------------------------------------------------
A33_BODY = """
SELECT threshold, tp, fp, ROUND(precision, 10) AS precision, ROUND(recall, 10) AS recall,
       ROUND(CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall + 1e-12) ELSE 0 END, 10) AS f1,
       ROUND(CASE WHEN precision + recall > 0 THEN 5 * precision * recall / (4 * precision + recall + 1e-12) ELSE 0 END, 10) AS f2
FROM curve WHERE threshold >= (SELECT MIN(score) FROM {src} WHERE y = 1)"""
A33_SQL = with_views(A33_BODY.format(src="scored"), "scored", extra=_CURVE_CTE.format(src="scored"))


@register("a33_pr_curve", A33_SQL, ids=("A33",))
def a33_pr_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = ev.pr_curve(scored_labels(spark, sf_dir))
    return _r(c.select("threshold", "tp", "fp", "precision", "recall", "f1", "f2"), ["precision", "recall", "f1", "f2"])


A33F_SQL = with_views(A33_BODY.format(src="fraud_scored"), "fraud_scored", extra=_CURVE_CTE.format(src="fraud_scored"))


@register("a33_pr_curve_fraud_scores", A33F_SQL, ids=("A33",))
def a33_pr_curve_fraud_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same curve over every transaction (larger evaluation set)."""
    c = ev.pr_curve(fraud_scored(spark, sf_dir))
    return _r(c.select("threshold", "tp", "fp", "precision", "recall", "f1", "f2"), ["precision", "recall", "f1", "f2"])


# A34 ---------------------------------------------------------------------------------
A34_SQL = with_views("""
SELECT threshold, ROUND(fbeta, 10) AS fbeta, ROUND(precision, 10) AS precision, ROUND(recall, 10) AS recall FROM (
  SELECT threshold, precision, recall,
         CASE WHEN precision + recall > 0 THEN (1 + 4.0) * precision * recall / (4.0 * precision + recall + 1e-12) ELSE 0 END AS fbeta
  FROM curve WHERE threshold >= (SELECT MIN(score) FROM scored WHERE y = 1)
) ORDER BY fbeta DESC, threshold ASC LIMIT 1""", "scored", extra=_CURVE_CTE.format(src="scored"))


@register("a34_best_f2_threshold", A34_SQL, ids=("A34",))
def a34_best_f2_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _r(ev.best_fbeta_threshold(scored_labels(spark, sf_dir), beta=2.0), ["fbeta", "precision", "recall"])


# A35 / A36 ---------------------------------------------------------------------------
A36_SQL = with_views("SELECT * FROM (" + " UNION ALL ".join(f"""
SELECT {r} AS target_flagged_rate, ROUND(t, 6) AS threshold,
       ROUND((tp + fp) / n_, 6) AS actual_flagged_rate, CAST(tp + fp AS BIGINT) AS flagged_count,
       ROUND(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END, 6) AS precision,
       ROUND(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END, 6) AS recall,
       ROUND(CASE WHEN tp > 0 THEN 2 * (tp / (tp + fp)) * (tp / (tp + fn)) / ((tp / (tp + fp)) + (tp / (tp + fn))) ELSE 0 END, 6) AS f1,
       CAST(tp AS BIGINT) AS defaults_caught, CAST(fn AS BIGINT) AS defaults_missed
FROM (SELECT t, count(*) AS n_, count(*) FILTER (WHERE score >= t AND y = 1) AS tp,
             count(*) FILTER (WHERE score >= t AND y = 0) AS fp, count(*) FILTER (WHERE score < t AND y = 1) AS fn
      FROM scored CROSS JOIN (SELECT quantile_cont(score, {1 - r}) AS t FROM scored) q GROUP BY t) x"""
                                                        for r in RATES) + ") u", "scored")


@register("a36_threshold_tradeoff", A36_SQL, ids=("A35", "A36"))
def a36_threshold_tradeoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.tradeoff_table(scored_labels(spark, sf_dir), RATES)


# A37 ---------------------------------------------------------------------------------
A37_SQL = with_views(f"""
SELECT CAST(count(*) FILTER (WHERE t.is_fraud = 1 AND t.is_flagged_rule = 0) AS BIGINT) AS residual_fraud_total,
       CAST(count(*) FILTER (WHERE t.is_fraud = 1 AND t.is_flagged_rule = 0 AND f.score >= {THRESHOLD}) AS BIGINT) AS residual_caught,
       ROUND(count(*) FILTER (WHERE t.is_fraud = 1 AND t.is_flagged_rule = 0 AND f.score >= {THRESHOLD})
             / count(*) FILTER (WHERE t.is_fraud = 1 AND t.is_flagged_rule = 0), 6) AS residual_recall,
       ROUND(AVG(CASE WHEN t.is_flagged_rule = 0 AND f.score >= {THRESHOLD} THEN t.is_fraud END), 6) AS precision_on_rule_blindspot
FROM scored_transactions t JOIN fraud_scored f ON t.txn_id = f.doc_id""", "fraud_scored")


def residual_evaluation(txns: DataFrame, scores: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Fraud the rule misses, how much detector B catches there, and B's precision in
    the rule's blind spot.  B's score is a projection of the same rows (join on the key)."""
    j = txns.select("txn_id", "is_fraud", "is_flagged_rule").join(
        scores.select(F.col("doc_id").alias("txn_id"), "score"), "txn_id")
    resid = (F.col("is_fraud") == 1) & (F.col("is_flagged_rule") == 0)
    b = F.col("score") >= threshold
    a = j.agg(F.count_if(resid).cast("bigint").alias("residual_fraud_total"),
              F.count_if(resid & b).cast("bigint").alias("residual_caught"),
              F.avg(F.when((F.col("is_flagged_rule") == 0) & b, F.col("is_fraud"))).alias("_p"))
    return a.select("residual_fraud_total", "residual_caught",
                    F.round(F.try_divide(F.col("residual_caught").cast("double"),
                                         F.col("residual_fraud_total").cast("double")), 6).alias("residual_recall"),
                    F.round("_p", 6).alias("precision_on_rule_blindspot"))


@register("a37_residual_evaluation", A37_SQL, ids=("A37", "J4"))
def a37_residual_evaluation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return residual_evaluation(scored_transactions(spark, sf_dir), fraud_scored(spark, sf_dir))


# A38 ---------------------------------------------------------------------------------
A38_SQL = with_views("""
SELECT y, ROUND(quantile_cont(score, 0.5), 6) AS median_score FROM fraud_scored GROUP BY y
UNION ALL
SELECT -1 AS y, ROUND(lo + (hi - lo) * (h - floor(h)), 6) AS median_score FROM (
  SELECT MAX(CASE WHEN pos = floor(h) THEN score END) AS lo, MAX(CASE WHEN pos = ceil(h) THEN score END) AS hi,
         MAX(h) AS h
  FROM (SELECT score, row_number() OVER (ORDER BY score) - 1 AS pos, count(*) OVER () AS n FROM fraud_scored) o
  CROSS JOIN (SELECT (COUNT(*) - 1) * (1 - (SELECT AVG(is_flagged_rule) FROM scored_transactions)) AS h
              FROM fraud_scored) hh
) x""", "fraud_scored")


@register("a38_score_distribution_contrast", A38_SQL, ids=("A38",))
def a38_score_distribution_contrast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Median score per class and the flag threshold at quantile 1 - (rule flag rate), y = -1."""
    s = fraud_scored(spark, sf_dir)
    med = exact_quantiles(s, "score", [0.5], keys=["y"]).select(
        F.col("y").cast("int").alias("y"), F.round("quantile", 6).alias("median_score"))
    rate = scored_transactions(spark, sf_dir).agg(F.avg("is_flagged_rule").alias("_r")).first()["_r"]
    thr = exact_quantiles(s, "score", [1 - float(rate)]).select(
        F.lit(-1).alias("y"), F.round("quantile", 6).alias("median_score"))
    return med.unionByName(thr)
