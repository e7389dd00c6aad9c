"""Customer / segment queries: S18 (+S17, W3, M14), V5, N13, N14, D9, M8, M10-M13."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyspark.functions.exact import count_bigint, exact_avg
from tallyspark.functions.risk import pct_rate
from tallyspark.operators import segments as sg
from tallyspark.plans.registry import register
from tallyspark.session import materialize
from tallyspark.sources.shaped import customer_aggregates, exact_avg_sql, transactions, with_views


def customers_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customers table: aggregates, rule segment, risk score (write-back S17 as a projection)."""
    # one row per customer, read by the median, the three ranks and the output: materialise once
    return sg.risk_scores(sg.rule_segment(materialize(customer_aggregates(spark, sf_dir))))


CUSTOMERS_SQL = """
cust_seg AS (
  SELECT c.*, CASE WHEN total_txn_count > 1 AND CAST(total_txn_value AS DOUBLE) >= med THEN 'High-Value Loyal'
                   WHEN total_txn_count > 1 THEN 'Frequent Small-Txn'
                   WHEN CAST(total_txn_value AS DOUBLE) >= med THEN 'High-Value One-Time'
                   ELSE 'Low-Value One-Time' END AS segment
  FROM customer_aggregates c CROSS JOIN (SELECT quantile_cont(CAST(total_txn_value AS DOUBLE), 0.5) AS med
                                         FROM customer_aggregates) m
),
customers AS (
  SELECT *, CAST(ROUND(CAST((0.50 * PERCENT_RANK() OVER (ORDER BY last_txn_date DESC)
                         + 0.25 * PERCENT_RANK() OVER (ORDER BY total_txn_count DESC)
                         + 0.25 * PERCENT_RANK() OVER (ORDER BY CAST(total_txn_value AS DOUBLE) DESC)) * 100
                        AS DECIMAL(20,10)), 2) AS DECIMAL(5,2)) AS risk_score
  FROM cust_seg
)"""


def _csql(body: str) -> str:
    return with_views(body, "customer_aggregates", extra=CUSTOMERS_SQL)


# S18 --------------------------------------------------------------------------
S18_SQL = _csql("""
SELECT customer_id, signup_date, segment, CAST(total_txn_count AS BIGINT) AS total_txn_count,
       CAST(total_txn_value AS DOUBLE) AS total_txn_value, CAST(avg_txn_value AS DOUBLE) AS avg_txn_value,
       last_txn_date, CAST(risk_score AS DOUBLE) AS risk_score
FROM customers""")


@register("s18_customers", S18_SQL, ids=("S18", "S17", "M14", "W3", "J3", "A15"))
def s18_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = customers_table(spark, sf_dir)
    return c.select("customer_id", "signup_date", "segment", F.col("total_txn_count").cast("bigint"),
                    F.col("total_txn_value").cast("double"), F.col("avg_txn_value").cast("double"),
                    "last_txn_date", F.col("risk_score").cast("double"))


# V5 ---------------------------------------------------------------------------
V5_BODY = f"""
SELECT g.*, ROUND(100.0 * n_customers / everyone, 2) AS pct_of_customers
FROM (SELECT segment, CAST(COUNT(*) AS BIGINT) AS n_customers, CAST(SUM(total_txn_value) AS DOUBLE) AS total_segment_value,
             {exact_avg_sql('total_txn_count', 0, 3)} AS avg_frequency, {exact_avg_sql('total_txn_value', 2, 2)} AS avg_monetary,
             {exact_avg_sql('avg_txn_value', 2, 2)} AS avg_txn_value, {exact_avg_sql('risk_score', 2, 2)} AS avg_risk_score,
             {exact_avg_sql('days_since', 0, 2)} AS avg_recency_days_proxy
      FROM (SELECT c.*, date_diff('day', last_txn_date, newest) AS days_since
            FROM customers c, (SELECT MAX(last_txn_date) AS newest FROM customers) e) aged
      WHERE segment IS NOT NULL GROUP BY segment) g,
     (SELECT COUNT(segment) AS everyone FROM customers) t"""
V5_SQL = _csql(V5_BODY)


def segment_summary(customers: DataFrame, aggregates: DataFrame) -> DataFrame:
    # the latest date comes from the plain aggregates: ranking the customers for it would repeat W3
    mx = aggregates.select(F.max("last_txn_date")).scalar()  # scalar subquery (J2)
    base = customers.where(F.col("segment").isNotNull()).withColumn("_rec", F.datediff(mx, F.col("last_txn_date")))
    g = base.groupBy("segment").agg(
        count_bigint().alias("n_customers"),
        exact_avg("total_txn_count", 0, 3).alias("avg_frequency"),
        exact_avg("total_txn_value", 2, 2).alias("avg_monetary"),
        exact_avg("avg_txn_value", 2, 2).alias("avg_txn_value"),
        F.sum("total_txn_value").cast("double").alias("total_segment_value"),
        exact_avg("_rec", 0, 2).alias("avg_recency_days_proxy"),
        exact_avg("risk_score", 2, 2).alias("avg_risk_score"))
    # window over the aggregate: one row per segment reaches this partition
    share = pct_rate(F.col("n_customers"), F.sum("n_customers").over(Window.partitionBy()), 2)
    return g.withColumn("pct_of_customers", share).select(
        "segment", "n_customers", "pct_of_customers", "avg_frequency", "avg_monetary", "avg_txn_value",
        "total_segment_value", "avg_recency_days_proxy", "avg_risk_score")


@register("v5_segment_summary", V5_SQL, ids=("V5", "J2", "W4", "A6", "S13"))
def v5_segment_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    aggregates = materialize(customer_aggregates(spark, sf_dir))
    return segment_summary(sg.risk_scores(sg.rule_segment(aggregates)), aggregates)


# N13 --------------------------------------------------------------------------
N13_SQL = _csql(f"""
SELECT segment, CAST(COUNT(*) AS BIGINT) AS n, {exact_avg_sql('total_txn_value', 2, 2)} AS avg_total_value,
       {exact_avg_sql('risk_score', 2, 2)} AS avg_risk_score
FROM customers GROUP BY segment ORDER BY avg_risk_score""")


@register("n13_segment_check", N13_SQL, ids=("N13",))
def n13_segment_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = customers_table(spark, sf_dir)
    return c.groupBy("segment").agg(count_bigint().alias("n"), exact_avg("total_txn_value", 2, 2).alias("avg_total_value"),
                                    exact_avg("risk_score", 2, 2).alias("avg_risk_score")).orderBy("avg_risk_score")


# N14 --------------------------------------------------------------------------
N14_SQL = _csql("""
SELECT CAST(total_txn_count AS BIGINT) AS frequency, CAST(COUNT(*) AS BIGINT) AS n_customers,
       ROUND(100.0 * COUNT(*) / SUM(COUNT(*)) OVER (), 3) AS pct_of_customers
FROM customer_aggregates GROUP BY total_txn_count""")


@register("n14_frequency_distribution", N14_SQL, ids=("N14", "A17"))
def n14_frequency_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = customer_aggregates(spark, sf_dir)
    g = c.groupBy(F.col("total_txn_count").cast("bigint").alias("frequency")).agg(count_bigint().alias("n_customers"))
    return g.withColumn("pct_of_customers",
                        pct_rate(F.col("n_customers"), F.sum("n_customers").over(Window.partitionBy()), 3)) \
        .orderBy("frequency")


# D9 ---------------------------------------------------------------------------
D9_SAMPLE = 15000
D9_SQL = _csql(f"""
SELECT customer_id, CAST((SELECT MAX(last_txn_date) FROM customers) - last_txn_date AS BIGINT) AS recency_days,
       GREATEST(CAST(total_txn_value AS DOUBLE), 1.0) AS monetary_clipped,
       CAST(total_txn_count AS BIGINT) AS frequency, segment
FROM customers ORDER BY md5(customer_id || '42'), customer_id LIMIT {D9_SAMPLE}""")


@register("d9_bubble_sample", D9_SQL, ids=("D9", "L5", "L8", "P28"))
def d9_bubble_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = sg.rule_segment(materialize(customer_aggregates(spark, sf_dir)))
    mx = c.select(F.max("last_txn_date")).scalar()
    out = c.select("customer_id", F.datediff(mx, F.col("last_txn_date")).cast("bigint").alias("recency_days"),
                   F.greatest(F.col("total_txn_value").cast("double"), F.lit(1.0)).alias("monetary_clipped"),
                   F.col("total_txn_count").cast("bigint").alias("frequency"), "segment")
    # sampling operator: the limit is the feature (n rows, n fixed)
    return sg.hash_sample(out, "customer_id", D9_SAMPLE)


# M8 ---------------------------------------------------------------------------
M8_SQL = with_views(f"""
SELECT sender_id AS customer_id, CAST(COUNT(*) AS BIGINT) AS frequency, CAST(SUM(amount) AS DOUBLE) AS monetary,
       {exact_avg_sql('amount', 2, 2)} AS avg_txn_value, first_step, last_step,
       CAST((SELECT MAX(step) FROM transactions) - last_step AS BIGINT) AS recency_hours,
       CAST(TIMESTAMP '2023-01-01' + first_step * INTERVAL '1 hour' AS DATE) AS signup_date,
       CAST(TIMESTAMP '2023-01-01' + last_step * INTERVAL '1 hour' AS DATE) AS last_txn_date
FROM (SELECT sender_id, amount, step, MIN(step) OVER (PARTITION BY sender_id) AS first_step,
             MAX(step) OVER (PARTITION BY sender_id) AS last_step FROM transactions) t
GROUP BY sender_id, first_step, last_step""", "transactions")


@register("m8_rfm_build", M8_SQL, ids=("M8", "W10", "J2", "F2"))
def m8_rfm_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = sg.build_rfm(transactions(spark, sf_dir))
    return r.select("customer_id", "frequency", F.col("monetary").cast("double").alias("monetary"),
                    F.col("avg_txn_value").cast("double").alias("avg_txn_value"), "first_step", "last_step",
                    "recency_hours", "signup_date", "last_txn_date")


# K-means segmentation (model output: rows-only check) ---------------------
def orders_rfm(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = customer_aggregates(spark, sf_dir)
    mx = c.select(F.max("last_txn_date")).scalar()
    return c.select(
        "customer_id", F.datediff(mx, F.col("last_txn_date")).cast("double").alias("recency_days"),
        F.col("total_txn_count").alias("frequency"), F.col("total_txn_value").cast("double").alias("monetary"))


def kmeans_segments(spark: SparkSession, sf_dir: str, k: int = 4) -> DataFrame:
    """M9-M13 on the orders RFM table."""
    feats = materialize(sg.rfm_features(orders_rfm(spark, sf_dir), recency="recency_days"))
    model = sg.fit_kmeans(feats, k)
    assigned = model.transform(feats)
    labels = sg.label_clusters(sg.profile_clusters(assigned, recency="recency_days"))
    # k rows: broadcast by construction
    return assigned.join(F.broadcast(labels), "cluster", "left").select(
        "customer_id", "cluster", "segment", "recency_days", "frequency", "monetary")


@register("m10_kmeans_segments", None, ids=("M9", "M10", "M13", "J5"))
def m10_kmeans_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kmeans_segments(spark, sf_dir)


@register("m12_cluster_profile", None, ids=("M12", "M13", "W9"))
def m12_cluster_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    seg = materialize(kmeans_segments(spark, sf_dir))
    prof = sg.profile_clusters(seg, recency="recency_days")
    labels = seg.select("cluster", "segment").distinct()
    return prof.join(labels, "cluster")


@register("m11_elbow_silhouette", None, ids=("M11",))
def m11_elbow_silhouette(spark: SparkSession, sf_dir: str) -> DataFrame:
    feats = materialize(sg.rfm_features(orders_rfm(spark, sf_dir), recency="recency_days"))
    return sg.elbow_silhouette(feats, range(2, 11))


# M12/M13/W9 with an oracle: the cluster labelling rules on a deterministic clustering
FREQ_BUCKETS = 10
M13_SQL = with_views(f"""
SELECT cluster, n_customers, ROUND(avg_recency, 6) AS avg_recency, ROUND(avg_frequency, 6) AS avg_frequency,
       ROUND(avg_monetary, 6) AS avg_monetary,
       CASE WHEN rep AND avg_monetary >= med THEN 'High-Value Loyal'
            WHEN rep THEN 'Frequent Small-Txn'
            WHEN rk <= n_grp / 3 THEN 'High-Value One-Time'
            WHEN rk > 2 * n_grp / 3 THEN 'Low-Value One-Time'
            ELSE 'Standard One-Time' END AS segment
FROM (
  SELECT *, avg_frequency > 1.2 AS rep,
         quantile_cont(avg_monetary, 0.5) OVER (PARTITION BY avg_frequency > 1.2) AS med,
         rank() OVER (PARTITION BY avg_frequency > 1.2 ORDER BY avg_monetary DESC) AS rk,
         count(*) OVER (PARTITION BY avg_frequency > 1.2) AS n_grp
  FROM (
    SELECT CAST(LEAST(total_txn_count, {FREQ_BUCKETS}) AS INTEGER) AS cluster, CAST(COUNT(*) AS BIGINT) AS n_customers,
           {exact_avg_sql('((SELECT MAX(last_txn_date) FROM customer_aggregates) - last_txn_date)', 0, 6)} AS avg_recency,
           {exact_avg_sql('total_txn_count', 0, 6)} AS avg_frequency,
           {exact_avg_sql('total_txn_value', 2, 6)} AS avg_monetary
    FROM customer_aggregates GROUP BY 1) p
) l""", "customer_aggregates")


@register("m13_cluster_labels_by_frequency_bucket", M13_SQL, ids=("M12", "M13", "W9", "J5"))
def m13_cluster_labels_by_frequency_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = customer_aggregates(spark, sf_dir)
    mx = c.select(F.max("last_txn_date")).scalar()
    r = c.select(F.least(F.col("total_txn_count"), F.lit(FREQ_BUCKETS)).cast("int").alias("cluster"),
                 F.datediff(mx, F.col("last_txn_date")).alias("_rec"), "total_txn_count", "total_txn_value")
    # exact averages (integer days and counts, decimal money), so labels and outputs do not
    # depend on float summation order
    prof = r.groupBy("cluster").agg(count_bigint().alias("n_customers"),
                                    exact_avg("_rec", 0, 6).alias("avg_recency"),
                                    exact_avg("total_txn_count", 0, 6).alias("avg_frequency"),
                                    exact_avg("total_txn_value", 2, 6).alias("avg_monetary"))
    labels = sg.label_clusters(prof)
    # k rows on both sides
    out = prof.join(F.broadcast(labels), "cluster")
    return out.select("cluster", "n_customers", *[F.round(c, 6).alias(c) for c in
                                                  ("avg_recency", "avg_frequency", "avg_monetary")], "segment")
