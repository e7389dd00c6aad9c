"""Customer segmentation: RFM build, scaling, k-means, cluster labels, risk score.

Everything is a Spark job: the RFM table is one ``groupBy`` over the
transactions; scaling statistics are one aggregate; k-means is ``pyspark.ml``;
cluster profiles are k rows; the risk score uses the distributed percent rank
(``ranking.percent_ranks_multi``) instead of a single-partition window.
"""

from __future__ import annotations

from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyspark.functions.exact import exact_avg
from tallyspark.operators.profile import hash_top_n
from tallyspark.operators.ranking import hash_order_key, percent_ranks_multi
from tallyspark.operators.selection import exact_quantiles
from tallyspark.session import side_by_side
from tallyspark.sources.shaped import STEP_ANCHOR

# ---- fixed values -----------------------------------------------------------
REPEAT_FREQUENCY_THRESHOLD = 1.2
LABEL_HIGH_VALUE_LOYAL = "High-Value Loyal"
LABEL_FREQUENT_SMALL = "Frequent Small-Txn"
LABEL_HIGH_ONE_TIME = "High-Value One-Time"
LABEL_STANDARD_ONE_TIME = "Standard One-Time"
LABEL_LOW_ONE_TIME = "Low-Value One-Time"
RISK_WEIGHTS = (0.50, 0.25, 0.25)  # recency, frequency, monetary
SEGMENT_MAX_LEN = 20
RANDOM_STATE = 42


def build_rfm(txns: DataFrame) -> DataFrame:
    """M8: one row per sender; recency in hours from the dataset's max step."""
    g = txns.groupBy(F.col("sender_id").alias("customer_id")).agg(
        F.count(F.lit(1)).cast("bigint").alias("frequency"),
        F.sum("amount").alias("monetary"),
        exact_avg("amount", 2, 2).alias("avg_txn_value"),
        F.min("step").alias("first_step"), F.max("step").alias("last_step"))
    mx = txns.select(F.max("step")).scalar()  # scalar subquery (J2)
    anchor = F.lit(STEP_ANCHOR).cast("timestamp_ntz")  # calendar arithmetic without a session time zone
    return (g.withColumn("recency_hours", (mx - F.col("last_step")).cast("bigint"))
             .withColumn("signup_date", F.timestamp_add("HOUR", F.col("first_step"), anchor).cast("date"))
             .withColumn("last_txn_date", F.timestamp_add("HOUR", F.col("last_step"), anchor).cast("date")))


def rfm_features(rfm: DataFrame, recency: str = "recency_hours", frequency: str = "frequency",
                 monetary: str = "monetary") -> DataFrame:
    """M9: recency, log1p(frequency), log1p(monetary), standardised with the population
    standard deviation (one aggregate, broadcast back)."""
    f = rfm.withColumns({"r_": F.col(recency).cast("double"), "f_": F.log1p(F.col(frequency).cast("double")),
                         "m_": F.log1p(F.col(monetary).cast("double"))})
    st = f.agg(*[x for c in ("r_", "f_", "m_") for x in (F.avg(c).alias(f"{c}mu"), F.stddev_pop(c).alias(f"{c}sd"))])
    j = f.crossJoin(F.broadcast(st))
    for c in ("r_", "f_", "m_"):
        sd = F.col(f"{c}sd")
        j = j.withColumn(c, F.when(sd > 0, (F.col(c) - F.col(f"{c}mu")) / sd).otherwise(F.lit(0.0)))
    out = j.select(*rfm.columns, F.col("r_").alias("recency_z"), F.col("f_").alias("frequency_log_z"),
                   F.col("m_").alias("monetary_log_z"))
    return VectorAssembler(inputCols=["recency_z", "frequency_log_z", "monetary_log_z"],
                           outputCol="features").transform(out)


def fit_kmeans(features: DataFrame, k: int, seed: int = RANDOM_STATE, n_init: int = 10, max_iter: int = 50):
    """K-means|| with ``n_init`` seeds; keep the model with the lowest cost."""
    return fit_kmeans_range(features, [k], seed, n_init, max_iter)[0]


def fit_kmeans_range(features: DataFrame, ks: list[int], seed: int = RANDOM_STATE, n_init: int = 10, max_iter: int = 50) -> list:
    """The model of lowest cost for every k; fits of all k and seeds run side by side, each a chain of short jobs."""
    def fit(start: tuple[int, int]):
        k, i = start
        model = KMeans(k=k, seed=seed + i, maxIter=max_iter, featuresCol="features", predictionCol="cluster").fit(features)
        return model.summary.trainingCost, model

    fits = side_by_side(fit, [(k, i) for k in ks for i in range(n_init)])
    # the first of equal costs
    return [min(fits[j * n_init:(j + 1) * n_init], key=lambda f: f[0])[1] for j in range(len(ks))]


def elbow_silhouette(features: DataFrame, k_range=range(2, 11), sample_fraction: float = 1.0,
                     seed: int = RANDOM_STATE, n_init: int = 10) -> DataFrame:
    """Inertia and (simplified, centroid-based) silhouette per k on a hash sample."""
    spark = features.sparkSession
    sample = features
    if sample_fraction < 1.0:
        h = F.conv(F.substring(hash_order_key(F.col("customer_id"), str(seed)), 1, 8), 16, 10).cast("double")
        sample = features.where(h / F.lit(float(0xFFFFFFFF)) < F.lit(sample_fraction))
    ks = [int(k) for k in k_range]

    def row(fitted: tuple) -> tuple[int, float, float]:
        k, m = fitted
        ev = ClusteringEvaluator(featuresCol="features", predictionCol="cluster", distanceMeasure="squaredEuclidean")
        return k, float(m.summary.trainingCost), float(ev.evaluate(m.transform(sample)))

    rows = side_by_side(row, zip(ks, fit_kmeans_range(sample, ks, seed, n_init)))
    return spark.createDataFrame(rows, "k int, inertia double, silhouette double")


def profile_clusters(assigned: DataFrame, cluster: str = "cluster", recency: str = "recency_hours",
                     frequency: str = "frequency", monetary: str = "monetary") -> DataFrame:
    """Size and raw R/F/M means per cluster (k rows)."""
    return assigned.groupBy(cluster).agg(
        F.count(F.lit(1)).cast("bigint").alias("n_customers"),
        F.avg(F.col(recency).cast("double")).alias("avg_recency"),
        F.avg(F.col(frequency).cast("double")).alias("avg_frequency"),
        F.avg(F.col(monetary).cast("double")).alias("avg_monetary"))


def label_clusters(profile: DataFrame, cluster: str = "cluster") -> DataFrame:
    """Business labels for the k cluster profiles (k rows, single small window).

    Repeat clusters (avg frequency > 1.2) split at the median of their average
    monetary value; one-time clusters are tiered into thirds by monetary rank
    (``rank`` min method, descending).
    """
    rep = F.col("avg_frequency") > REPEAT_FREQUENCY_THRESHOLD
    p = profile.withColumn("_repeat", rep)
    wg = Window.partitionBy("_repeat")
    p = p.withColumn("_grp_median", F.percentile(F.col("avg_monetary"), F.lit(0.5)).over(wg))
    p = p.withColumn("_n", F.count(F.lit(1)).over(wg))
    p = p.withColumn("_rank", F.rank().over(wg.orderBy(F.desc("avg_monetary"))))
    label = (F.when(F.col("_repeat") & (F.col("avg_monetary") >= F.col("_grp_median")), F.lit(LABEL_HIGH_VALUE_LOYAL))
              .when(F.col("_repeat"), F.lit(LABEL_FREQUENT_SMALL))
              .when(F.col("_rank") <= F.col("_n") / 3, F.lit(LABEL_HIGH_ONE_TIME))
              .when(F.col("_rank") > 2 * F.col("_n") / 3, F.lit(LABEL_LOW_ONE_TIME))
              .otherwise(F.lit(LABEL_STANDARD_ONE_TIME)))
    too_long = F.raise_error(F.concat(F.lit(f"segment label longer than {SEGMENT_MAX_LEN}: "), F.col("segment")))
    return p.select(cluster, label.alias("segment")).select(
        cluster, F.when(F.length("segment") <= SEGMENT_MAX_LEN, F.col("segment")).otherwise(too_long).alias("segment"))


def rule_segment(customers: DataFrame, count: str = "total_txn_count", value: str = "total_txn_value") -> DataFrame:
    """Model-free segment (oracle-checkable): repeat = more than one transaction;
    value tier = at or above the population median of total value (exact)."""
    med = exact_quantiles(customers, value, [0.5]).select("quantile").scalar()  # scalar subquery
    j = customers
    high = F.col(value).cast("double") >= med
    rep = F.col(count) > 1
    seg = (F.when(rep & high, F.lit(LABEL_HIGH_VALUE_LOYAL)).when(rep, F.lit(LABEL_FREQUENT_SMALL))
            .when(high, F.lit(LABEL_HIGH_ONE_TIME)).otherwise(F.lit(LABEL_LOW_ONE_TIME)))
    return j.withColumn("segment", seg)


def risk_scores(customers: DataFrame, n_buckets: int | None = None) -> DataFrame:
    """ROUND(100 * (0.50 PR(last_txn_date DESC) + 0.25 PR(count DESC)
    + 0.25 PR(value DESC)), 2) with exact distributed percent ranks."""
    c = customers.withColumn("_d", F.datediff(F.col("last_txn_date"), F.lit("1970-01-01").cast("date")))
    # DESC order == ascending order of the negated value (no NULLs in these columns)
    c = percent_ranks_multi(c, {"_pr_r": ("_d", False), "_pr_f": ("total_txn_count", False),
                                "_pr_m": ("total_txn_value", False)}, n_buckets)
    wr, wf, wm = RISK_WEIGHTS
    blend = (F.lit(wr) * F.col("_pr_r") + F.lit(wf) * F.col("_pr_f") + F.lit(wm) * F.col("_pr_m")) * 100
    score = F.round(blend.cast("decimal(20,10)"), 2).cast("decimal(5,2)")
    return c.withColumn("risk_score", score).drop("_d", "_pr_r", "_pr_f", "_pr_m")


def hash_sample(df: DataFrame, key: str, n: int, salt: str = str(RANDOM_STATE)) -> DataFrame:
    """Deterministic n-row sample (min(n, N)): the rows of smallest md5(key || salt)."""
    return hash_top_n(df, key, n, salt)
