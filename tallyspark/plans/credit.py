"""Credit-risk KPIs over the ``loans`` table: Q1-Q3, V1, N1-N3, N8, N9, D2, D3, D8."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyspark.functions.exact import count_bigint, exact_avg
from tallyspark.functions.risk import CLOSED_LOAN_STATUSES, DEFAULT_STATUSES, is_default, pct_rate, sql_fico_band
from tallyspark.operators.comoments import column_correlations
from tallyspark.operators.profile import bounded_values
from tallyspark.plans.registry import register
from tallyspark.session import materialize
from tallyspark.sources.shaped import exact_avg_sql, loans, with_views

_DEF_SQL = "SUM(CASE WHEN loan_status IN ('Charged Off','Default') THEN 1 ELSE 0 END)"


def default_rate_by(df: DataFrame, *keys, count_name: str = "total_loans", with_defaults: bool = False,
                    extra=()) -> DataFrame:
    """COUNT / defaults / ROUND(100*defaults/COUNT, 2) grouped by ``keys`` (A1, A3, A4)."""
    aggs = [count_bigint().alias(count_name), F.sum(is_default()).cast("bigint").alias("_def"), *extra]
    g = df.groupBy(*keys).agg(*aggs)
    out = g.withColumn("default_rate_pct", pct_rate(F.col("_def"), F.col(count_name), 2))
    if with_defaults:
        out = out.withColumnRenamed("_def", "defaults")
    else:
        out = out.drop("_def")
    return out


def _outcomes_sql(key: str, name: str, extra: str = "") -> str:
    """Oracle building block: loans counted by key and outcome first, then summed per key
    (``issued``, ``lost``); ``extra`` is joined in from a second aggregate over the same key."""
    lost = ", ".join(f"'{s}'" for s in sorted(DEFAULT_STATUSES))
    tally = (f"(SELECT {name}, SUM(n) AS issued, SUM(n * went_bad) AS lost FROM (SELECT {key} AS {name}, "
             f"CAST(loan_status IN ({lost}) AS INTEGER) AS went_bad, COUNT(*) AS n FROM loans GROUP BY ALL) GROUP BY {name})")
    if not extra:
        return f"{tally} o"
    return f"{tally} o JOIN (SELECT {key} AS {name}, {extra} FROM loans GROUP BY ALL) x ON o.{name} IS NOT DISTINCT FROM x.{name}"


_RATE_SQL = "ROUND(100.0 * lost / issued, 2)"

# Q1 --------------------------------------------------------------------------
Q1_SQL = with_views(f"""
SELECT grade, CAST(issued AS BIGINT) AS total_loans, CAST(lost AS BIGINT) AS defaults, {_RATE_SQL} AS default_rate_pct
FROM {_outcomes_sql('grade', 'grade')}""", "loans")


@register("q1_default_rate_by_grade", Q1_SQL, ids=("Q1", "A1", "A3", "A4", "L1"))
def q1_default_rate_by_grade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (default_rate_by(loans(spark, sf_dir), "grade", with_defaults=True)
            .select("grade", "total_loans", "defaults", "default_rate_pct").orderBy("grade"))


# Q2 --------------------------------------------------------------------------
# fixed values: band names and limits; a missing score counts as Prime
_BAND_SQL = ("CASE WHEN fico_range_low >= 720 OR fico_range_low IS NULL THEN 'Prime (720+)' "
             "WHEN fico_range_low >= 660 THEN 'Near-Prime (660-719)' ELSE 'Subprime (<660)' END")
Q2_SQL = with_views(f"""
SELECT o.fico_band, avg_dti, {_RATE_SQL} AS default_rate_pct
FROM {_outcomes_sql(_BAND_SQL, 'fico_band', exact_avg_sql('dti', 2, 2) + ' AS avg_dti')}""", "loans")


@register("q2_fico_band_default", Q2_SQL, ids=("Q2", "P19", "A7"))
def q2_fico_band_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = loans(spark, sf_dir).withColumn("fico_band", sql_fico_band())
    g = default_rate_by(df, "fico_band", extra=[exact_avg("dti", 2, 2).alias("avg_dti")])
    return g.select("fico_band", "avg_dti", "default_rate_pct").orderBy(F.desc("default_rate_pct"), "fico_band")


# Q3 --------------------------------------------------------------------------
_QUARTER_SQL = "make_date(year(issue_date), 3 * quarter(issue_date) - 2, 1)"
Q3_SQL = with_views(f"""
SELECT vintage_quarter, CAST(issued AS BIGINT) AS loans_issued, {_RATE_SQL} AS default_rate_pct
FROM {_outcomes_sql(_QUARTER_SQL, 'vintage_quarter')}""", "loans")


@register("q3_vintage_default", Q3_SQL, ids=("Q3", "F2", "A7"))
def q3_vintage_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = loans(spark, sf_dir).withColumn("vintage_quarter", F.trunc("issue_date", "quarter"))
    return (default_rate_by(df, "vintage_quarter", count_name="loans_issued")
            .select("vintage_quarter", "loans_issued", "default_rate_pct").orderBy("vintage_quarter"))


# V1 --------------------------------------------------------------------------
V1_SQL_BODY = f"""
SELECT o.cell.grade AS grade, o.cell.purpose AS purpose, CAST(issued AS BIGINT) AS loan_count, avg_interest_rate, {_RATE_SQL} AS default_rate_pct
FROM {_outcomes_sql("struct_pack(grade := grade, purpose := purpose)", 'cell', exact_avg_sql('interest_rate', 2, 2) + ' AS avg_interest_rate')}"""
V1_SQL = with_views(V1_SQL_BODY, "loans")


def credit_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = default_rate_by(loans(spark, sf_dir), "grade", "purpose", count_name="loan_count",
                        extra=[exact_avg("interest_rate", 2, 2).alias("avg_interest_rate")])
    return g.select("grade", "purpose", "loan_count", "avg_interest_rate", "default_rate_pct")


@register("v1_credit_kpis", V1_SQL, ids=("V1", "S13", "A6"))
def v1_credit_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return credit_kpis(spark, sf_dir)


# N1 --------------------------------------------------------------------------
N1_SQL = with_views(f"""
SELECT * FROM (
  SELECT purpose, CAST(COUNT(*) AS BIGINT) AS total_loans,
         ROUND(100.0 * {_DEF_SQL} / COUNT(*), 2) AS default_rate_pct
  FROM loans GROUP BY purpose ORDER BY total_loans DESC, purpose LIMIT 10
) t ORDER BY default_rate_pct DESC""", "loans")


@register("n1_purpose_top10_by_volume", N1_SQL, ids=("N1", "L2"))
def n1_purpose_top10_by_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = default_rate_by(loans(spark, sf_dir), "purpose")
    # Top-10 report: the limit is the feature; unique tie-break on the key.
    top = g.orderBy(F.desc("total_loans"), "purpose").limit(10)
    return top.orderBy(F.desc("default_rate_pct"), "purpose")


# N2 --------------------------------------------------------------------------
N2_SQL = with_views(f"""
SELECT CAST(COUNT(*) AS BIGINT) AS total_loans,
       ROUND(100.0 * {_DEF_SQL} / COUNT(*), 2) AS default_rate_pct FROM loans""", "loans")


@register("n2_portfolio_default_rate", N2_SQL, ids=("N2",))
def n2_portfolio_default_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return default_rate_by(loans(spark, sf_dir))


# N3 --------------------------------------------------------------------------
N3_SQL = with_views(f"""
SELECT home_ownership, CAST(COUNT(*) AS BIGINT) AS total_loans,
       ROUND(100.0 * {_DEF_SQL} / COUNT(*), 2) AS default_rate_pct
FROM loans GROUP BY home_ownership ORDER BY total_loans DESC""", "loans")


@register("n3_home_ownership_default", N3_SQL, ids=("N3",))
def n3_home_ownership_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    return default_rate_by(loans(spark, sf_dir), "home_ownership").orderBy(F.desc("total_loans"), "home_ownership")


# N8 --------------------------------------------------------------------------
N8_SQL = with_views("""
SELECT loan_status, n, is_closed,
       ROUND(100.0 * n / SUM(n) OVER (), 2) AS pct_of_loans,
       ROUND(100.0 * SUM(n * is_closed) OVER () / SUM(n) OVER (), 2) AS closed_population_pct,
       ROUND(100.0 * SUM(n * is_default) OVER () / SUM(n * is_closed) OVER (), 2) AS default_rate_closed_pct
FROM (
  SELECT loan_status, CAST(COUNT(*) AS BIGINT) AS n,
         CASE WHEN loan_status IN ('Fully Paid','Charged Off','Default') THEN 1 ELSE 0 END AS is_closed,
         CASE WHEN loan_status IN ('Charged Off','Default') THEN 1 ELSE 0 END AS is_default
  FROM loans GROUP BY loan_status
) s""", "loans")


@register("n8_status_mix", N8_SQL, ids=("N8", "A17", "A39", "W4"))
def n8_status_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = loans(spark, sf_dir).groupBy("loan_status").agg(count_bigint().alias("n"))
    g = g.withColumn("is_closed", F.col("loan_status").isin(*CLOSED_LOAN_STATUSES).cast("int"))
    g = g.withColumn("_is_def", F.col("loan_status").isin(*DEFAULT_STATUSES).cast("int"))
    # Window over the aggregate: only one row per distinct status reaches this single partition.
    w = Window.partitionBy()
    total = F.sum("n").over(w)
    closed = F.sum(F.col("n") * F.col("is_closed")).over(w)
    dflt = F.sum(F.col("n") * F.col("_is_def")).over(w)
    return g.select(
        "loan_status", "n", "is_closed",
        pct_rate(F.col("n"), total, 2).alias("pct_of_loans"),
        pct_rate(closed, total, 2).alias("closed_population_pct"),
        pct_rate(dflt, closed, 2).alias("default_rate_closed_pct"),
    ).orderBy(F.desc("n"), "loan_status")


# N9 --------------------------------------------------------------------------
N9_SQL = with_views("""
SELECT sub_grade, n, min_rate, max_rate, rate_spread,
       CAST(p.mx - p.mn AS DOUBLE) AS portfolio_range,
       ROUND(100.0 * rate_spread / CAST(p.mx - p.mn AS DOUBLE), 2) AS spread_share_pct
FROM (
  SELECT sub_grade, CAST(COUNT(*) AS BIGINT) AS n,
         CAST(MIN(interest_rate) AS DOUBLE) AS min_rate, CAST(MAX(interest_rate) AS DOUBLE) AS max_rate,
         CAST(MAX(interest_rate) - MIN(interest_rate) AS DOUBLE) AS rate_spread
  FROM loans GROUP BY sub_grade
) s CROSS JOIN (SELECT MIN(interest_rate) AS mn, MAX(interest_rate) AS mx FROM loans) p""", "loans")


@register("n9_subgrade_rate_spread", N9_SQL, ids=("N9", "A26", "J2"))
def n9_subgrade_rate_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = loans(spark, sf_dir).select("sub_grade", "interest_rate")
    g = df.groupBy("sub_grade").agg(count_bigint().alias("n"), F.min("interest_rate").alias("_mn"),
                                   F.max("interest_rate").alias("_mx"))
    # one-row scalar aggregate, broadcast (size is one row by construction)
    p = df.agg(F.min("interest_rate").alias("_pmn"), F.max("interest_rate").alias("_pmx"))
    j = g.crossJoin(F.broadcast(p))
    spread = F.col("_mx") - F.col("_mn")
    prange = F.col("_pmx") - F.col("_pmn")
    return j.select(
        "sub_grade", "n",
        F.col("_mn").cast("double").alias("min_rate"), F.col("_mx").cast("double").alias("max_rate"),
        spread.cast("double").alias("rate_spread"),
        prange.cast("double").alias("portfolio_range"),
        F.round(F.try_divide(spread * 100, prange), 2).cast("double").alias("spread_share_pct"),
    ).orderBy("sub_grade")


# D2 --------------------------------------------------------------------------
D2_SQL = with_views(f"""
SELECT state, CAST(COUNT(*) AS BIGINT) AS total_loans, CAST({_DEF_SQL} AS BIGINT) AS defaults,
       ROUND(100.0 * {_DEF_SQL} / COUNT(*), 2) AS default_rate_pct
FROM loans GROUP BY state""", "loans")


@register("d2_default_rate_by_state", D2_SQL, ids=("D2",))
def d2_default_rate_by_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return default_rate_by(loans(spark, sf_dir), "state", with_defaults=True).select(
        "state", "total_loans", "defaults", "default_rate_pct")


# D3 --------------------------------------------------------------------------
DTI_BIN_WIDTH = 5
FICO_BIN_WIDTH = 20
D3_SQL = with_views(f"""
SELECT CAST(floor(dti / {DTI_BIN_WIDTH}) * {DTI_BIN_WIDTH} AS DOUBLE) AS dti_bin,
       CAST(floor(fico_range_low / {FICO_BIN_WIDTH}) * {FICO_BIN_WIDTH} AS BIGINT) AS fico_bin,
       loan_status, CAST(COUNT(*) AS BIGINT) AS n
FROM loans GROUP BY 1, 2, 3""", "loans")


@register("d3_fico_dti_outcome_bins", D3_SQL, ids=("D3", "A23"))
def d3_fico_dti_outcome_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = loans(spark, sf_dir)
    return df.groupBy(
        (F.floor(F.col("dti") / DTI_BIN_WIDTH) * DTI_BIN_WIDTH).cast("double").alias("dti_bin"),
        (F.floor(F.col("fico_range_low") / FICO_BIN_WIDTH) * FICO_BIN_WIDTH).cast("bigint").alias("fico_bin"),
        "loan_status",
    ).agg(count_bigint().alias("n"))


# D8 --------------------------------------------------------------------------
D8_SQL = with_views(f"""
SELECT purpose, CAST(SUM(loan_count) AS BIGINT) AS loan_count,
       ROUND(SUM(default_rate_pct * loan_count) / SUM(loan_count), 2) AS weighted_default_rate_pct
FROM ({V1_SQL_BODY}) v GROUP BY purpose""", "loans")


@register("d8_purpose_rate_volume", D8_SQL, ids=("D8", "A28"))
def d8_purpose_rate_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = credit_kpis(spark, sf_dir)
    return v.groupBy("purpose").agg(
        F.sum("loan_count").cast("bigint").alias("loan_count"),
        F.round(F.sum(F.col("default_rate_pct") * F.col("loan_count")) / F.sum("loan_count"), 2)
        .alias("weighted_default_rate_pct"),
    ).orderBy(F.desc("weighted_default_rate_pct"), "purpose")


def rate_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grade × purpose matrix of avg interest rate (A24 pivot at the presentation edge).

    The pivot values are the distinct purposes (a bounded category list) so the
    pivot does not need a second pass to discover them.
    """
    v = materialize(credit_kpis(spark, sf_dir))  # grade x purpose rows
    purposes = bounded_values(v, "purpose")
    return v.groupBy("grade").pivot("purpose", purposes).agg(F.first("avg_interest_rate")).orderBy("grade")


# the purposes are written out: one that is not listed shows as a schema difference
PURPOSES = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
D8M_SQL = with_views("SELECT grade, " + ", ".join(
    f"max(CASE WHEN purpose = '{p}' THEN avg_interest_rate END) AS \"{p}\"" for p in PURPOSES)
    + f" FROM ({V1_SQL_BODY}) v GROUP BY grade", "loans")


@register("d8_rate_matrix", D8M_SQL, ids=("D8", "A24"))
def d8_rate_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rate_matrix(spark, sf_dir)


# A12 ---------------------------------------------------------------------------
LOAN_NUMERIC_COLS = ["loan_amount", "funded_amount", "term_months", "interest_rate", "installment", "annual_income",
                     "dti", "delinq_2yrs", "fico_range_low", "fico_range_high", "open_accounts", "total_accounts",
                     "revol_util"]
A12_SQL = with_views("SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{a}' AS column_a, '{b}' AS column_b, ROUND(CORR(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)), 6) + 0.0 AS correlation "
    f"FROM loans" for a in LOAN_NUMERIC_COLS for b in LOAN_NUMERIC_COLS) + ") u", "loans")


def correlation_matrix(df: DataFrame, cols: list[str], digits: int = 6) -> DataFrame:
    """Pairwise-complete Pearson correlation of numeric columns, tidy, in two passes over the rows."""
    return column_correlations(df, cols).select(
        F.col("a").alias("column_a"), F.col("b").alias("column_b"), F.round("correlation", digits).alias("correlation"))


@register("a12_loan_correlation_matrix", A12_SQL, ids=("A12", "A25"))
def a12_loan_correlation_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return correlation_matrix(loans(spark, sf_dir), LOAN_NUMERIC_COLS)
