"""Profiling, sampling and table-level queries: A18-A23, L3, L4, L6, S11, D1."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.functions.risk import CLOSED_LOAN_STATUSES
from tallyspark.operators import profile as pf
from tallyspark.operators.market import PORTFOLIO_LABEL, market_risk_kpis
from tallyspark.plans.credit import credit_kpis
from tallyspark.plans.fraud import fraud_kpis
from tallyspark.plans.segments import customers_table, segment_summary
from tallyspark.sources.raw import LOAN_RAW_COLUMNS, RAW_LOANS_SQL, raw_loans, raw_transactions
from tallyspark.plans.cleaning_jobs import C2_EXTRA
from tallyspark.plans.registry import register
from tallyspark.sources.shaped import customer_aggregates, loans, stock_prices, transactions, with_views


def _h(x: str, salt: str = "") -> str:
    t = f"CAST({x} AS VARCHAR)" + (f" || '{salt}'" if salt else "")
    return f"CAST(('0x' || substr(md5({t}), 1, {pf.HASH_HEX_DIGITS})) AS BIGINT)"


# A18 -----------------------------------------------------------------------------
A18_SQL = with_views("SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS column, ROUND(COUNT(*) FILTER (WHERE \"{c}\" IS NULL) * 100.0 / COUNT(*), 4) AS missing_pct "
    f"FROM raw_loans" for c in LOAN_RAW_COLUMNS) + ") u WHERE missing_pct > 0", "loans", extra=RAW_LOANS_SQL)


@register("a18_missing_pct", A18_SQL, ids=("A18", "S1"))
def a18_missing_pct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pf.missing_pct(raw_loans(spark, sf_dir).select(*LOAN_RAW_COLUMNS))


# A19 -----------------------------------------------------------------------------
_TXN_RAW = ["step", "type", "amount", "nameOrig", "oldbalanceOrg", "newbalanceOrig", "nameDest", "oldbalanceDest",
            "newbalanceDest", "isFraud", "isFlaggedFraud"]


def _inv_sql(name: str, table: str, cols: list[str]) -> str:
    n = len(cols)
    return " UNION ALL ".join(
        f"SELECT '{name}' AS dataset, CAST(COUNT(*) AS BIGINT) AS n_rows, CAST({n} AS BIGINT) AS n_columns, "
        f"'{c}' AS column, 'string' AS dtype, "
        f"ROUND(COUNT(*) FILTER (WHERE \"{c}\" IS NULL) * 100.0 / COUNT(*), 4) AS missing_pct FROM {table}"
        for c in cols)


A19_SQL = with_views("SELECT * FROM (" + _inv_sql("loans_raw", "raw_loans", LOAN_RAW_COLUMNS) + " UNION ALL "
                     + _inv_sql("transactions_raw", "raw_txn", _TXN_RAW) + ") u",
                     "loans", "transactions", extra=RAW_LOANS_SQL + "," + C2_EXTRA.split(",\nc2_num AS")[0])


@register("a19_data_inventory", A19_SQL, ids=("A19", "S2", "S3"))
def a19_data_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pf.inventory({"loans_raw": raw_loans(spark, sf_dir).select(*LOAN_RAW_COLUMNS),
                         "transactions_raw": raw_transactions(spark, sf_dir)})


# A20 -----------------------------------------------------------------------------
_DESC_COLS = ["total_txn_count", "total_txn_value", "avg_txn_value"]
A20_SQL = with_views("SELECT * FROM (" + " UNION ALL ".join(f"""
SELECT '{c}' AS column, CAST(COUNT({c}) AS BIGINT) AS count, ROUND(AVG(CAST({c} AS DOUBLE)), 6) AS mean,
       ROUND(STDDEV_SAMP(CAST({c} AS DOUBLE)), 6) AS std, ROUND(MIN(CAST({c} AS DOUBLE)), 6) AS min,
       ROUND(quantile_cont(CAST({c} AS DOUBLE), 0.25), 6) AS p25, ROUND(quantile_cont(CAST({c} AS DOUBLE), 0.5), 6) AS p50,
       ROUND(quantile_cont(CAST({c} AS DOUBLE), 0.75), 6) AS p75, ROUND(MAX(CAST({c} AS DOUBLE)), 6) AS max
FROM customer_aggregates""" for c in _DESC_COLS) + ") u", "customer_aggregates")


@register("a20_describe_customers", A20_SQL, ids=("A20",))
def a20_describe_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pf.describe(customer_aggregates(spark, sf_dir), _DESC_COLS)


# A22 -----------------------------------------------------------------------------
A22_SQL = with_views("""
SELECT ROUND(quantile_cont(x, 0.5), 6) AS median, ROUND(AVG(x), 6) AS mean, ROUND(quantile_cont(x, 0.99), 6) AS p99,
       ROUND(MAX(x), 6) AS max, ROUND(COUNT(*) FILTER (WHERE x = 0) * 100.0 / COUNT(x), 6) AS zero_pct,
       ROUND(COUNT(*) FILTER (WHERE x = (SELECT MAX(CAST(amount AS DOUBLE)) FROM transactions)) * 100.0 / COUNT(x), 6) AS at_cap_pct
FROM (SELECT CAST(amount AS DOUBLE) AS x FROM transactions) t""", "transactions")


@register("a22_amount_summary", A22_SQL, ids=("A22", "A39"))
def a22_amount_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pf.summary_stats(transactions(spark, sf_dir), "amount")


# A23 -----------------------------------------------------------------------------
_BINS = 20


def _hist_sql(expr: str, where: str) -> str:
    return with_views(f"""
SELECT bin, ROUND(lo + bin * w, 10) AS bin_start, ROUND(lo + (bin + 1) * w, 10) AS bin_end, CAST(COUNT(*) AS BIGINT) AS n,
       ROUND(CASE WHEN w > 0 THEN COUNT(*) / (MAX(n_) * w) END, 10) AS density
FROM (SELECT x, lo, (hi - lo) / {_BINS} AS w, n_,
             CAST(CASE WHEN hi = lo THEN 0 ELSE LEAST(floor((x - lo) / ((hi - lo) / {_BINS})), {_BINS - 1}) END AS INTEGER) AS bin
      FROM (SELECT {expr} AS x FROM transactions WHERE {where}) s
      CROSS JOIN (SELECT MIN({expr}) AS lo, MAX({expr}) AS hi, COUNT(*) AS n_ FROM transactions WHERE {where}) m) b
GROUP BY bin, lo, w""", "transactions")


@register("a23_amount_histogram", _hist_sql("CAST(amount AS DOUBLE)", "amount IS NOT NULL"), ids=("A23",))
def a23_amount_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pf.histogram(transactions(spark, sf_dir), "amount", _BINS)


@register("a23_amount_log_histogram", _hist_sql("log10(CAST(amount AS DOUBLE))", "amount > 0"), ids=("A23",))
def a23_amount_log_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pf.histogram(transactions(spark, sf_dir), "amount", _BINS, log_scale=True)


# L4 ------------------------------------------------------------------------------
L4_PCT = 2.0
L4_SQL = with_views(f"""
SELECT loan_id, grade, CAST(interest_rate AS DOUBLE) AS interest_rate FROM loans
WHERE {_h('loan_id')} < {int((L4_PCT / 100.0) * (16 ** pf.HASH_HEX_DIGITS))}""", "loans")


@register("l4_block_sample", L4_SQL, ids=("L4",))
def l4_block_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = pf.block_sample(loans(spark, sf_dir), "loan_id", L4_PCT)
    return s.select("loan_id", "grade", F.col("interest_rate").cast("double").alias("interest_rate"))


# L3 ------------------------------------------------------------------------------
L3_N = 300000
L3_SQL = with_views(f"""
SELECT loan_id, loan_status, CAST(loan_amount AS DOUBLE) AS loan_amount FROM loans
WHERE loan_status IN ('Fully Paid', 'Charged Off', 'Default')
ORDER BY md5(CAST(loan_id AS VARCHAR)) LIMIT {L3_N}""", "loans")


@register("l3_md5_sample", L3_SQL, ids=("L3", "P15", "P22", "F5"))
def l3_md5_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    closed = loans(spark, sf_dir).where(F.col("loan_status").isin(*CLOSED_LOAN_STATUSES))
    s = pf.hash_top_n(closed, "loan_id", L3_N)
    return s.select("loan_id", "loan_status", F.col("loan_amount").cast("double").alias("loan_amount"))


# L6 ------------------------------------------------------------------------------
L6_SQL = with_views(f"""
SELECT loan_id, y, CASE WHEN rn <= round(0.2 * n_cls) THEN 'test' ELSE 'train' END AS split
FROM (SELECT loan_id, y, row_number() OVER (PARTITION BY y ORDER BY {_h('loan_id', '42')}) AS rn,
             count(*) OVER (PARTITION BY y) AS n_cls
      FROM (SELECT loan_id, CASE WHEN loan_status IN ('Charged Off', 'Default') THEN 1 ELSE 0 END AS y
            FROM loans WHERE loan_status IN ('Fully Paid', 'Charged Off', 'Default')) c) r""", "loans")


@register("l6_stratified_split", L6_SQL, ids=("L6",))
def l6_stratified_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    closed = loans(spark, sf_dir).where(F.col("loan_status").isin(*CLOSED_LOAN_STATUSES)).select(
        "loan_id", F.col("loan_status").isin("Charged Off", "Default").cast("int").alias("y"))
    return pf.stratified_split(closed, "loan_id", "y").select("loan_id", "y", "split")


# S11 -----------------------------------------------------------------------------
S11_SQL = with_views("""
SELECT 'loans' AS table_name, CAST(COUNT(*) AS BIGINT) AS n_rows FROM loans
UNION ALL SELECT 'transactions', CAST(COUNT(*) AS BIGINT) FROM transactions
UNION ALL SELECT 'stock_prices', CAST(COUNT(*) AS BIGINT) FROM stock_prices
UNION ALL SELECT 'customers', CAST(COUNT(*) AS BIGINT) FROM customer_aggregates""",
                     "loans", "transactions", "stock_prices", "customer_aggregates")


@register("s11_row_counts", S11_SQL, ids=("S11",))
def s11_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row count of every table as one union of aggregates (one job)."""
    parts = [(n, f(spark, sf_dir)) for n, f in (("loans", loans), ("transactions", transactions),
                                                ("stock_prices", stock_prices), ("customers", customer_aggregates))]
    out = None
    for n, df in parts:
        c = df.agg(F.count(F.lit(1)).cast("bigint").alias("n_rows")).select(F.lit(n).alias("table_name"), "n_rows")
        out = c if out is None else out.unionByName(c)
    return out


# D1 ------------------------------------------------------------------------------
def _d1_sql() -> str:
    from tallyspark.plans.credit import V1_SQL_BODY
    from tallyspark.plans.fraud import V2_BODY
    from tallyspark.plans.market import V3_BODY, _STATS_CTE
    from tallyspark.plans.segments import CUSTOMERS_SQL, V5_BODY
    body = f"""
SELECT v1.total_loans, v1.overall_default_rate_pct, v2.total_txns, v2.fraud_rate_pct,
       v3.portfolio_sharpe, v3.portfolio_volatility_pct, v5.total_customers, v5.top_segment
FROM (SELECT CAST(SUM(loan_count) AS BIGINT) AS total_loans,
             ROUND(SUM(default_rate_pct * loan_count) / SUM(loan_count), 2) AS overall_default_rate_pct
      FROM ({V1_SQL_BODY}) a) v1
CROSS JOIN (SELECT CAST(SUM(txn_count) AS BIGINT) AS total_txns,
                   ROUND(SUM(fraud_count) * 100.0 / SUM(txn_count), 4) AS fraud_rate_pct FROM ({V2_BODY}) b) v2
CROSS JOIN (SELECT sharpe_ratio AS portfolio_sharpe, annualized_volatility_pct AS portfolio_volatility_pct
            FROM ({V3_BODY}) c WHERE ticker = 'PORTFOLIO (equal-wt)') v3
CROSS JOIN (SELECT CAST(SUM(n_customers) AS BIGINT) AS total_customers,
                   arg_max(segment, struct_pack(n := n_customers, s := segment)) AS top_segment
            FROM ({V5_BODY}) d) v5"""
    return with_views(body, "loans", "transactions", "stock_prices", "customer_aggregates",
                      extra=_STATS_CTE + "," + CUSTOMERS_SQL)


@register("d1_overview_cards", _d1_sql(), ids=("D1", "A28"))
def d1_overview_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overview KPI cards from the KPI tables (all inputs are already aggregates)."""
    v1 = credit_kpis(spark, sf_dir).agg(
        F.sum("loan_count").cast("bigint").alias("total_loans"),
        F.round(F.sum(F.col("default_rate_pct") * F.col("loan_count")) / F.sum("loan_count"), 2)
        .alias("overall_default_rate_pct"))
    v2 = fraud_kpis(spark, sf_dir).agg(
        F.sum("txn_count").cast("bigint").alias("total_txns"),
        F.round(F.sum("fraud_count") * 100.0 / F.sum("txn_count"), 4).alias("fraud_rate_pct"))
    v3 = market_risk_kpis(stock_prices(spark, sf_dir)).where(F.col("ticker") == PORTFOLIO_LABEL).select(
        F.col("sharpe_ratio").alias("portfolio_sharpe"), F.col("annualized_volatility_pct").alias("portfolio_volatility_pct"))
    v5 = segment_summary(customers_table(spark, sf_dir), customer_aggregates(spark, sf_dir)).agg(
        F.sum("n_customers").cast("bigint").alias("total_customers"),
        F.max(F.struct("n_customers", "segment")).getField("segment").alias("top_segment"))
    return v1.crossJoin(v2).crossJoin(v3).crossJoin(v5)
