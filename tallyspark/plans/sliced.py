"""Queries that give the optional parameters a value: ticker and date slicers (P16, D7),
portfolio weights (T2), excluded pairs (A25), limits that bind (L2, L3, D9), risk-score
histograms (D6)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.functions.exact import count_bigint
from tallyspark.functions.risk import CLOSED_LOAN_STATUSES
from tallyspark.operators import market as mk
from tallyspark.operators import profile as pf
from tallyspark.operators import segments as sg
from tallyspark.plans.market import D7_SQL, V4_BODY, _sql, price_history, prices_once
from tallyspark.plans.registry import register
from tallyspark.plans.segments import _csql, customers_table
from tallyspark.session import materialize
from tallyspark.sources.shaped import customer_aggregates, loans, with_views

SLICE = {"tickers": ["LARGE", "SMALL"], "start": "1995-01-01", "end": "1996-06-30"}
WEIGHTS = {"ECONOMY": 1.0, "LARGE": 2.0, "MEDIUM": 1.0, "PROMO": 0.5, "SMALL": 3.0, "STANDARD": 0.5}
EXCLUDED = [("ECONOMY", "LARGE"), ("STANDARD", "SMALL")]
SAMPLE = 200  # rows of the binding samples

D7S_SQL = (f"SELECT * FROM ({D7_SQL}) h WHERE ticker IN ('LARGE', 'SMALL') "
           f"AND trade_date BETWEEN DATE '{SLICE['start']}' AND DATE '{SLICE['end']}'")


@register("d7_price_history_slice", D7S_SQL, ids=("D7", "P16", "P17"))
def d7_price_history_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return price_history(spark, sf_dir, **SLICE)


_WEIGHT_SQL = "CASE ticker " + " ".join(f"WHEN '{t}' THEN {w}" for t, w in WEIGHTS.items()) + " END"
T2W_SQL = _sql(f"""
SELECT trade_date, ROUND(SUM(w * daily_return) / {sum(WEIGHTS.values())}, 8) + 0.0 AS daily_return
FROM (SELECT trade_date, daily_return, {_WEIGHT_SQL} AS w FROM stock_prices WHERE daily_return IS NOT NULL) r
GROUP BY trade_date HAVING COUNT(*) = {len(WEIGHTS)}""")


@register("t2_weighted_portfolio", T2W_SQL, ids=("T2",))
def t2_weighted_portfolio(spark: SparkSession, sf_dir: str) -> DataFrame:
    returns = mk.portfolio_returns(prices_once(spark, sf_dir), WEIGHTS)
    return returns.select("trade_date", (F.round("daily_return", 8) + F.lit(0.0)).alias("daily_return"))


A25X_SQL = _sql(f"""
SELECT *, CAST(row_number() OVER (ORDER BY abs(correlation) DESC, ticker_a, ticker_b) AS INTEGER) AS rank
FROM ({V4_BODY}) v WHERE ticker_a < ticker_b AND NOT (ticker_a = 'ECONOMY' AND ticker_b = 'LARGE')
  AND NOT (ticker_a = 'SMALL' AND ticker_b = 'STANDARD')""")


@register("a25_pairs_with_exclusions", A25X_SQL, ids=("A25",))
def a25_pairs_with_exclusions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mk.ranked_pairs(mk.correlation_long(prices_once(spark, sf_dir)), EXCLUDED)


L3S_SQL = with_views(f"""
SELECT loan_id, loan_status FROM loans WHERE loan_status IN ('Fully Paid', 'Charged Off', 'Default')
ORDER BY md5(CAST(loan_id AS VARCHAR)) LIMIT {SAMPLE}""", "loans")


@register("l3_md5_sample_small", L3S_SQL, ids=("L3",))
def l3_md5_sample_small(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same sampling operator with a limit below the table's size (the limit is the feature)."""
    closed = loans(spark, sf_dir).where(F.col("loan_status").isin(*CLOSED_LOAN_STATUSES)).select("loan_id", "loan_status")
    return pf.hash_top_n(closed, "loan_id", SAMPLE)


D9S_SQL = _csql(f"""
SELECT customer_id, CAST(total_txn_count AS BIGINT) AS frequency, segment FROM cust_seg
ORDER BY md5(customer_id || '42'), customer_id LIMIT {SAMPLE}""")


@register("d9_bubble_sample_small", D9S_SQL, ids=("D9", "L5", "L8"))
def d9_bubble_sample_small(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = sg.rule_segment(materialize(customer_aggregates(spark, sf_dir)))
    out = c.select("customer_id", F.col("total_txn_count").cast("bigint").alias("frequency"), "segment")
    return sg.hash_sample(out, "customer_id", SAMPLE)


N1S_SQL = with_views("""
SELECT purpose, COUNT(*) AS total_loans FROM loans GROUP BY purpose ORDER BY total_loans DESC, purpose LIMIT 3""", "loans")


@register("l2_top3_purposes", N1S_SQL, ids=("L2", "N1"))
def l2_top3_purposes(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = loans(spark, sf_dir).groupBy("purpose").agg(count_bigint().alias("total_loans"))
    return g.orderBy(F.desc("total_loans"), "purpose").limit(3)


D6R_SQL = _csql("""
SELECT segment, bin, ROUND(bin * 5.0, 1) AS bin_start, COUNT(*) AS n
FROM (SELECT segment, CAST(LEAST(FLOOR(risk_score / 5), 19) AS INTEGER) AS bin FROM customers) b GROUP BY segment, bin""")


@register("d6_risk_score_histogram", D6R_SQL, ids=("D6", "A23"))
def d6_risk_score_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Risk scores (0 to 100) in twenty bins of five, by segment."""
    bins = F.least(F.floor(F.col("risk_score") / 5), F.lit(19)).cast("int")
    g = customers_table(spark, sf_dir).groupBy("segment", bins.alias("bin")).agg(count_bigint().alias("n"))
    return g.select("segment", "bin", F.round(F.col("bin") * F.lit(5.0), 1).alias("bin_start"), "n")
