"""Forecast queries: W6-W8, T6-T9 over every ticker's adj_close and the portfolio index."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.operators import forecast as fc
from tallyspark.operators.market import portfolio_price_index
from tallyspark.plans.registry import register
from tallyspark.plans.market import _STATS_CTE
from tallyspark.session import materialize
from tallyspark.sources.shaped import stock_prices, with_views

PORTFOLIO_SERIES = "portfolio"


def all_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T8 inputs: (series, trade_date, value) for every ticker plus the portfolio index."""
    p = materialize(stock_prices(spark, sf_dir))
    tick = p.select(F.col("ticker").alias("series"), "trade_date", F.col("adj_close").cast("double").alias("value"))
    port = portfolio_price_index(p).select(F.lit(PORTFOLIO_SERIES).alias("series"), "trade_date",
                                           F.col("index_value").alias("value"))
    return tick.unionByName(port)


_SERIES_SQL = """
series_all AS (
  SELECT ticker AS series, trade_date, CAST(adj_close AS DOUBLE) AS value FROM stock_prices
  UNION ALL
  SELECT 'portfolio', trade_date, ROUND(index_value, 6) FROM (
    SELECT trade_date, PRODUCT(1 + mean_return) OVER (ORDER BY trade_date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) * 100.0 AS index_value
    FROM full_days
    UNION ALL
    SELECT CAST(d - (CASE dayofweek(d) WHEN 1 THEN 3 WHEN 0 THEN 2 ELSE 1 END) * INTERVAL '1 day' AS DATE), 100.0
    FROM (SELECT MIN(trade_date) AS d FROM full_days) f) u
),
series_split AS (
  SELECT *, CASE WHEN n_ <= 60 THEN 'too_short' WHEN obs > n_ - 60 THEN 'holdout' ELSE 'train' END AS split FROM (
    SELECT series, trade_date, value, row_number() OVER (PARTITION BY series ORDER BY trade_date) AS obs,
           count(*) OVER (PARTITION BY series) AS n_
    FROM series_all WHERE value IS NOT NULL) s
)"""


W8_SQL = with_views("SELECT series, trade_date, value, CAST(obs AS INTEGER) AS obs, split FROM series_split",
                    "stock_prices", extra=_STATS_CTE + "," + _SERIES_SQL)


def _split(spark, sf_dir):
    s = all_series(spark, sf_dir)
    s = s.withColumn("value", F.round("value", 6))
    return fc.holdout_split(s)


@register("w8_holdout_split", W8_SQL, ids=("W8", "T1", "T8", "W5"))
def w8_holdout_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _split(spark, sf_dir).select("series", "trade_date", "value", F.col("obs").cast("int"), "split")


W8_REJECTED_SQL = with_views("""
SELECT series, COUNT(*) AS n_obs, 'not longer than the holdout' AS reason
FROM series_split WHERE split = 'too_short' GROUP BY series""", "stock_prices", extra=_STATS_CTE + "," + _SERIES_SQL)


@register("w8_rejected_series", W8_REJECTED_SQL, ids=("W8", "T8"))
def w8_rejected_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fc.rejected_series(_split(spark, sf_dir))


T7_SQL = with_views("""
SELECT series, model, ROUND(SQRT(AVG((actual - f) * (actual - f))), 6) AS rmse,
       ROUND(AVG(ABS((actual - f) / actual)) * 100, 6) AS mape_pct,
       CASE WHEN COUNT(f) = 0 THEN 'failed' ELSE 'ok' END AS status
FROM (
  SELECT h.series, h.value AS actual, 'naive_last_value' AS model, l.v AS f FROM series_split h
  JOIN (SELECT series, arg_max(value, obs) AS v FROM series_split WHERE split = 'train' GROUP BY series) l
    ON h.series = l.series WHERE h.split = 'holdout'
  UNION ALL
  SELECT series, value, 'naive_seasonal', f FROM (
    SELECT *, lag(value, 5) OVER (PARTITION BY series ORDER BY obs) AS f FROM series_split) s WHERE split = 'holdout'
) x GROUP BY series, model""", "stock_prices", extra=_STATS_CTE + "," + _SERIES_SQL)


@register("t7_naive_forecast_eval", T7_SQL, ids=("T7", "W6", "W7", "F6"))
def t7_naive_forecast_eval(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = fc.naive_forecasts(_split(spark, sf_dir))
    return fc.evaluation(fc.to_long(f, ["naive_last_value", "naive_seasonal"]))


def forecast_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = materialize(_split(spark, sf_dir))
    orders = fc.best_orders(fc.arima_orders(split))
    ar = fc.arima_forecasts(split, orders)
    naive = fc.naive_forecasts(split)
    return naive.join(ar, ["series", "trade_date"], "left")


@register("t6_arima_orders", None, ids=("T6",))
def t6_arima_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = materialize(_split(spark, sf_dir))
    return fc.best_orders(fc.arima_orders(split))


@register("t8_forecast_evaluation", None, ids=("T8", "T7", "T6"))
def t8_forecast_evaluation(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = materialize(forecast_table(spark, sf_dir))
    return fc.evaluation(fc.to_long(f, ["arima", "naive_last_value", "naive_seasonal"]))


@register("t9_model_vs_baseline", None, ids=("T9", "A24"))
def t9_model_vs_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per baseline: on how many series ARIMA has the lower MAPE, and the largest MAPE gap."""
    ev = t8_forecast_evaluation(spark, sf_dir)
    w = ev.groupBy("series").pivot("model", ["arima", "naive_last_value", "naive_seasonal"]).agg(F.first("mape_pct"))
    out = None
    for base in ("naive_last_value", "naive_seasonal"):
        r = w.agg(F.count_if(F.col("arima") < F.col(base)).cast("bigint").alias("arima_wins"),
                  F.count(F.col("arima") + F.col(base)).cast("bigint").alias("n_series"),  # both forecast
                  F.round(F.max(F.abs(F.col("arima") - F.col(base))), 6).alias("max_mape_gap")) \
            .withColumn("baseline", F.lit(base))
        out = r if out is None else out.unionByName(r)
    return out
