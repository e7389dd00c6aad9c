"""Table-level jobs: S5/S7/S13 snapshot loads, S9 typed landing, S10 surrogate keys, A2 distinct counts."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyspark.operators.cleaning import clean_stock_prices
from tallyspark.plans.cleaning_jobs import C3_EXTRA
from tallyspark.plans.registry import register
from tallyspark.session import scratch_path
from tallyspark.sources.raw import raw_prices
from tallyspark.sources.shaped import customer_aggregates, loans, stock_prices, transactions, with_views
from tallyspark.sources.sinks import write_snapshot

# ---- fixed values: declared price table types (typed landing) -------------------
PRICE_TYPES = {"open_price": "decimal(12,2)", "high_price": "decimal(12,2)", "low_price": "decimal(12,2)",
               "close_price": "decimal(12,2)", "adj_close": "decimal(12,2)", "volume": "bigint"}
TICKER_MAX_LEN = 15


def typed_landing(df: DataFrame, types: dict[str, str], lengths: dict[str, int]) -> tuple[DataFrame, DataFrame]:
    """Cast to the declared types; rows where a non-NULL value does not fit (overflow,
    unparseable, too long) go to the reject output instead of failing the load."""
    bad = F.lit(False)
    cast = {}
    for c, t in types.items():
        cast[c] = F.col(c).try_cast(t)
        bad = bad | (F.col(c).isNotNull() & cast[c].isNull())
    for c, n in lengths.items():
        bad = bad | (F.length(c) > n)
    flagged = df.withColumn("_bad", bad)
    good = flagged.where(~F.col("_bad")).withColumns(cast).drop("_bad")
    return good, flagged.where(F.col("_bad")).drop("_bad")


S9_SQL = with_views("""
SELECT ticker, trade_date, CAST(TRY_CAST(open_price AS DECIMAL(12,2)) AS DOUBLE) AS open_price,
       CAST(TRY_CAST(close_price AS DECIMAL(12,2)) AS DOUBLE) AS close_price, volume
FROM (SELECT *, row_number() OVER (PARTITION BY ticker, trade_date ORDER BY seq) AS rn_ FROM c3_parsed
      WHERE ticker IS NOT NULL AND trade_date IS NOT NULL AND close_price IS NOT NULL) x
WHERE rn_ = 1 AND length(ticker) <= 15""", "stock_prices", extra=C3_EXTRA)


@register("s9_typed_price_landing", S9_SQL, ids=("S9", "P27"))
def s9_typed_price_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, _ = typed_landing(clean_stock_prices(raw_prices(spark, sf_dir)), PRICE_TYPES, {"ticker": TICKER_MAX_LEN})
    return good.select("ticker", "trade_date", F.col("open_price").cast("double"), F.col("close_price").cast("double"),
                       "volume")


def surrogate_keys(df: DataFrame, group: str, order: str, name: str) -> DataFrame:
    """Consecutive ids in (group, order) order without a global sort.

    Rows are numbered inside each group (one series per task) and shifted by the
    row count of all preceding groups (a table with one row per group).
    """
    sizes = df.groupBy(group).agg(F.count(F.lit(1)).alias("_n"))
    offsets = sizes.select(group, F.coalesce(F.sum("_n").over(
        Window.orderBy(group).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    local = df.withColumn("_rn", F.row_number().over(Window.partitionBy(group).orderBy(order)))
    return local.join(F.broadcast(offsets), group).withColumn(name, (F.col("_off") + F.col("_rn")).cast("bigint")) \
        .drop("_off", "_rn")


S10_SQL = with_views("""
SELECT CAST(row_number() OVER (ORDER BY ticker, trade_date) AS BIGINT) AS price_id, ticker, trade_date FROM stock_prices""",
                     "stock_prices")


@register("s10_price_ids", S10_SQL, ids=("S10",))
def s10_price_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = stock_prices(spark, sf_dir).select("ticker", "trade_date")
    return surrogate_keys(p, "ticker", "trade_date", "price_id").select("price_id", "ticker", "trade_date")


S7_SQL = with_views("""
SELECT 'loans' AS table_name, CAST(COUNT(*) AS BIGINT) AS rows_written FROM loans
UNION ALL SELECT 'transactions', CAST(COUNT(*) AS BIGINT) FROM transactions
UNION ALL SELECT 'stock_prices', CAST(COUNT(*) AS BIGINT) FROM stock_prices
UNION ALL SELECT 'customers', CAST(COUNT(*) AS BIGINT) FROM customer_aggregates""",
                    "loans", "transactions", "stock_prices", "customer_aggregates")


@register("s7_full_refresh_load", S7_SQL, ids=("S5", "S7", "S13", "S18"))
def s7_full_refresh_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write every table as a new snapshot version in the shared folder; report rows written.

    Loans are partitioned by issue year (coarse pruning key for vintage queries).
    """
    base = scratch_path(spark, f"tables-{uuid.uuid4().hex}")
    L = loans(spark, sf_dir).withColumn("issue_year", F.year("issue_date"))
    counts = [("loans", write_snapshot(L, f"{base}/loans", partition_by=["issue_year"])),
              ("transactions", write_snapshot(transactions(spark, sf_dir), f"{base}/transactions")),
              ("stock_prices", write_snapshot(stock_prices(spark, sf_dir), f"{base}/stock_prices")),
              ("customers", write_snapshot(customer_aggregates(spark, sf_dir), f"{base}/customers"))]
    return spark.createDataFrame(counts, "table_name string, rows_written long")


A2_SQL = with_views("""
SELECT CAST(COUNT(DISTINCT ticker) AS BIGINT) AS n_tickers, CAST(COUNT(DISTINCT trade_date) AS BIGINT) AS n_dates,
       CAST((SELECT COUNT(DISTINCT sender_id) FROM transactions) AS BIGINT) AS n_senders FROM stock_prices""",
                    "stock_prices", "transactions")


@register("a2_distinct_counts", A2_SQL, ids=("A2",))
def a2_distinct_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = stock_prices(spark, sf_dir).agg(F.countDistinct("ticker").alias("n_tickers"),
                                        F.countDistinct("trade_date").alias("n_dates"))
    t = transactions(spark, sf_dir).agg(F.countDistinct("sender_id").alias("n_senders"))
    return p.crossJoin(t).select(*[F.col(c).cast("bigint") for c in ("n_tickers", "n_dates", "n_senders")])


S8_SQL = with_views("""
SELECT ticker, trade_date, ROUND(adj_close, 6) AS adj_close,
       round_even(adj_close / last_value(adj_close IGNORE NULLS) OVER (PARTITION BY ticker ORDER BY trade_date
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 1, 5) + 0.0 AS daily_return
FROM (SELECT *, row_number() OVER (PARTITION BY ticker, trade_date ORDER BY seq) AS rn_ FROM c3_parsed
      WHERE ticker IS NOT NULL AND trade_date IS NOT NULL AND close_price IS NOT NULL) x
WHERE rn_ = 1""", "stock_prices", extra=C3_EXTRA)


@register("s8_price_load_returns", S8_SQL, ids=("S8", "W2", "S6"))
def s8_price_load_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price load: cleaned raw prices with per-ticker daily returns (gap-aware)."""
    from tallyspark.operators.market import daily_returns

    from tallyspark.sources.raw import read_or_clean

    # A cleaned Parquet copy is used when present; this run has none, so the raw file is cleaned
    cleaned = read_or_clean(spark, scratch_path(spark, f"prices-cleaned-{uuid.uuid4().hex}"),
                            lambda: raw_prices(spark, sf_dir), clean_stock_prices)
    p = daily_returns(cleaned)
    return p.select("ticker", "trade_date", F.round("adj_close", 6).alias("adj_close"), "daily_return")
