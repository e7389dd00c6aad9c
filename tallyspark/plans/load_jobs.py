"""Load path: cleaned sets written and counted (C4, S5), typed landing of every table with
rejects (S9), surrogate keys for transactions (S10), write-backs with row counts (S15, S17),
the file choices S3 and S6."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.functions.risk import rule_flag
from tallyspark.operators import segments as sg
from tallyspark.operators.cleaning import clean_loans, clean_stock_prices, clean_transactions
from tallyspark.operators.profile import bounded_values
from tallyspark.operators.ranking import cumulative_before
from tallyspark.plans.cleaning_jobs import C1_EXTRA, C1_SQL, C2_SQL, C3_SQL
from tallyspark.plans.registry import register
from tallyspark.plans.segments import _csql
from tallyspark.plans.tables import TICKER_MAX_LEN, typed_landing
from tallyspark.session import materialize, scratch_path, side_by_side
from tallyspark.sources.buckets import BucketTable
from tallyspark.sources.raw import (
    LOAN_RAW_COLUMNS, existing_csv, raw_loans, raw_prices, raw_transactions, read_csv_strings, read_or_clean, read_tagged,
)
from tallyspark.sources.shaped import customer_aggregates, price_bars, transactions, with_views
from tallyspark.sources.sinks import write_snapshot

# ---- fixed values: declared column types and text lengths of the four tables ----------
LANDING = {
    "loans": ({"loan_amount": "decimal(12,2)", "funded_amount": "decimal(12,2)", "interest_rate": "decimal(5,2)",
               "installment": "decimal(10,2)", "annual_income": "decimal(14,2)", "dti": "decimal(6,2)"},
              {"grade": 1, "sub_grade": 2, "loan_status": 30, "state": 2}),
    "transactions": ({"amount": "decimal(14,2)", "sender_bal_before": "decimal(14,2)", "sender_bal_after": "decimal(14,2)"},
                     {"txn_type": 20, "sender_id": 20, "receiver_id": 20}),
    "stock_prices": ({"open_price": "decimal(12,2)", "close_price": "decimal(12,2)", "adj_close": "decimal(12,2)"},
                     {"ticker": TICKER_MAX_LEN}),
    "customers": ({"total_txn_value": "decimal(16,2)", "avg_txn_value": "decimal(14,2)"}, {"customer_id": 20, "segment": 20}),
}


_CLEANED = {"loans": lambda spark, sf_dir: clean_loans(raw_loans(spark, sf_dir)),
            "transactions": lambda spark, sf_dir: clean_transactions(raw_transactions(spark, sf_dir)),
            "stock_prices": lambda spark, sf_dir: clean_stock_prices(raw_prices(spark, sf_dir))}


def _part(sql: str) -> str:
    """A whole oracle query as a sub-query."""
    return f"({sql})"


C4_SQL = f"""
SELECT 'loans' AS dataset, COUNT(*) AS n_rows FROM {_part(C1_SQL)} a
UNION ALL SELECT 'transactions', COUNT(*) FROM {_part(C2_SQL)} b
UNION ALL SELECT 'stock_prices', COUNT(*) FROM {_part(C3_SQL)} c"""


@register("c4_clean_all", C4_SQL, ids=("C4", "S5"))
def c4_clean_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The full cleaning run: three sets cleaned, written as Parquet snapshots and counted."""
    base = scratch_path(spark, f"cleaned-{uuid.uuid4().hex}")
    counts = side_by_side(lambda name: (name, write_snapshot(_CLEANED[name](spark, sf_dir), f"{base}/{name}")), _CLEANED)
    return spark.createDataFrame(counts, "dataset string, n_rows long")


def _fits_sql(table: str, source: str) -> str:
    types, lengths = LANDING[table]
    bad = [f"({c} IS NOT NULL AND TRY_CAST({c} AS {t.upper()}) IS NULL)" for c, t in types.items()]
    bad += [f"coalesce(length({c}) > {n}, false)" for c, n in lengths.items()]
    return (f"SELECT '{table}' AS table_name, COUNT(*) FILTER (WHERE NOT bad) AS n_landed, COUNT(*) FILTER (WHERE bad) AS n_rejected "
            f"FROM (SELECT {' OR '.join(bad)} AS bad FROM {source} s) r")


S9_ALL_SQL = " UNION ALL ".join([
    _fits_sql("loans", _part(C1_SQL)), _fits_sql("transactions", _part(C2_SQL)), _fits_sql("stock_prices", _part(C3_SQL)),
    _fits_sql("customers", _part(_csql("SELECT customer_id, segment, total_txn_value, avg_txn_value FROM cust_seg")))])


@register("s9_landing_all_tables", S9_ALL_SQL, ids=("S9",))
def s9_landing_all_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every table lands in its declared types and lengths; rows that do not fit are written
    to a reject table next to it, and both are counted."""
    base = scratch_path(spark, f"landing-{uuid.uuid4().hex}")
    tables = _CLEANED | {"customers": lambda spark, sf_dir: sg.rule_segment(materialize(customer_aggregates(spark, sf_dir)))}

    def land(name: str) -> tuple[str, int, int]:
        good, rejected = typed_landing(materialize(tables[name](spark, sf_dir)), *LANDING[name])
        return name, write_snapshot(good, f"{base}/{name}"), write_snapshot(rejected, f"{base}/{name}_rejected")

    counts = side_by_side(land, LANDING)  # no table waits for another
    return spark.createDataFrame(counts, "table_name string, n_landed long, n_rejected long")


S10T_SQL = with_views("SELECT row_number() OVER (ORDER BY txn_id) AS row_id, txn_id, txn_type FROM transactions", "transactions")


@register("s10_transaction_ids", S10T_SQL, ids=("S10",))
def s10_transaction_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Consecutive ids in key order: numbered within key ranges and shifted by what lies
    before each range, so no task sees more than a range."""
    t = transactions(spark, sf_dir).select("txn_id", "txn_type", F.lit(1).cast("long").alias("one"))
    numbered = cumulative_before(t, "txn_id", ["one"])
    return numbered.select((F.col("one_before") + 1).alias("row_id"), "txn_id", "txn_type")


S15_SQL = with_views("""
SELECT COUNT(*) AS n_rows, COUNT(*) AS n_updated, CAST(SUM(is_flagged_rule) AS BIGINT) AS n_flagged FROM scored_transactions""",
                     "transactions")


@register("s15_rule_flag_writeback", S15_SQL, ids=("S15", "J3"))
def s15_rule_flag_writeback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rule flag is set on every row of the stored table; the new version is what comes back."""
    table = BucketTable(spark, scratch_path(spark, f"transactions-{uuid.uuid4().hex}"))
    table.create(transactions(spark, sf_dir), ["txn_id"])
    updated = table.derive("is_flagged_rule", rule_flag())
    return table.read().agg(F.count(F.lit(1)).alias("n_rows"), F.lit(updated).cast("long").alias("n_updated"),
                            F.sum("is_flagged_rule").cast("long").alias("n_flagged"))


S16U_SQL = with_views("""
SELECT COUNT(*) AS n_rows, COUNT(*) FILTER (WHERE txn_id % 7 = 0 AND txn_id % 70 <> 0) AS n_updated,
       COUNT(*) FILTER (WHERE txn_id % 77 = 0) AS n_unmatched, COUNT(*) FILTER (WHERE txn_id % 70 = 0) AS n_rejected_keys,
       2 * COUNT(*) FILTER (WHERE txn_id % 70 = 0) AS n_rejected_rows,
       CAST(SUM(CASE WHEN txn_id % 7 = 0 AND txn_id % 70 <> 0 THEN step END) AS BIGINT) AS total_score
FROM transactions WHERE txn_id > 0""", "transactions")


@register("s16_staged_update_with_rejects", S16U_SQL, ids=("S16", "S14", "J3"))
def s16_staged_update_with_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores staged for every seventh transaction, some of them twice and some for unknown ids: the
    stored table gets a new column, ids staged twice go to the reject table, unknown ids are counted."""
    t = transactions(spark, sf_dir).where("txn_id > 0")
    table = BucketTable(spark, scratch_path(spark, f"transactions-{uuid.uuid4().hex}"))
    table.create(t, ["txn_id"])
    scores = t.where("txn_id % 7 = 0").select("txn_id", F.col("step").cast("long").alias("score"))
    staged = scores.unionByName(scores.where("txn_id % 70 = 0").withColumn("score", F.col("score") + 1)).unionByName(
        t.where("txn_id % 77 = 0").select((-F.col("txn_id")).alias("txn_id"), F.lit(0).cast("long").alias("score")))
    done = table.update(staged, ["score"])
    return table.read().agg(
        F.count(F.lit(1)).alias("n_rows"), F.lit(done.updated).cast("long").alias("n_updated"),
        F.lit(done.unmatched).cast("long").alias("n_unmatched"), F.lit(done.rejected_keys).cast("long").alias("n_rejected_keys"),
        F.lit(done.rejected_rows).cast("long").alias("n_rejected_rows"), F.sum("score").cast("long").alias("total_score"))


S17_SQL = _csql("SELECT COUNT(*) AS n_rows, COUNT(risk_score) AS n_updated, CAST(SUM(risk_score) AS DOUBLE) AS total_risk FROM customers")


@register("s17_risk_score_writeback", S17_SQL, ids=("S17", "J3"))
def s17_risk_score_writeback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Risk scores come from the stored customer table and are set in it by key; the new version comes back."""
    table = BucketTable(spark, scratch_path(spark, f"customers-{uuid.uuid4().hex}"))
    table.create(sg.rule_segment(materialize(customer_aggregates(spark, sf_dir))), ["customer_id"])
    done = table.update(sg.risk_scores(table.read()).select("customer_id", "risk_score"), ["risk_score"])
    return table.read().agg(F.count(F.lit(1)).alias("n_rows"), F.lit(done.updated).cast("long").alias("n_updated"),
                            F.sum("risk_score").cast("double").alias("total_risk"))


S3_SQL = with_views("SELECT 'raw-loans.csv.gz' AS chosen, COUNT(*) AS n_rows, COUNT(DISTINCT id) AS n_ids FROM raw_loans",
                    "loans", extra=C1_EXTRA)


@register("s3_plain_or_gzip", S3_SQL, ids=("S3",))
def s3_plain_or_gzip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The plain CSV is read where it exists, else the gzip one (here only that is written)."""
    base = f"{scratch_path(spark, f'raw-{uuid.uuid4().hex}')}/raw-loans.csv"
    raw_loans(spark, sf_dir).write.option("header", True).option("compression", "gzip").csv(f"{base}.gz")
    chosen = existing_csv(spark, base)
    raw = read_csv_strings(spark, chosen, LOAN_RAW_COLUMNS)
    return raw.agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("id").alias("n_ids")).select(
        F.lit(chosen.rsplit("/", 1)[-1]).alias("chosen"), "n_rows", "n_ids")


S4_SQL = with_views("""
SELECT ticker, COUNT(*) AS n_rows, ROUND(SUM(close_price), 2) AS total_close FROM stock_prices GROUP BY ticker""", "stock_prices")


@register("s4_tagged_price_files", S4_SQL, ids=("S4",))
def s4_tagged_price_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices land as one folder of CSV files per ticker, without the ticker in the rows; one scan
    reads them all and tags every row with the ticker of its folder."""
    base = scratch_path(spark, f"raw-prices-{uuid.uuid4().hex}")
    bars = materialize(price_bars(spark, sf_dir))
    bars.write.option("header", True).partitionBy("ticker").csv(base)
    files = {t: f"{base}/ticker={t}" for t in bounded_values(bars, "ticker")}
    tagged = read_tagged(spark, files, "ticker").withColumn("close_price", F.col("close_price").cast("double"))
    return tagged.groupBy("ticker").agg(F.count(F.lit(1)).alias("n_rows"), F.round(F.sum("close_price"), 2).alias("total_close"))


S6_SQL = f"SELECT COUNT(*) AS n_rows, ROUND(SUM(close_price), 2) AS total_close FROM {_part(C3_SQL)} c"


@register("s6_cleaned_copy_first", S6_SQL, ids=("S6",))
def s6_cleaned_copy_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A cleaned Parquet copy exists, so it is read and the raw file is not touched."""
    cleaned = scratch_path(spark, f"prices-cleaned-{uuid.uuid4().hex}")
    clean_stock_prices(raw_prices(spark, sf_dir)).write.parquet(cleaned)

    def no_raw():
        raise AssertionError("the raw file was read although a cleaned copy exists")

    prices = read_or_clean(spark, cleaned, no_raw, clean_stock_prices)
    return prices.agg(F.count(F.lit(1)).alias("n_rows"), F.round(F.sum("close_price"), 2).alias("total_close"))


