"""Cleaning jobs C1-C3 over the dirty raw views, with oracle SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark.operators.cleaning import (
    LOAN_NULLABLE_INT_COLUMNS, LOAN_SCHEMA_COLUMNS, MEDIAN_IMPUTE_COLUMNS, STOCK_SCHEMA_COLUMNS,
    TXN_SCHEMA_COLUMNS, WINSOR_COLUMNS, clean_loans, clean_stock_prices, clean_transactions,
)
from tallyspark.plans.registry import register
from tallyspark.sources.raw import FOOTER_TEXT, POLICY_PREFIX, RAW_LOANS_SQL, raw_loans, raw_prices, raw_transactions
from tallyspark.sources.shaped import with_views


def _round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select(*[F.round(F.col(f.name), digits).alias(f.name) if isinstance(f.dataType, T.DoubleType)
                       else F.col(f.name) for f in df.schema.fields])


def _std(x: str) -> str:
    return f"regexp_replace(regexp_replace(CAST({x} AS VARCHAR), '^\\s+|\\s+$', '', 'g'), '\\s+', ' ', 'g')"


def _num(x: str) -> str:
    return f"TRY_CAST(regexp_replace(CAST({x} AS VARCHAR), '^\\s+|\\s+$', '', 'g') AS DOUBLE)"


def _pct(x: str) -> str:
    return f"TRY_CAST(regexp_replace(regexp_replace(CAST({x} AS VARCHAR), '^\\s+|\\s+$', '', 'g'), '%+$', '') AS DOUBLE)"


# C1 --------------------------------------------------------------------------
_NUMS = ["member_id", "loan_amount", "funded_amount", "installment", "annual_income", "dti", "delinq_2yrs",
         "fico_range_low", "fico_range_high", "open_accounts", "total_accounts"]
_RAWNAME = {"loan_amount": "loan_amnt", "funded_amount": "funded_amnt", "annual_income": "annual_inc",
            "open_accounts": "open_acc", "total_accounts": "total_acc"}
_TEXT_FILL = ["employment_length", "home_ownership", "verification_status", "purpose", "state"]

C1_EXTRA = RAW_LOANS_SQL.strip() + f""",
c1_parsed AS (
  SELECT CAST(floor({_num('id')}) AS BIGINT) AS loan_id,
         {', '.join(f"{_num(_RAWNAME.get(c, c))} AS {c}" for c in _NUMS)},
         TRY_CAST(NULLIF(regexp_extract(term, '(\\d+)', 1), '') AS INTEGER) AS term_months,
         {_pct('int_rate')} AS interest_rate, {_pct('revol_util')} AS revol_util,
         CAST(try_strptime(regexp_replace(issue_d, '^\\s+|\\s+$', '', 'g'), '%b-%Y') AS DATE) AS issue_date,
         grade, sub_grade, emp_length AS employment_length, home_ownership, verification_status, loan_status,
         purpose, addr_state AS state, seq
  FROM raw_loans
),
c1_dedup AS (
  SELECT * EXCLUDE (rn_) FROM (
    SELECT *, row_number() OVER (PARTITION BY loan_id ORDER BY seq) AS rn_ FROM c1_parsed
    WHERE loan_id IS NOT NULL AND term_months IS NOT NULL AND issue_date IS NOT NULL
      AND loan_status IS NOT NULL AND grade IS NOT NULL) x WHERE rn_ = 1
),
c1_med AS (
  SELECT {', '.join(f"quantile_cont({c}, 0.5) AS m_{c}" for c in MEDIAN_IMPUTE_COLUMNS)} FROM c1_dedup
),
c1_imp AS (
  SELECT loan_id, member_id, loan_amount, term_months, issue_date,
         {', '.join(f"COALESCE({c}, m_{c}) AS {c}" for c in MEDIAN_IMPUTE_COLUMNS)},
         COALESCE(delinq_2yrs, 0) AS delinq_2yrs,
         {', '.join(f"COALESCE({c}, 'Unknown') AS {c}" for c in _TEXT_FILL)},
         grade, sub_grade, loan_status
  FROM c1_dedup CROSS JOIN c1_med
),
c1_txt AS (
  SELECT * REPLACE (
      regexp_replace({_std('loan_status')}, '^Does not meet the credit policy\\.\\s*Status:\\s*', '') AS loan_status,
      {_std('purpose')} AS purpose, {_std('home_ownership')} AS home_ownership,
      {_std('verification_status')} AS verification_status, {_std('employment_length')} AS employment_length,
      substr(upper({_std('grade')}), 1, 1) AS grade, upper({_std('sub_grade')}) AS sub_grade,
      substr(upper({_std('state')}), 1, 2) AS state)
  FROM c1_imp
),
c1_bounds AS (
  SELECT {', '.join(f"quantile_cont({c}, 0.01) AS lo_{c}, quantile_cont({c}, 0.99) AS hi_{c}" for c in WINSOR_COLUMNS)}
  FROM c1_txt
),
c1 AS (
  SELECT * REPLACE ({', '.join(f"LEAST(GREATEST({c}, lo_{c}), hi_{c}) AS {c}" for c in WINSOR_COLUMNS)})
  FROM c1_txt CROSS JOIN c1_bounds
)"""

_C1_OUT = []
for _c in LOAN_SCHEMA_COLUMNS:
    if _c in LOAN_NULLABLE_INT_COLUMNS:
        _C1_OUT.append(f"CAST(round_even({_c}, 0) AS BIGINT) AS {_c}")
    elif _c in ("loan_id",):
        _C1_OUT.append(_c)
    elif _c in ("loan_amount", "funded_amount", "interest_rate", "installment", "annual_income", "dti", "revol_util"):
        _C1_OUT.append(f"ROUND(CAST({_c} AS DOUBLE), 6) AS {_c}")
    else:
        _C1_OUT.append(_c)
C1_SQL = with_views(f"SELECT {', '.join(_C1_OUT)} FROM c1", "loans", extra=C1_EXTRA)


@register("c1_clean_loans", C1_SQL, ids=("C1", "S1", "P1", "P2", "P3", "P4", "P5", "P6", "P7", "P9", "P10", "P11",
                                         "P12", "P13", "A13", "A14", "A15", "F1", "F4"))
def c1_clean_loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round_doubles(clean_loans(raw_loans(spark, sf_dir)))


# C2 --------------------------------------------------------------------------
C2_EXTRA = """
raw_txn_base AS (
  SELECT txn_id AS k_, CAST(step AS VARCHAR) AS step,
         CASE WHEN txn_id % 19 = 0 THEN ' ' || lower(txn_type) || '  ' ELSE txn_type END AS "type",
         CASE WHEN txn_id % 53 = 0 THEN 'n/a' ELSE CAST(amount AS VARCHAR) END AS amount,
         sender_id AS "nameOrig", CAST(sender_bal_before AS VARCHAR) AS "oldbalanceOrg",
         CAST(sender_bal_after AS VARCHAR) AS "newbalanceOrig",
         CASE WHEN txn_id % 61 = 0 THEN NULL ELSE receiver_id END AS "nameDest",
         CAST(receiver_bal_before AS VARCHAR) AS "oldbalanceDest", CAST(receiver_bal_after AS VARCHAR) AS "newbalanceDest",
         CAST(is_fraud AS VARCHAR) AS "isFraud", '0' AS "isFlaggedFraud"
  FROM transactions
),
raw_txn AS (
  SELECT * EXCLUDE (k_) FROM raw_txn_base UNION ALL SELECT * EXCLUDE (k_) FROM raw_txn_base WHERE k_ % 50 = 0
),
c2_num AS (
  SELECT """ + ", ".join([
    f"{_num('step')} AS step", f"\"type\" AS txn_type", f"{_num('amount')} AS amount",
    "\"nameOrig\" AS sender_id", f"{_num(chr(34) + 'oldbalanceOrg' + chr(34))} AS sender_bal_before",
    f"{_num(chr(34) + 'newbalanceOrig' + chr(34))} AS sender_bal_after", "\"nameDest\" AS receiver_id",
    f"{_num(chr(34) + 'oldbalanceDest' + chr(34))} AS receiver_bal_before",
    f"{_num(chr(34) + 'newbalanceDest' + chr(34))} AS receiver_bal_after",
    f"{_num(chr(34) + 'isFraud' + chr(34))} AS is_fraud"]) + """
  FROM (SELECT DISTINCT * FROM raw_txn) d
)"""
C2_SQL = with_views(f"""
SELECT CAST(step AS BIGINT) AS step, upper({_std('txn_type')}) AS txn_type, ROUND(amount, 6) AS amount,
       {_std('sender_id')} AS sender_id, ROUND(sender_bal_before, 6) AS sender_bal_before,
       ROUND(sender_bal_after, 6) AS sender_bal_after, {_std('receiver_id')} AS receiver_id,
       ROUND(receiver_bal_before, 6) AS receiver_bal_before, ROUND(receiver_bal_after, 6) AS receiver_bal_after,
       CAST(is_fraud AS BIGINT) AS is_fraud, CAST(NULL AS BIGINT) AS is_flagged_rule
FROM c2_num WHERE step IS NOT NULL AND amount IS NOT NULL AND sender_id IS NOT NULL AND receiver_id IS NOT NULL""",
                    "transactions", extra=C2_EXTRA)


@register("c2_clean_transactions", C2_SQL, ids=("C2", "S2", "A16", "P14"))
def c2_clean_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round_doubles(clean_transactions(raw_transactions(spark, sf_dir)))


# C3 --------------------------------------------------------------------------
_DATE_FMTS = ["%Y-%m-%d", "%Y/%m/%d", "%d-%m-%Y", "%m/%d/%Y", "%Y-%m-%d %H:%M:%S"]
C3_EXTRA = """
bars_raw AS (
  SELECT ticker, trade_date, open_price, high_price, low_price, close_price, adj_close, volume,
         date_diff('day', DATE '1990-01-01', trade_date) AS dn
  FROM stock_prices
),
raw_px_base AS (
  SELECT CASE WHEN dn % 7 = 0 THEN ' ' || lower(ticker) ELSE ticker END AS ticker,
         CASE WHEN dn % 5 = 0 THEN strftime(trade_date, '%Y/%m/%d') WHEN dn % 211 = 0 THEN 'not a date'
              ELSE strftime(trade_date, '%Y-%m-%d') END AS "Date",
         CAST(open_price AS VARCHAR) AS "Open", CAST(high_price AS VARCHAR) AS "High", CAST(low_price AS VARCHAR) AS "Low",
         CASE WHEN dn % 173 = 0 THEN NULL ELSE CAST(close_price AS VARCHAR) END AS "Close",
         CAST(adj_close AS VARCHAR) AS "Adj Close", CAST(volume AS VARCHAR) AS "Volume", dn * 10 AS seq, dn
  FROM bars_raw
),
raw_px AS (
  SELECT * EXCLUDE (dn) FROM raw_px_base
  UNION ALL SELECT * EXCLUDE (dn) REPLACE ('1.00' AS "Close", seq + 1 AS seq) FROM raw_px_base WHERE dn % 13 = 0
),
c3_parsed AS (
  SELECT upper(""" + _std("ticker") + """) AS ticker,
         CAST(COALESCE(""" + ", ".join(
    f"try_strptime(regexp_replace(\"Date\", '^\\s+|\\s+$', '', 'g'), '{f}')" for f in _DATE_FMTS) + """) AS DATE) AS trade_date,
         """ + _num('"Open"') + """ AS open_price, """ + _num('"High"') + """ AS high_price,
         """ + _num('"Low"') + """ AS low_price, """ + _num('"Close"') + """ AS close_price,
         """ + _num('"Adj Close"') + """ AS adj_close, CAST(round_even(""" + _num('"Volume"') + """, 0) AS BIGINT) AS volume, seq
  FROM raw_px
)"""
C3_SQL = with_views("""
SELECT ticker, trade_date, ROUND(open_price, 6) AS open_price, ROUND(high_price, 6) AS high_price,
       ROUND(low_price, 6) AS low_price, ROUND(close_price, 6) AS close_price, ROUND(adj_close, 6) AS adj_close, volume
FROM (SELECT *, row_number() OVER (PARTITION BY ticker, trade_date ORDER BY seq) AS rn_ FROM c3_parsed
      WHERE ticker IS NOT NULL AND trade_date IS NOT NULL AND close_price IS NOT NULL) x
WHERE rn_ = 1 ORDER BY ticker, trade_date""", "stock_prices", extra=C3_EXTRA)


@register("c3_clean_stock_prices", C3_SQL, ids=("C3", "P8"))
def c3_clean_stock_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round_doubles(clean_stock_prices(raw_prices(spark, sf_dir)))


__all__ = ["FOOTER_TEXT", "POLICY_PREFIX", "STOCK_SCHEMA_COLUMNS", "TXN_SCHEMA_COLUMNS"]


@register("s1_clean_loans_from_csv", C1_SQL, ids=("S1", "S2", "S3", "C4"))
def s1_clean_loans_from_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C4 path: raw loans land as gzip CSV files, are scanned as strings with the
    used columns only, cleaned, and compared with the oracle's cleaning."""
    import uuid

    from tallyspark.session import scratch_path
    from tallyspark.sources.raw import LOAN_RAW_COLUMNS, read_csv_strings

    path = scratch_path(spark, f"raw-loans-csv-{uuid.uuid4().hex}")
    raw_loans(spark, sf_dir).write.option("header", True).option("compression", "gzip").csv(path)
    raw = read_csv_strings(spark, path, LOAN_RAW_COLUMNS + ["seq"]).withColumn("seq", F.col("seq").cast("bigint"))
    return _round_doubles(clean_loans(raw))
