"""Raw-file shaped inputs (loans / transactions / prices rendered as text with faults)
and the file scans of the cleaning stage (S1-S4, S6).

The dirty views exercise every cleaning rule on the driver tables: percent and
term strings, month-name dates, policy prefixes, whitespace noise, sentinels,
missing required fields, duplicate keys with a later ingest sequence, footer
rows, unparseable numbers and dates.
"""

from __future__ import annotations


from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark.sources.shaped import loans, price_bars, transactions

# ---- fixed values -----------------------------------------------------------
LOAN_RAW_COLUMNS = [
    "id", "member_id", "loan_amnt", "funded_amnt", "term", "int_rate",
    "installment", "grade", "sub_grade", "emp_length", "home_ownership",
    "annual_inc", "verification_status", "issue_d", "loan_status", "purpose",
    "dti", "delinq_2yrs", "fico_range_low", "fico_range_high", "open_acc",
    "total_acc", "revol_util", "addr_state",
]
TXN_RAW_COLUMNS = ["step", "type", "amount", "nameOrig", "oldbalanceOrg", "newbalanceOrig", "nameDest",
                   "oldbalanceDest", "newbalanceDest", "isFraud", "isFlaggedFraud"]
PRICE_RAW_COLUMNS = ["ticker", "Date", "Open", "High", "Low", "Close", "Adj Close", "Volume"]
POLICY_PREFIX = "Does not meet the credit policy. Status:"
FOOTER_TEXT = "Total amount funded in policy code 1: "


def raw_loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B2: loans rendered as raw strings with planted faults, plus an ingest ``seq``."""
    L = loans(spark, sf_dir)
    k = F.col("loan_id")
    s = lambda c: F.col(c).cast("string")
    base = L.select(
        s("loan_id").alias("id"), s("member_id").alias("member_id"),
        s("loan_amount").alias("loan_amnt"), s("funded_amount").alias("funded_amnt"),
        F.concat(F.lit(" "), s("term_months"), F.lit(" months")).alias("term"),
        F.concat(s("interest_rate"), F.lit("%")).alias("int_rate"),
        s("installment").alias("installment"),
        F.when(k % 101 == 0, F.lit(None)).otherwise(F.col("grade")).alias("grade"),
        F.col("sub_grade"), F.col("employment_length").alias("emp_length"), F.col("home_ownership"),
        F.when(k % 23 == 0, F.lit(None)).otherwise(s("annual_income")).alias("annual_inc"),
        F.col("verification_status"),
        F.date_format("issue_date", "MMM-yyyy").alias("issue_d"),
        F.when(k % 17 == 0, F.concat(F.lit(POLICY_PREFIX), F.col("loan_status"))).otherwise(F.col("loan_status"))
         .alias("loan_status"),
        F.when(k % 11 == 0, F.concat(F.lit("  "), F.col("purpose"), F.lit(" "))).otherwise(F.col("purpose"))
         .alias("purpose"),
        F.when(k % 97 == 0, F.lit("999")).otherwise(s("dti")).alias("dti"),
        s("delinq_2yrs").alias("delinq_2yrs"), s("fico_range_low").alias("fico_range_low"),
        s("fico_range_high").alias("fico_range_high"), s("open_accounts").alias("open_acc"),
        s("total_accounts").alias("total_acc"), F.concat(s("revol_util"), F.lit("%")).alias("revol_util"),
        F.when(k % 29 == 0, F.lit(None)).otherwise(F.col("state")).alias("addr_state"),
        (k * 2).alias("seq"),
    )
    k_base = F.col("seq") / 2
    # duplicate ids with another payload and a later ingest position (keep-first must drop them):
    # emitted in the same pass (explode), so the loans plan is scanned once
    cols = LOAN_RAW_COLUMNS + ["seq"]
    orig = F.struct(*[F.col(c) for c in cols])
    dup = F.struct(*[F.lit("99999.00").alias(c) if c == "loan_amnt" else
                     (F.col("seq") + 1).alias(c) if c == "seq" else F.col(c) for c in cols])
    rows = base.select(F.explode(F.when(k_base % 37 == 0, F.array(orig, dup)).otherwise(F.array(orig))).alias("r"))
    rows = rows.select("r.*")
    # one footer line with a text id (summary line at the end of the file)
    spark = L.sparkSession
    footer = spark.createDataFrame([(FOOTER_TEXT + "(summary)",)], "id string").select(
        *[F.col("id") if c == "id" else F.lit(None).cast("string").alias(c) for c in LOAN_RAW_COLUMNS],
        F.lit(-1).cast("bigint").alias("seq"))
    return rows.unionByName(footer)


RAW_LOANS_SQL = f"""
raw_base AS (
  SELECT CAST(loan_id AS VARCHAR) AS id, CAST(member_id AS VARCHAR) AS member_id,
         CAST(loan_amount AS VARCHAR) AS loan_amnt, CAST(funded_amount AS VARCHAR) AS funded_amnt,
         ' ' || CAST(term_months AS VARCHAR) || ' months' AS term,
         CAST(interest_rate AS VARCHAR) || '%' AS int_rate, CAST(installment AS VARCHAR) AS installment,
         CASE WHEN loan_id % 101 = 0 THEN NULL ELSE grade END AS grade, sub_grade,
         employment_length AS emp_length, home_ownership,
         CASE WHEN loan_id % 23 = 0 THEN NULL ELSE CAST(annual_income AS VARCHAR) END AS annual_inc,
         verification_status, strftime(issue_date, '%b-%Y') AS issue_d,
         CASE WHEN loan_id % 17 = 0 THEN '{POLICY_PREFIX}' || loan_status ELSE loan_status END AS loan_status,
         CASE WHEN loan_id % 11 = 0 THEN '  ' || purpose || ' ' ELSE purpose END AS purpose,
         CASE WHEN loan_id % 97 = 0 THEN '999' ELSE CAST(dti AS VARCHAR) END AS dti,
         CAST(delinq_2yrs AS VARCHAR) AS delinq_2yrs, CAST(fico_range_low AS VARCHAR) AS fico_range_low,
         CAST(fico_range_high AS VARCHAR) AS fico_range_high, CAST(open_accounts AS VARCHAR) AS open_acc,
         CAST(total_accounts AS VARCHAR) AS total_acc, CAST(revol_util AS VARCHAR) || '%' AS revol_util,
         CASE WHEN loan_id % 29 = 0 THEN NULL ELSE state END AS addr_state,
         loan_id * 2 AS seq
  FROM loans
),
raw_loans AS (
  SELECT * FROM raw_base
  UNION ALL
  SELECT id, member_id, '99999.00', funded_amnt, term, int_rate, installment, grade, sub_grade, emp_length,
         home_ownership, annual_inc, verification_status, issue_d, loan_status, purpose, dti, delinq_2yrs,
         fico_range_low, fico_range_high, open_acc, total_acc, revol_util, addr_state, seq + 1
  FROM raw_base WHERE CAST(id AS BIGINT) % 37 = 0
  UNION ALL
  SELECT '{FOOTER_TEXT}(summary)', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL,
         NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, -1
)"""


def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions rendered in the raw column names, with full-row duplicates,
    padded / lower-case types, unparseable amounts and missing counterparties."""
    t = transactions(spark, sf_dir)
    k = F.col("txn_id")
    s = lambda c: F.col(c).cast("string")
    base = t.select(
        s("step").alias("step"),
        F.when(k % 19 == 0, F.concat(F.lit(" "), F.lower("txn_type"), F.lit("  "))).otherwise(F.col("txn_type"))
         .alias("type"),
        F.when(k % 53 == 0, F.lit("n/a")).otherwise(s("amount")).alias("amount"),
        F.col("sender_id").alias("nameOrig"), s("sender_bal_before").alias("oldbalanceOrg"),
        s("sender_bal_after").alias("newbalanceOrig"),
        F.when(k % 61 == 0, F.lit(None)).otherwise(F.col("receiver_id")).alias("nameDest"),
        s("receiver_bal_before").alias("oldbalanceDest"), s("receiver_bal_after").alias("newbalanceDest"),
        s("is_fraud").alias("isFraud"), F.lit("0").alias("isFlaggedFraud"), k.alias("_k"),
    )
    dups = base.where(F.col("_k") % 50 == 0)
    return base.unionByName(dups).drop("_k")


def raw_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars rendered as a raw price file: padded lower-case tickers, ISO or
    slash dates, a few unparseable dates, missing closes and duplicate
    (ticker, date) rows with a later ``seq``."""
    b = price_bars(spark, sf_dir)
    dn = F.datediff(F.col("trade_date"), F.lit("1990-01-01").cast("date"))
    s = lambda c: F.col(c).cast("string")
    base = b.select(
        F.when(dn % 7 == 0, F.concat(F.lit(" "), F.lower("ticker"))).otherwise(F.col("ticker")).alias("ticker"),
        F.when(dn % 5 == 0, F.date_format("trade_date", "yyyy/MM/dd"))
         .when(dn % 211 == 0, F.lit("not a date"))
         .otherwise(F.date_format("trade_date", "yyyy-MM-dd")).alias("Date"),
        s("open_price").alias("Open"), s("high_price").alias("High"), s("low_price").alias("Low"),
        F.when(dn % 173 == 0, F.lit(None)).otherwise(s("close_price")).alias("Close"),
        s("adj_close").alias("Adj Close"), s("volume").alias("Volume"),
        (dn * 10).alias("seq"),
    )
    dups = base.where(dn % 13 == 0).withColumn("Close", F.lit("1.00")).withColumn("seq", F.col("seq") + 1)
    return base.unionByName(dups)


# ---- S1-S4 / S6: file scans ---------------------------------------------------
def read_csv_strings(spark: SparkSession, path, columns: list[str] | None = None) -> DataFrame:
    """Header CSV scan with every column typed as string (no inference pass);
    ``columns`` prunes to the used subset.  ``.csv.gz`` is read natively."""
    df = spark.read.option("header", True).option("inferSchema", False).csv(path)
    return df.select(*columns) if columns else df


def read_tagged(spark: SparkSession, paths: dict[str, str], tag: str = "ticker") -> DataFrame:
    """Many files in one scan, each row tagged with its source key.

    A row belongs to the path that is its file's full path, or the folder it lies in.
    """
    def plain(uri):  # 'file:///a' and 'file:/a' are the same place
        return F.regexp_replace(uri, "^([A-Za-z][A-Za-z0-9+.-]*):/+", "$1:/")

    df = spark.read.option("header", True).csv(list(paths.values())).withColumn(
        "_file", plain(F.col("_metadata.file_path")))
    which = None
    for key, path in paths.items():
        jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)  # noqa: SLF001
        fs = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())  # noqa: SLF001
        uri = plain(F.lit(jvm_path.makeQualified(fs.getUri(), fs.getWorkingDirectory()).toUri().toString()))
        here = (F.col("_file") == uri) | F.startswith(F.col("_file"), F.concat(uri, F.lit("/")))
        which = F.when(here, F.lit(key)) if which is None else which.when(here, F.lit(key))
    return df.withColumn(tag, which).drop("_file")


def existing_csv(spark: SparkSession, path: str) -> str:
    """S3: the plain file (or folder) if it exists, else its ``.gz`` sibling; neither is an error."""
    for candidate in (path, f"{path}.gz"):
        jvm_path = spark._jvm.org.apache.hadoop.fs.Path(candidate)  # noqa: SLF001
        if jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path):  # noqa: SLF001
            return candidate
    raise FileNotFoundError(f"neither {path} nor {path}.gz exists")


def read_or_clean(spark: SparkSession, parquet_path: str, raw_reader, clean_fn) -> DataFrame:
    """Use the cleaned Parquet if it exists, else clean the raw input."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(parquet_path)  # noqa: SLF001
    fs = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())  # noqa: SLF001
    if fs.exists(jvm_path):
        return spark.read.parquet(parquet_path)
    return clean_fn(raw_reader())


ALL_STRING = T.StringType()
