"""Domain views shaped from the driver tables.

The analytics catalogue works on four domains (loans, transactions, daily price
bars, customers).  Their source datasets are not part of the test data, so each
domain is derived deterministically from the driver tables (see FIXTURES.md §B).
Every view exists twice: as a lazy DataFrame builder (what the library runs) and
as DuckDB SQL text (what the correctness oracle runs).  Both must stay in step.

All money arithmetic is exact (decimals, or integer cents), so results do not
depend on partitioning or on the engine's float summation order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyspark.functions.risk import rule_flag
from tallyspark.sources.driver import read_table

# ---------------------------------------------------------------------------
# Fixed values of the shaped views (FIXTURES.md §B)
# ---------------------------------------------------------------------------
STATUS_BY_ORDERSTATUS = {"F": "Charged Off", "O": "Fully Paid", "P": "Current"}
HOME_OWNERSHIP_BY_MOD3 = ["RENT", "MORTGAGE", "OWN"]
VERIFICATION_BY_MOD3 = ["Not Verified", "Source Verified", "Verified"]
TXN_TYPE_BY_EVENT = {
    "purchase": "TRANSFER",
    "click": "CASH_OUT",
    "view": "PAYMENT",
    "signup": "CASH_IN",
    "error": "DEBIT",
}
STEP_ORIGIN = "2024-01-01 00:00:00"  # start of the event clock (TIMESTAMP_NTZ)
STEP_ANCHOR = "2023-01-01"  # calendar anchor for simulated hours (KPI day buckets)


def _case_map(col: Column, mapping: dict, default=None) -> Column:
    expr = None
    for k, v in mapping.items():
        expr = F.when(col == F.lit(k), F.lit(v)) if expr is None else expr.when(col == F.lit(k), F.lit(v))
    return expr.otherwise(F.lit(default))


def _by_index(col: Column, values: list) -> Column:
    return _case_map(col, {i: v for i, v in enumerate(values)})


def _cents(c: Column) -> Column:
    return F.round(c * 100).cast("bigint")


# ---------------------------------------------------------------------------
# loans: orders ⋈ customer ⋈ nation
# ---------------------------------------------------------------------------
def loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    # Dimension keys are primary keys.  Declaring them distinct (dropDuplicates on the
    # key) and joining LEFT lets Catalyst drop the join entirely for queries that use
    # only order columns (Q1, Q3, N2, N8, ...): at scale that removes a shuffle join
    # of the largest fact table.  Queries that do use customer columns reuse the key
    # aggregate's hash partitioning for the join; nation (25 rows) is broadcast by
    # AQE's size check.
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment") \
        .dropDuplicates(["c_custkey"])
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name").dropDuplicates(["n_nationkey"])
    j = (o.join(c, o.o_custkey == c.c_custkey, "left")
          .join(n, F.col("c_nationkey") == F.col("n_nationkey"), "left"))

    prio = F.substring("o_orderpriority", 1, 1).cast("int")
    term = F.when(F.col("o_orderkey") % 3 == 0, F.lit(60)).otherwise(F.lit(36))
    acct = F.col("c_acctbal").cast("decimal(12,2)")
    fico_low = (F.lit(620) + F.pmod(F.col("o_custkey") * 7, F.lit(160))).cast("int")
    emp_k = F.col("o_custkey") % 11
    return j.select(
        F.col("o_orderkey").alias("loan_id"),
        F.col("o_custkey").alias("member_id"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("loan_amount"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("funded_amount"),
        term.cast("int").alias("term_months"),
        ((F.lit(500) + prio * 300 + F.col("o_orderkey") % 100) * F.lit(0.01).cast("decimal(2,2)"))
        .cast("decimal(5,2)").alias("interest_rate"),
        ((F.floor((_cents(F.col("o_totalprice")) + F.floor(term / 2)) / term)).cast("decimal(12,0)")
         * F.lit(0.01).cast("decimal(2,2)")).cast("decimal(10,2)").alias("installment"),
        F.expr("char(64 + cast(substring(o_orderpriority, 1, 1) as int))").alias("grade"),
        F.concat(F.expr("char(64 + cast(substring(o_orderpriority, 1, 1) as int))"),
                 (F.col("o_custkey") % 5 + 1).cast("string")).alias("sub_grade"),
        F.when(emp_k == 0, F.lit("< 1 year")).when(emp_k == 10, F.lit("10+ years"))
         .when(emp_k == 1, F.lit("1 year")).otherwise(F.concat(emp_k.cast("string"), F.lit(" years")))
         .alias("employment_length"),
        _by_index(F.col("o_custkey") % 3, HOME_OWNERSHIP_BY_MOD3).alias("home_ownership"),
        (F.lit(30000) + acct * 10).cast("decimal(14,2)").alias("annual_income"),
        _by_index(F.col("o_orderkey") % 3, VERIFICATION_BY_MOD3).alias("verification_status"),
        F.col("o_orderdate").cast("date").alias("issue_date"),
        _case_map(F.col("o_orderstatus"), STATUS_BY_ORDERSTATUS).alias("loan_status"),
        F.col("c_mktsegment").alias("purpose"),
        F.round(acct * F.lit(0.004).cast("decimal(3,3)"), 2).cast("decimal(6,2)").alias("dti"),
        (F.col("o_orderkey") % 3).cast("int").alias("delinq_2yrs"),
        fico_low.alias("fico_range_low"),
        (fico_low + 4).alias("fico_range_high"),
        (F.col("o_orderkey") % 20).cast("int").alias("open_accounts"),
        (F.col("o_orderkey") % 45).cast("int").alias("total_accounts"),
        (F.col("o_orderkey") % 110).cast("decimal(6,2)").alias("revol_util"),
        F.col("n_name").alias("state"),
    )


LOANS_SQL = """
loans AS (
  SELECT
    o_orderkey AS loan_id,
    o_custkey AS member_id,
    CAST(o_totalprice AS DECIMAL(12,2)) AS loan_amount,
    CAST(o_totalprice AS DECIMAL(12,2)) AS funded_amount,
    CAST(CASE WHEN o_orderkey % 3 = 0 THEN 60 ELSE 36 END AS INTEGER) AS term_months,
    CAST((500 + CAST(substr(o_orderpriority, 1, 1) AS INTEGER) * 300 + o_orderkey % 100) * CAST(0.01 AS DECIMAL(2,2)) AS DECIMAL(5,2)) AS interest_rate,
    CAST(CAST(floor((CAST(round(o_totalprice * 100) AS BIGINT) + (CASE WHEN o_orderkey % 3 = 0 THEN 30 ELSE 18 END))
                    / (CASE WHEN o_orderkey % 3 = 0 THEN 60 ELSE 36 END)) AS DECIMAL(12,0)) * CAST(0.01 AS DECIMAL(2,2)) AS DECIMAL(10,2)) AS installment,
    chr(64 + CAST(substr(o_orderpriority, 1, 1) AS INTEGER)) AS grade,
    chr(64 + CAST(substr(o_orderpriority, 1, 1) AS INTEGER)) || CAST(o_custkey % 5 + 1 AS VARCHAR) AS sub_grade,
    CASE WHEN o_custkey % 11 = 0 THEN '< 1 year' WHEN o_custkey % 11 = 10 THEN '10+ years'
         WHEN o_custkey % 11 = 1 THEN '1 year' ELSE CAST(o_custkey % 11 AS VARCHAR) || ' years' END AS employment_length,
    CASE o_custkey % 3 WHEN 0 THEN 'RENT' WHEN 1 THEN 'MORTGAGE' WHEN 2 THEN 'OWN' END AS home_ownership,
    CAST(30000 + CAST(c_acctbal AS DECIMAL(12,2)) * 10 AS DECIMAL(14,2)) AS annual_income,
    CASE o_orderkey % 3 WHEN 0 THEN 'Not Verified' WHEN 1 THEN 'Source Verified' WHEN 2 THEN 'Verified' END AS verification_status,
    CAST(o_orderdate AS DATE) AS issue_date,
    CASE o_orderstatus WHEN 'F' THEN 'Charged Off' WHEN 'O' THEN 'Fully Paid' WHEN 'P' THEN 'Current' END AS loan_status,
    c_mktsegment AS purpose,
    CAST(round(CAST(c_acctbal AS DECIMAL(12,2)) * CAST(0.004 AS DECIMAL(3,3)), 2) AS DECIMAL(6,2)) AS dti,
    CAST(o_orderkey % 3 AS INTEGER) AS delinq_2yrs,
    CAST(620 + (o_custkey * 7) % 160 AS INTEGER) AS fico_range_low,
    CAST(624 + (o_custkey * 7) % 160 AS INTEGER) AS fico_range_high,
    CAST(o_orderkey % 20 AS INTEGER) AS open_accounts,
    CAST(o_orderkey % 45 AS INTEGER) AS total_accounts,
    CAST(o_orderkey % 110 AS DECIMAL(6,2)) AS revol_util,
    n_name AS state
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
)"""


# ---------------------------------------------------------------------------
# transactions: events
# ---------------------------------------------------------------------------
def transactions(spark: SparkSession, sf_dir: str, types: tuple[str, ...] | None = None) -> DataFrame:
    """Cleaned-transaction shape (11 columns + id), rule flag not yet scored (NULL).

    ``types`` restricts the transaction types on the *source* column, so the
    predicate reaches the Parquet scan (a filter on the derived ``txn_type``
    cannot be pushed through the CASE mapping).
    """
    e = read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value", "props")
    if types is not None:
        sources = [ev for ev, t in TXN_TYPE_BY_EVENT.items() if t in set(types)]
        e = e.where(F.col("event_type").isin(sources))
    k = F.expr("try_cast(get_json_object(props, '$.k') AS INT)")
    e = e.withColumn("_k", k).withColumn("_amount", F.col("value").cast("decimal(14,2)"))
    ttype = _case_map(F.col("event_type"), TXN_TYPE_BY_EVENT)
    e = e.withColumn("txn_type", ttype)
    drained = F.col("_k") % 13 == 0
    return e.select(
        F.col("event_id").alias("txn_id"),
        # whole hours since the event clock's origin, on TIMESTAMP_NTZ (no session time zone involved)
        F.timestamp_diff("HOUR", F.lit(STEP_ORIGIN).cast("timestamp_ntz"), F.col("ts")).cast("int").alias("step"),
        "txn_type",
        F.col("_amount").alias("amount"),
        F.concat(F.lit("C"), F.col("user_id").cast("string")).alias("sender_id"),
        F.when(drained, F.col("_amount")).otherwise(F.col("_amount") + F.col("_k"))
         .cast("decimal(14,2)").alias("sender_bal_before"),
        F.when(drained, F.lit(0)).otherwise(F.col("_k")).cast("decimal(14,2)").alias("sender_bal_after"),
        F.concat(F.lit("M"), F.col("_k").cast("string")).alias("receiver_id"),
        (F.col("_k") * 10).cast("decimal(14,2)").alias("receiver_bal_before"),
        F.when(F.col("_k") % 5 == 0, F.col("_k") * 10).otherwise(F.col("_k") * 10 + F.col("_amount"))
         .cast("decimal(14,2)").alias("receiver_bal_after"),
        F.when((drained & F.col("txn_type").isin("TRANSFER", "CASH_OUT") & (F.col("_k") != 26))
               | (F.col("_k") == 17), F.lit(1)).otherwise(F.lit(0)).cast("int").alias("is_fraud"),
        F.lit(None).cast("int").alias("is_flagged_rule"),
    )


def scored_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """transactions after the rule write-back (S15): is_flagged_rule = rule(row)."""
    t = transactions(spark, sf_dir)
    return t.withColumn("is_flagged_rule", rule_flag())


TRANSACTIONS_SQL = """
ev AS (
  SELECT event_id, ts, user_id, value, CAST(value AS DECIMAL(14,2)) AS amt,
         TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         CASE event_type WHEN 'purchase' THEN 'TRANSFER' WHEN 'click' THEN 'CASH_OUT' WHEN 'view' THEN 'PAYMENT'
                         WHEN 'signup' THEN 'CASH_IN' WHEN 'error' THEN 'DEBIT' END AS txn_type
  FROM events
),
transactions AS (
  SELECT
    event_id AS txn_id,
    CAST(floor((epoch_us(ts) - 1704067200000000) / 3600000000) AS INTEGER) AS step,
    txn_type,
    amt AS amount,
    'C' || CAST(user_id AS VARCHAR) AS sender_id,
    CAST(CASE WHEN k % 13 = 0 THEN amt ELSE amt + k END AS DECIMAL(14,2)) AS sender_bal_before,
    CAST(CASE WHEN k % 13 = 0 THEN 0 ELSE k END AS DECIMAL(14,2)) AS sender_bal_after,
    'M' || CAST(k AS VARCHAR) AS receiver_id,
    CAST(k * 10 AS DECIMAL(14,2)) AS receiver_bal_before,
    CAST(CASE WHEN k % 5 = 0 THEN k * 10 ELSE k * 10 + amt END AS DECIMAL(14,2)) AS receiver_bal_after,
    CAST(CASE WHEN (k % 13 = 0 AND txn_type IN ('TRANSFER', 'CASH_OUT') AND k <> 26) OR k = 17 THEN 1 ELSE 0 END AS INTEGER) AS is_fraud
  FROM ev
),
scored_transactions AS (
  SELECT *,
    CAST(CASE WHEN sender_bal_before > 0 AND sender_bal_after = 0 AND amount = sender_bal_before
              AND txn_type IN ('TRANSFER', 'CASH_OUT') THEN 1 ELSE 0 END AS INTEGER) AS is_flagged_rule
  FROM transactions
)"""


# ---------------------------------------------------------------------------
# stock_prices: lineitem ⋈ part, one bar per (p_type, ship date)
# ---------------------------------------------------------------------------
def price_bars(spark: SparkSession, sf_dir: str, trailing_days: int | None = None) -> DataFrame:
    """Daily bars with exact integer-cent prices (no returns yet).

    ``trailing_days`` keeps the days back from the newest one.  That one date is read from
    lineitem alone, so the filter on the raw column reaches the scan.
    """
    li = read_table(spark, sf_dir, "lineitem").select("l_partkey", "l_quantity", "l_shipdate")
    if trailing_days is not None:
        first = li.agg(F.date_sub(F.max("l_shipdate").cast("date"), trailing_days)
                       .cast(li.schema["l_shipdate"].dataType)).first()[0]
        li = li.where(F.col("l_shipdate") >= F.lit(first))
    p = read_table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_retailprice")
    j = li.join(p, li.l_partkey == p.p_partkey)
    bars = (j.groupBy(F.col("p_type").alias("ticker"), F.col("l_shipdate").cast("date").alias("trade_date"))
             .agg(F.count(F.lit(1)).alias("_n"),
                  F.sum(_cents(F.col("p_retailprice"))).alias("_sum_c"),
                  F.max(_cents(F.col("p_retailprice"))).alias("_max_c"),
                  F.min(_cents(F.col("p_retailprice"))).alias("_min_c"),
                  F.sum("l_quantity").alias("_qty")))
    # half-up integer rounding of the mean price in cents
    close_c = F.floor((F.col("_sum_c") * 2 + F.col("_n")) / (F.col("_n") * 2)).cast("bigint")
    cent = F.lit(0.01).cast("decimal(2,2)")
    return bars.select(
        "ticker", "trade_date",
        (close_c.cast("decimal(12,0)") * cent).cast("decimal(12,2)").alias("open_price"),
        (F.col("_max_c").cast("decimal(12,0)") * cent).cast("decimal(12,2)").alias("high_price"),
        (F.col("_min_c").cast("decimal(12,0)") * cent).cast("decimal(12,2)").alias("low_price"),
        (close_c.cast("decimal(12,0)") * cent).cast("decimal(12,2)").alias("close_price"),
        (close_c.cast("decimal(12,0)") * cent).cast("decimal(12,2)").alias("adj_close"),
        F.col("_qty").cast("bigint").alias("volume"),
        close_c.alias("_close_c"),
    )


def stock_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price table with ``daily_return`` (W2): close / previous close - 1, half-even 5 dp.

    The lag window is partitioned by ticker, so each series is handled in one task;
    a series is one instrument's daily history (thousands of rows), never a
    whole table.
    """
    w = Window.partitionBy("ticker").orderBy("trade_date")
    bars = price_bars(spark, sf_dir)
    ret = F.bround(F.col("_close_c").cast("double") / F.lag("_close_c").over(w).cast("double") - 1, 5)
    return bars.withColumn("daily_return", ret).drop("_close_c")


STOCK_PRICES_SQL = """
bars AS (
  SELECT p_type AS ticker, CAST(l_shipdate AS DATE) AS trade_date,
         count(*) AS n_, sum(CAST(round(p_retailprice * 100) AS BIGINT)) AS sum_c,
         max(CAST(round(p_retailprice * 100) AS BIGINT)) AS max_c,
         min(CAST(round(p_retailprice * 100) AS BIGINT)) AS min_c,
         sum(l_quantity) AS qty
  FROM lineitem JOIN part ON l_partkey = p_partkey
  GROUP BY 1, 2
),
bars_c AS (
  SELECT *, CAST(floor((sum_c * 2 + n_) / (n_ * 2)) AS BIGINT) AS close_c FROM bars
),
stock_prices AS (
  SELECT ticker, trade_date,
    CAST(CAST(close_c AS DECIMAL(12,0)) * CAST(0.01 AS DECIMAL(2,2)) AS DECIMAL(12,2)) AS open_price,
    CAST(CAST(max_c AS DECIMAL(12,0)) * CAST(0.01 AS DECIMAL(2,2)) AS DECIMAL(12,2)) AS high_price,
    CAST(CAST(min_c AS DECIMAL(12,0)) * CAST(0.01 AS DECIMAL(2,2)) AS DECIMAL(12,2)) AS low_price,
    CAST(CAST(close_c AS DECIMAL(12,0)) * CAST(0.01 AS DECIMAL(2,2)) AS DECIMAL(12,2)) AS close_price,
    CAST(CAST(close_c AS DECIMAL(12,0)) * CAST(0.01 AS DECIMAL(2,2)) AS DECIMAL(12,2)) AS adj_close,
    CAST(qty AS BIGINT) AS volume,
    round_even(CAST(close_c AS DOUBLE) / CAST(lag(close_c) OVER (PARTITION BY ticker ORDER BY trade_date) AS DOUBLE) - 1, 5) AS daily_return
  FROM bars_c
)"""


# ---------------------------------------------------------------------------
# customers: orders by o_custkey (RFM-style aggregates, rule segment, risk score)
# ---------------------------------------------------------------------------
def customer_aggregates(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders").select("o_custkey", "o_totalprice", "o_orderdate")
    agg = o.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum(_cents(F.col("o_totalprice"))).alias("_sum_c"),
        F.min(F.col("o_orderdate").cast("date")).alias("signup_date"),
        F.max(F.col("o_orderdate").cast("date")).alias("last_txn_date"),
    )
    cent = F.lit(0.01).cast("decimal(2,2)")
    avg_c = F.floor((F.col("_sum_c") * 2 + F.col("_n")) / (F.col("_n") * 2))
    return agg.select(
        F.col("o_custkey").cast("string").alias("customer_id"),
        "signup_date",
        F.col("_n").cast("int").alias("total_txn_count"),
        (F.col("_sum_c").cast("decimal(22,0)") * cent).cast("decimal(14,2)").alias("total_txn_value"),
        (avg_c.cast("decimal(18,0)") * cent).cast("decimal(14,2)").alias("avg_txn_value"),
        "last_txn_date",
    )


CUSTOMER_AGG_SQL = """
cust_base AS (
  SELECT o_custkey, count(*) AS n_, sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS sum_c,
         min(CAST(o_orderdate AS DATE)) AS signup_date, max(CAST(o_orderdate AS DATE)) AS last_txn_date
  FROM orders GROUP BY o_custkey
),
customer_aggregates AS (
  SELECT CAST(o_custkey AS VARCHAR) AS customer_id, signup_date,
         CAST(n_ AS INTEGER) AS total_txn_count,
         CAST(CAST(sum_c AS DECIMAL(22,0)) * CAST(0.01 AS DECIMAL(2,2)) AS DECIMAL(14,2)) AS total_txn_value,
         CAST(CAST(floor((sum_c * 2 + n_) / (n_ * 2)) AS DECIMAL(18,0)) * CAST(0.01 AS DECIMAL(2,2)) AS DECIMAL(14,2)) AS avg_txn_value,
         last_txn_date
  FROM cust_base
)"""


# ---------------------------------------------------------------------------
# scored: labels with a deterministic score correlated with the label
# ---------------------------------------------------------------------------
def hash_milli(key: Column) -> Column:
    """Integer in [0, 1000) from the md5 digest of the key's text (same in DuckDB)."""
    return F.pmod(F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("bigint"), F.lit(1000))


def scored_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    lab = read_table(spark, sf_dir, "labels").select("doc_id", "toxic")
    # score = h/1000 * 0.7 + 0.3 * y, in units of 1e-4, rounded half-up to 2 dp
    s4 = hash_milli(F.col("doc_id")) * 7 + F.col("toxic") * 3000
    score = (F.floor((s4 + 50) / 100).cast("decimal(6,0)") * F.lit(0.01).cast("decimal(2,2)")).cast("decimal(4,2)")
    return lab.select("doc_id", F.col("toxic").cast("int").alias("y"), score.cast("double").alias("score"))


SCORED_SQL = """
scored AS (
  SELECT doc_id, CAST(toxic AS INTEGER) AS y,
         CAST(CAST(CAST(floor(((CAST(('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8)) AS BIGINT) % 1000) * 7 + toxic * 3000 + 50) / 100) AS DECIMAL(6,0))
              * CAST(0.01 AS DECIMAL(2,2)) AS DECIMAL(4,2)) AS DOUBLE) AS score
  FROM labels
)"""


def fraud_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same hash-score construction over transactions (larger evaluation set)."""
    t = transactions(spark, sf_dir).select("txn_id", "is_fraud")
    s4 = hash_milli(F.col("txn_id")) * 7 + F.col("is_fraud") * 3000
    score = (F.floor((s4 + 50) / 100).cast("decimal(6,0)") * F.lit(0.01).cast("decimal(2,2)")).cast("decimal(4,2)")
    return t.select(F.col("txn_id").alias("doc_id"), F.col("is_fraud").alias("y"), score.cast("double").alias("score"))


FRAUD_SCORED_SQL = """
fraud_scored AS (
  SELECT txn_id AS doc_id, is_fraud AS y,
         CAST(CAST(CAST(floor(((CAST(('0x' || substr(md5(CAST(txn_id AS VARCHAR)), 1, 8)) AS BIGINT) % 1000) * 7 + is_fraud * 3000 + 50) / 100) AS DECIMAL(6,0))
              * CAST(0.01 AS DECIMAL(2,2)) AS DECIMAL(4,2)) AS DOUBLE) AS score
  FROM transactions
)"""


# ---------------------------------------------------------------------------
# SQL assembly for the oracle
# ---------------------------------------------------------------------------
_VIEW_SQL = {
    "loans": (LOANS_SQL, ()),
    "transactions": (TRANSACTIONS_SQL, ()),
    "stock_prices": (STOCK_PRICES_SQL, ()),
    "customer_aggregates": (CUSTOMER_AGG_SQL, ()),
    "scored": (SCORED_SQL, ()),
    "fraud_scored": (FRAUD_SCORED_SQL, ("transactions",)),
}


def with_views(body: str, *views: str, extra: str | None = None) -> str:
    """Prefix ``body`` with the CTEs of the named shaped views (+ optional extra CTEs)."""
    seen: list[str] = []

    def add(v):
        for dep in _VIEW_SQL[v][1]:
            add(dep)
        if v not in seen:
            seen.append(v)

    for v in views:
        add(v)
    ctes = [_VIEW_SQL[v][0].strip() for v in seen]
    if extra:
        ctes.append(extra.strip())
    return "WITH " + ",\n".join(ctes) + "\n" + body.strip()


def exact_avg_sql(x: str, scale_in: int, k: int) -> str:
    """DuckDB twin of ``functions.exact.exact_avg``: ROUND(AVG(x), k) half away from zero, exact."""
    units = f"CAST(round({x} * {10 ** scale_in}) AS BIGINT)"
    mul = 10 ** (k - scale_in)
    s = f"SUM({units})"
    n = f"COUNT({units})"
    return (f"(sign({s}) * ((2 * abs({s}) * {mul} + {n}) // (2 * {n})) / {10 ** k})")
