"""Named Column builders shared by batch, SQL and streaming jobs (no UDFs).

Fixed values here must equal the reference application's: status lists, band
edges and labels, rule types.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values -----------------------------------------------------------
DEFAULT_STATUSES = ("Charged Off", "Default")
CLOSED_LOAN_STATUSES = ("Fully Paid", "Charged Off", "Default")
RULE_TXN_TYPES = ("TRANSFER", "CASH_OUT")
POLICY_PREFIX_PATTERN = r"^Does not meet the credit policy\.\s*Status:\s*"
SQL_FICO_BANDS = ("Subprime (<660)", "Near-Prime (660-719)", "Prime (720+)")
CUT_FICO_LABELS = ("Subprime (under 660)", "Near-Prime (660-719)", "Prime (720+)")
CUT_FICO_EDGES = (659, 719)  # right-closed bins (-inf,659], (659,719], (719,inf)
DTI_LABELS = ("0-10", "10-20", "20-30", "30-40", "40+")
DTI_EDGES = (10, 20, 30, 40)  # right-closed bins
TRADING_DAYS_PER_YEAR = 252
RISK_FREE_RATE = 0.07
Z_95_SQL = 1.645
Z_99_SQL = 2.326


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_default(status="loan_status") -> Column:
    """1 when the loan status is a default outcome, else 0."""
    return F.when(col_(status).isin(*DEFAULT_STATUSES), F.lit(1)).otherwise(F.lit(0))


def pct_rate(numer: Column, denom: Column, scale: int) -> Column:
    """ROUND(100.0 * numer / denom, scale) computed on decimals, returned as double.

    The division is done on exact decimals (half-up rounding), so both Spark and
    the DuckDB oracle agree digit for digit.
    """
    # decimal(20,0) / decimal(20,0) keeps 18 fractional digits, so the final
    # half-up rounding is not a double rounding.
    ratio = F.try_divide((numer * 100).cast("decimal(20,0)"), denom.cast("decimal(20,0)"))
    return F.round(ratio, scale).cast("double")


def rule_flag(bal_before="sender_bal_before", bal_after="sender_bal_after",
              amount="amount", txn_type="txn_type") -> Column:
    """Balance-drain rule: sender account emptied by one TRANSFER/CASH_OUT (0/1)."""
    cond = ((col_(bal_before) > 0) & (col_(bal_after) == 0) & (col_(amount) == col_(bal_before))
            & col_(txn_type).isin(*RULE_TXN_TYPES))
    return F.when(cond, F.lit(1)).otherwise(F.lit(0)).cast("int")


def sql_fico_band(fico="fico_range_low") -> Column:
    """SQL CASE banding: NULL falls through to the ELSE band (as in the SQL query)."""
    c = col_(fico)
    return (F.when(c < 660, F.lit(SQL_FICO_BANDS[0]))
             .when(c.between(660, 719), F.lit(SQL_FICO_BANDS[1]))
             .otherwise(F.lit(SQL_FICO_BANDS[2])))


def right_closed_bins(c, edges, labels) -> Column:
    """pd.cut-style right-closed bins on (-inf, e0], (e0, e1], ..., (en, inf); NULL stays NULL."""
    c = col_(c)
    expr = F.when(c.isNull(), F.lit(None).cast("string"))
    for e, lab in zip(edges, labels):
        expr = expr.when(c <= e, F.lit(lab))
    return expr.otherwise(F.lit(labels[len(edges)]))


def cut_fico_band(fico="fico_range_low") -> Column:
    return right_closed_bins(fico, CUT_FICO_EDGES, CUT_FICO_LABELS)


def dti_bucket(dti="dti") -> Column:
    return right_closed_bins(dti, DTI_EDGES, DTI_LABELS)


def sanitize_feature_name(name: str) -> str:
    """Driver-side rename of one feature name: '<' -> 'under', brackets -> parentheses."""
    return str(name).replace("<", "under").replace("[", "(").replace("]", ")")
