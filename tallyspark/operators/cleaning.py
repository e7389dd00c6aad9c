"""Cleaning jobs (C1-C3) and their building blocks.

Each job is one lazy plan: parse -> filter -> keep-first dedup -> side
aggregates (medians, winsor bounds) -> fill / clip -> cast.  The side aggregates
are one-row (or one-row-per-column) tables joined back by broadcast; their size
is the number of columns, not the number of rows.

``quantiles`` selects how the medians and winsor bounds are computed:

* ``"selection"`` (default) - exact, by radix selection over all columns at once
  (``operators/selection.py``): only counts of sub-ranges leave a task, and the winsor
  bounds after imputation follow from the ranks before it, so one selection serves both;
* ``"exact"`` - Spark's ``percentile`` in a single aggregate (exact; keeps a
  value->count map per column in the final task, fine for bounded cardinality);
* ``"approx"`` - ``percentile_approx`` (bounded memory, approximate).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.functions.risk import POLICY_PREFIX_PATTERN
from tallyspark.functions.text import (
    parse_date_any, parse_month_year, parse_percent, parse_term_months, round_half_even_long,
    standardize, strip_policy_prefix, to_number, upper_left,
)
from tallyspark.operators.selection import exact_quantiles_wide, medians_and_clips
from tallyspark.session import materialize

# ---- fixed values -----------------------------------------------------------
LOAN_RENAME = {
    "id": "loan_id", "loan_amnt": "loan_amount", "funded_amnt": "funded_amount", "int_rate": "interest_rate",
    "emp_length": "employment_length", "annual_inc": "annual_income", "issue_d": "issue_date",
    "open_acc": "open_accounts", "total_acc": "total_accounts", "addr_state": "state",
}
LOAN_SCHEMA_COLUMNS = [
    "loan_id", "member_id", "loan_amount", "funded_amount", "term_months", "interest_rate", "installment",
    "grade", "sub_grade", "employment_length", "home_ownership", "annual_income", "verification_status",
    "issue_date", "loan_status", "purpose", "dti", "delinq_2yrs", "fico_range_low", "fico_range_high",
    "open_accounts", "total_accounts", "revol_util", "state",
]
LOAN_NULLABLE_INT_COLUMNS = ["member_id", "term_months", "delinq_2yrs", "fico_range_low", "fico_range_high",
                             "open_accounts", "total_accounts"]
LOAN_NUMERIC_COLUMNS = ["member_id", "loan_amount", "funded_amount", "installment", "annual_income", "dti",
                        "delinq_2yrs", "fico_range_low", "fico_range_high", "open_accounts", "total_accounts"]
MEDIAN_IMPUTE_COLUMNS = ["annual_income", "dti", "revol_util", "installment", "funded_amount", "interest_rate",
                         "fico_range_low", "fico_range_high", "open_accounts", "total_accounts"]
WINSOR_COLUMNS = ["annual_income", "loan_amount", "dti"]
TXN_RENAME = {
    "type": "txn_type", "nameOrig": "sender_id", "oldbalanceOrg": "sender_bal_before",
    "newbalanceOrig": "sender_bal_after", "nameDest": "receiver_id", "oldbalanceDest": "receiver_bal_before",
    "newbalanceDest": "receiver_bal_after", "isFraud": "is_fraud", "isFlaggedFraud": "is_flagged_rule",
}
TXN_SCHEMA_COLUMNS = ["step", "txn_type", "amount", "sender_id", "sender_bal_before", "sender_bal_after",
                      "receiver_id", "receiver_bal_before", "receiver_bal_after", "is_fraud", "is_flagged_rule"]
STOCK_RENAME = {"Date": "trade_date", "Open": "open_price", "High": "high_price", "Low": "low_price",
                "Close": "close_price", "Adj Close": "adj_close", "Volume": "volume"}
STOCK_SCHEMA_COLUMNS = ["ticker", "trade_date", "open_price", "high_price", "low_price", "close_price",
                        "adj_close", "volume"]


# ---- building blocks ----------------------------------------------------------
def column_quantiles(df: DataFrame, cols: list[str], qs: list[float], mode: str = "selection") -> DataFrame:
    """Quantiles ``qs`` of each column in ``cols`` as a long table (column, q, quantile)."""
    if mode == "selection":
        return exact_quantiles_wide(df, cols, qs)
    if mode not in ("exact", "approx"):
        raise ValueError(f"unknown quantile mode {mode!r}")
    fn = (lambda c: F.percentile(F.col(c).cast("double"), F.array(*[F.lit(q) for q in qs]))) if mode == "exact" else \
         (lambda c: F.percentile_approx(F.col(c).cast("double"), list(qs), 10000).cast("array<double>"))
    row = df.agg(*[fn(c).alias(c) for c in cols])
    parts = [row.select(F.lit(c).alias("column"), F.posexplode(F.col(c)).alias("_i", "quantile")) for c in cols]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    qmap = F.element_at(F.array(*[F.lit(float(q)) for q in qs]), F.col("_i") + 1)
    return out.select("column", qmap.alias("q"), "quantile")


def _wide(quant: DataFrame, cols: list[str], qs: list[float], names: list[str]) -> DataFrame:
    """One row: <col>__<name> for each column and quantile (len(cols) * len(qs) values)."""
    aggs = []
    for c in cols:
        for q, nm in zip(qs, names):
            aggs.append(F.max(F.when((F.col("column") == c) & (F.abs(F.col("q") - q) < 1e-12), F.col("quantile")))
                        .alias(f"{c}__{nm}"))
    return quant.agg(*aggs)


def impute_median(df: DataFrame, cols: list[str], mode: str = "selection") -> DataFrame:
    """Fill NULLs with each column's median (one pass for all columns)."""
    med = _wide(column_quantiles(df, cols, [0.5], mode), cols, [0.5], ["med"])
    j = df.crossJoin(F.broadcast(med))  # one row
    for c in cols:
        j = j.withColumn(c, F.coalesce(F.col(c).cast("double"), F.col(f"{c}__med")))
    return j.drop(*[f"{c}__med" for c in cols])


def winsorize(df: DataFrame, cols: list[str], lower: float = 0.01, upper: float = 0.99,
              mode: str = "selection") -> DataFrame:
    """Clip each column to its [lower, upper] quantiles; NULL stays NULL."""
    b = _wide(column_quantiles(df, cols, [lower, upper], mode), cols, [lower, upper], ["lo", "hi"])
    j = df.crossJoin(F.broadcast(b))  # one row
    for c in cols:
        x = F.col(c).cast("double")
        j = j.withColumn(c, F.when(x.isNull(), x).otherwise(F.least(F.greatest(x, F.col(f"{c}__lo")), F.col(f"{c}__hi"))))
    return j.drop(*[f"{c}__{n}" for c in cols for n in ("lo", "hi")])


def impute_and_winsorize(df: DataFrame, impute: list[str], clip: list[str], lower: float = 0.01, upper: float = 0.99) -> DataFrame:
    """A14 then A13, with all medians and bounds from one selection over ``df``."""
    medians, bounds = medians_and_clips(df, impute, clip, lower, upper)

    def value(c: str) -> Column:
        x = F.col(c).cast("double")
        if c in impute:
            x = F.coalesce(x, F.lit(medians[c]).cast("double"))
        if c in clip and bounds[c][0] is not None:
            x = F.when(x.isNotNull(), F.least(F.greatest(x, F.lit(bounds[c][0])), F.lit(bounds[c][1])))
        return x.alias(c)

    return df.select(*[value(c) if c in impute or c in clip else F.col(f"`{c}`") for c in df.columns])


def keep_first(df: DataFrame, keys: list[str], order: Column | str) -> DataFrame:
    """One row per key, the first by an explicit ingest order (never arbitrary).

    One aggregate over one scan: every input partition keeps one row per key before the
    shuffle, so a key with a large share of the rows costs a row per task.  A missing
    order comes last; rows that tie are told apart by a hash of their values, so the
    result is deterministic.
    """
    order = F.col(order) if isinstance(order, str) else order
    columns = [F.col(f"`{c}`") for c in df.columns]
    place = F.struct(order.isNull().alias("missing"), order.alias("order"), F.xxhash64(*columns).alias("hash"))
    first = df.groupBy(*[F.col(f"`{k}`").alias(f"_k{i}") for i, k in enumerate(keys)]).agg(
        F.min_by(F.struct(*columns), place).alias("_row"))
    return first.select("_row.*")


def rename(df: DataFrame, mapping: dict) -> DataFrame:
    """P1."""
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


# ---- C1 ----------------------------------------------------------------------------
def clean_loans(raw: DataFrame, order: str = "seq", quantiles: str = "selection") -> DataFrame:
    """Raw loan strings -> the 24-column typed loan table.

    Order of steps as in the reference: parse, drop rows missing required
    fields, keep the first row per loan_id (by ``order``), impute medians,
    constant fills, text normalisation, winsorize (bounds after imputation),
    half-even integer rounding.  ``loan_amount`` is winsorized but not imputed.
    """
    df = rename(raw, LOAN_RENAME)
    loan_id = F.floor(to_number("loan_id")).cast("bigint")
    issued = parse_month_year("issue_date")
    # only what decides which rows stay is parsed before the shuffle; the rest of a row
    # travels as text and is parsed once it is known to stay
    whole = df.where(loan_id.isNotNull() & parse_term_months("term").isNotNull() & issued.isNotNull()
                     & F.col("loan_status").isNotNull() & F.col("grade").isNotNull())
    text = [F.col(c) for c in ("grade", "sub_grade", "employment_length", "home_ownership", "verification_status",
                               "loan_status", "purpose", "state", "term", "interest_rate", "revol_util", "issue_date")]
    rows = whole.select(loan_id.alias("loan_id"), *LOAN_NUMERIC_COLUMNS, *text, F.col(order).alias("_order"))
    kept = keep_first(rows, ["loan_id"], "_order")
    dedup = materialize(kept.select(
        "loan_id", *[to_number(c).alias(c) for c in LOAN_NUMERIC_COLUMNS], parse_term_months("term").alias("term_months"),
        parse_percent("interest_rate").alias("interest_rate"), parse_percent("revol_util").alias("revol_util"),
        issued.alias("issue_date"), *text[:8]))
    if quantiles == "selection":
        w = impute_and_winsorize(dedup, MEDIAN_IMPUTE_COLUMNS, WINSOR_COLUMNS)
    else:
        w = winsorize(impute_median(dedup, MEDIAN_IMPUTE_COLUMNS, quantiles), WINSOR_COLUMNS, mode=quantiles)
    w = w.withColumn("delinq_2yrs", F.coalesce(F.col("delinq_2yrs"), F.lit(0.0)))
    w = w.na.fill("Unknown", subset=["employment_length", "home_ownership", "verification_status", "purpose", "state"])
    txt = w.withColumn("loan_status", strip_policy_prefix(standardize("loan_status"), POLICY_PREFIX_PATTERN))
    for c in ("purpose", "home_ownership", "verification_status", "employment_length"):
        txt = txt.withColumn(c, standardize(c))
    w = (txt.withColumn("grade", upper_left(standardize("grade"), 1))
            .withColumn("sub_grade", upper_left(standardize("sub_grade")))
            .withColumn("state", upper_left(standardize("state"), 2)))
    for c in LOAN_NULLABLE_INT_COLUMNS:
        w = w.withColumn(c, round_half_even_long(c))
    return w.select(*LOAN_SCHEMA_COLUMNS)


# ---- C2 ----------------------------------------------------------------------------
def clean_transactions(raw: DataFrame) -> DataFrame:
    """Full-row dedup first, then coercion, required fields, text, NULL rule flag."""
    df = rename(raw, TXN_RENAME).distinct()
    num = ["step", "amount", "sender_bal_before", "sender_bal_after", "receiver_bal_before", "receiver_bal_after",
           "is_fraud"]
    for c in num:
        df = df.withColumn(c, to_number(c))
    df = df.na.drop(subset=["step", "amount", "sender_id", "receiver_id"])
    df = (df.withColumn("txn_type", F.upper(standardize("txn_type")))
            .withColumn("sender_id", standardize("sender_id"))
            .withColumn("receiver_id", standardize("receiver_id"))
            .withColumn("step", F.col("step").cast("bigint"))
            # a non-integral / unparseable label stays NULL here (the source raises);
            # route such rows with ``reject_bad_labels`` when strictness is needed
            .withColumn("is_fraud", F.col("is_fraud").cast("bigint"))
            .withColumn("is_flagged_rule", F.lit(None).cast("bigint")))
    return df.select(*TXN_SCHEMA_COLUMNS)


def reject_bad_labels(clean: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split rows with an unusable label into a reject output."""
    bad = F.col("is_fraud").isNull() | ~F.col("is_fraud").isin(0, 1)
    return clean.where(~bad), clean.where(bad)


# ---- C3 ----------------------------------------------------------------------------
def clean_stock_prices(raw: DataFrame, order: str = "seq") -> DataFrame:
    """Parse dates (several formats), normalise tickers, coerce numbers,
    required fields, keep first per (ticker, date), sort."""
    df = rename(raw, STOCK_RENAME)
    df = df.select(
        F.upper(standardize("ticker")).alias("ticker"),
        parse_date_any("trade_date").alias("trade_date"),
        *[to_number(c).alias(c) for c in ("open_price", "high_price", "low_price", "close_price", "adj_close")],
        round_half_even_long(to_number("volume")).alias("volume"),
        F.col(order).alias("_order"),
    )
    df = df.na.drop(subset=["ticker", "trade_date", "close_price"])
    df = keep_first(df, ["ticker", "trade_date"], "_order")
    return df.select(*STOCK_SCHEMA_COLUMNS).orderBy("ticker", "trade_date")
