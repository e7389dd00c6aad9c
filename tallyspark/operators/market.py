"""Market-risk operators on the long (ticker, trade_date) price table.

Series stay long; windows are partitioned by ticker (one instrument's history
per task).  Cross-ticker correlations multiply dense tiles (``operators/comoments.py``)
instead of a self-join that would emit every ticker pair for every date.
"""

from __future__ import annotations

from decimal import Decimal
from fractions import Fraction
from statistics import NormalDist

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyspark.operators.comoments import pair_correlations
from tallyspark.operators.profile import bounded_values
from tallyspark.functions.risk import RISK_FREE_RATE, TRADING_DAYS_PER_YEAR, Z_95_SQL, Z_99_SQL

PORTFOLIO_LABEL = "PORTFOLIO (equal-wt)"
PCTILE_TYPE = "decimal(30,12)"


def rolling_volatility(prices: DataFrame, window_rows: int = 30, digits: int = 5) -> DataFrame:
    """Sample stddev of daily_return over the last ``window_rows`` rows per ticker."""
    w = Window.partitionBy("ticker").orderBy("trade_date").rowsBetween(-(window_rows - 1), 0)
    return prices.select("ticker", "trade_date",
                         F.round(F.stddev_samp("daily_return").over(w), digits).alias("rolling_30d_volatility"))


def tickers_of(prices: DataFrame, max_tickers: int = 5000) -> list[str]:
    """Distinct tickers in order; more than ``max_tickers`` is an error."""
    return bounded_values(prices, "ticker", max_tickers)


def filter_tickers(prices: DataFrame, tickers=None, start=None, end=None) -> DataFrame:
    """Parameter-list filter and date range (pushed into the scan when possible)."""
    out = prices
    if tickers:
        out = out.where(F.col("ticker").isin(list(tickers)))
    if start is not None:
        out = out.where(F.col("trade_date") >= F.lit(start).cast("date"))
    if end is not None:
        out = out.where(F.col("trade_date") <= F.lit(end).cast("date"))
    return out


def returns_wide(prices: DataFrame, tickers: list[str] | None = None, value: str = "daily_return") -> DataFrame:
    """One row per date, one column per ticker; dates where every value is NULL dropped."""
    tickers = tickers or tickers_of(prices)
    src = prices.where(F.col(value).isNotNull()) if value == "daily_return" else prices
    return src.groupBy("trade_date").pivot("ticker", tickers).agg(F.first(value)).orderBy("trade_date")


def portfolio_returns(prices: DataFrame, weights: dict | None = None, with_sum: bool = False) -> DataFrame:
    """Weighted daily portfolio return on dates where every ticker has a return.

    ``weights`` (ticker -> weight) are renormalised over the tickers; equal weights
    by default.  Weights and tickers must be the same set, else a ``ValueError`` tells
    which differ.
    """
    r = prices.where(F.col("daily_return").isNotNull()).select("ticker", "trade_date", "daily_return")
    n_tickers = prices.select(F.countDistinct("ticker")).scalar()  # scalar subquery
    if weights:
        spark = prices.sparkSession
        wdf = spark.createDataFrame([(k, float(v)) for k, v in weights.items()], "ticker string, _w double")
        held = prices.select("ticker").distinct()
        differ = held.join(wdf, "ticker", "left_anti").select("ticker").union(
            wdf.join(held, "ticker", "left_anti").select("ticker")).limit(20).collect()
        if differ:
            raise ValueError(f"weights and tickers differ, for example in {sorted(str(x[0]) for x in differ)}")
        r = r.join(wdf, "ticker")
        ret = F.sum(F.col("_w") * F.col("daily_return")) / F.sum("_w")
    else:
        ret = F.avg("daily_return")
    g = r.groupBy("trade_date").agg(F.count(F.lit(1)).alias("_n"), ret.alias("daily_return"),
                                    F.sum(F.col("daily_return").cast("decimal(18,5)")).alias("_sum"))
    out = g.where(F.col("_n") == n_tickers).withColumn("_nt", n_tickers)
    if with_sum:
        return out.select("trade_date", "daily_return", "_sum", "_nt")
    return out.select("trade_date", "daily_return")


def q_fraction(q: float) -> tuple[int, int, Decimal]:
    """q as num/den with 1/den a finite decimal (so interpolation stays exact)."""
    fr = Fraction(str(q)).limit_denominator(10 ** 6)
    inv = Decimal(1) / Decimal(fr.denominator)
    if inv * fr.denominator != 1:
        raise ValueError(f"quantile {q} has no finite decimal step")
    return fr.numerator, fr.denominator, inv


def series_percentiles(df: DataFrame, keys: list, value: str, qs, scale: int = 5) -> DataFrame:
    """Exact PERCENTILE_CONT of a decimal-valued series per key (linear interpolation).

    Order statistics come from a row_number window per key (one series per
    task); the interpolation ``lo + (hi - lo) * frac`` runs on decimals, so the
    result is exact and identical on every engine and partitioning.
    """
    v = F.col(value).cast(f"decimal(18,{scale})")
    wk = Window.partitionBy(*keys)
    r = df.where(F.col(value).isNotNull()).select(
        *keys, v.alias("_v"), F.row_number().over(wk.orderBy(v)).alias("_rn"),
        F.count(F.lit(1)).over(wk).alias("_n"))
    aggs = []
    for q in qs:
        num, den, inv = q_fraction(q)
        h = (F.col("_n") - 1) * num
        lo_rn = F.floor(h / den).cast("bigint") + 1
        rem = h - (lo_rn - 1) * den
        hi_rn = F.when(rem > 0, lo_rn + 1).otherwise(lo_rn)
        name = f"pctile_{int(round(q * 100)):02d}"
        aggs += [F.max(F.when(F.col("_rn") == lo_rn, F.col("_v"))).alias(f"_lo_{name}"),
                 F.max(F.when(F.col("_rn") == hi_rn, F.col("_v"))).alias(f"_hi_{name}"),
                 F.max(rem).alias(f"_rem_{name}")]
        r = r.withColumn(f"_keep_{name}", (F.col("_rn") == lo_rn) | (F.col("_rn") == hi_rn))
    keep = None
    for c in [c for c in r.columns if c.startswith("_keep_")]:
        keep = F.col(c) if keep is None else (keep | F.col(c))
    g = r.where(keep).groupBy(*keys).agg(*aggs)
    out = [F.col(k) for k in keys]
    for q in qs:
        num, den, inv = q_fraction(q)
        name = f"pctile_{int(round(q * 100)):02d}"
        # keep precisions small so Spark never trims the scale (exact product)
        frac = (F.col(f"_rem_{name}").cast("decimal(12,0)") * F.lit(inv)).cast("decimal(12,10)")
        lo, hi = F.col(f"_lo_{name}"), F.col(f"_hi_{name}")
        out.append((lo + (hi - lo).cast(f"decimal(18,{scale})") * frac).alias(name))
    return g.select(*out)


def _stats(df: DataFrame, keys: list, qs=(0.05, 0.01), scale: int = 5) -> DataFrame:
    """n, mean, sample std and exact percentiles of daily_return per key (series-sized groups)."""
    aggs = [F.count("daily_return").cast("bigint").alias("n_obs"),
            F.avg("daily_return").alias("mean_return"),
            F.stddev_samp("daily_return").alias("stddev_return")]
    base = df.where(F.col("daily_return").isNotNull()).groupBy(*keys).agg(*aggs)
    if not qs:
        return base
    return base.join(series_percentiles(df, keys, "daily_return", qs, scale), keys)


def ticker_and_portfolio_stats(prices: DataFrame, qs=(0.05, 0.01)) -> DataFrame:
    """Per-ticker statistics UNION ALL the equal-weight portfolio row."""
    per = _stats(prices, ["ticker"], qs)
    # portfolio percentiles: exact on the per-date return sums, then divided by the leg count
    pr = portfolio_returns(prices, with_sum=True).withColumn("ticker", F.lit(PORTFOLIO_LABEL))
    port = _stats(pr.drop("_sum", "_nt"), ["ticker"], qs=())
    names = [f"pctile_{int(round(q * 100)):02d}" for q in qs]
    if qs:
        pq = series_percentiles(pr, ["ticker"], "_sum", qs)
        legs = pr.groupBy("ticker").agg(F.max("_nt").alias("_legs"))
        pq = pq.join(legs, "ticker").select(
            "ticker", *[(F.col(n) / F.col("_legs").cast("decimal(10,0)")).cast(PCTILE_TYPE).alias(n) for n in names])
        port = port.join(pq, "ticker")
    per = per.select(*port.columns).withColumns({n: F.col(n).cast(PCTILE_TYPE) for n in names})
    return per.unionByName(port)


def annualized(mean: Column, std: Column, rf: float = RISK_FREE_RATE, days: int = TRADING_DAYS_PER_YEAR):
    ann_ret = F.pow(1 + mean, days) - 1
    ann_vol = std * F.sqrt(F.lit(float(days)))
    sharpe = F.try_divide(ann_ret - F.lit(rf), ann_vol)
    return ann_ret, ann_vol, sharpe


def market_risk_kpis(prices: DataFrame) -> DataFrame:
    """V3: annualised return/vol, Sharpe, historical and parametric VaR (SQL z constants)."""
    s = ticker_and_portfolio_stats(prices)
    ann_ret, ann_vol, sharpe = annualized(F.col("mean_return"), F.col("stddev_return"))
    m, sd = F.col("mean_return"), F.col("stddev_return")
    return s.select(
        "ticker", "n_obs",
        F.round(ann_ret * 100, 2).alias("annualized_return_pct"),
        F.round(ann_vol * 100, 2).alias("annualized_volatility_pct"),
        F.round(sharpe, 3).alias("sharpe_ratio"),
        F.round(-F.col("pctile_05") * 100, 4).cast("double").alias("historical_var_95_pct"),
        F.round(-F.col("pctile_01") * 100, 4).cast("double").alias("historical_var_99_pct"),
        F.round(-(m - F.lit(Z_95_SQL) * sd) * 100, 4).alias("parametric_var_95_pct"),
        F.round(-(m - F.lit(Z_99_SQL) * sd) * 100, 4).alias("parametric_var_99_pct"),
    )


def var_summary(prices: DataFrame, confidences=(0.95, 0.99), digits: int = 6) -> DataFrame:
    """Historical and parametric VaR per (series, confidence), exact normal quantile."""
    spark = prices.sparkSession
    qs = tuple(sorted({round(1 - c, 10) for c in confidences}))
    s = ticker_and_portfolio_stats(prices, qs)
    conf = spark.createDataFrame([(float(c), float(NormalDist().inv_cdf(1 - c))) for c in confidences],
                                 "confidence double, _z double")
    j = s.crossJoin(F.broadcast(conf))
    pct = None
    for q in qs:
        col = F.col(f"pctile_{int(round(q * 100)):02d}")
        cond = F.abs(F.lit(1.0) - F.col("confidence") - F.lit(q)) < 1e-9
        pct = F.when(cond, col) if pct is None else pct.when(cond, col)
    return j.select(
        "ticker", "confidence", "n_obs",
        F.round(-pct * 100, digits).cast("double").alias("historical_var_pct"),
        F.round(-(F.col("mean_return") + F.col("_z") * F.col("stddev_return")) * 100, digits).alias("parametric_var_pct"),
    )


def risk_return_summary(prices: DataFrame, rf: float = RISK_FREE_RATE, days: int = TRADING_DAYS_PER_YEAR) -> DataFrame:
    """T4 (also N7 without rf): annualised return %, volatility %, Sharpe; sorted by Sharpe."""
    s = _stats(prices, ["ticker"], qs=())
    ann_ret, ann_vol, sharpe = annualized(F.col("mean_return"), F.col("stddev_return"), rf, days)
    return s.select("ticker", F.round(ann_ret * 100, 6).alias("annualized_return_pct"),
                    F.round(ann_vol * 100, 6).alias("annualized_volatility_pct"),
                    F.round(sharpe, 6).alias("sharpe_ratio")).orderBy(F.desc("sharpe_ratio"), "ticker")


def correlation_long(prices: DataFrame, tickers: list[str] | None = None, method: str = "pearson",
                     digits: int = 4) -> DataFrame:
    """Pairwise-complete return correlation for all ordered ticker pairs (tidy);
    ``method`` is pearson, spearman or kendall (tau-b)."""
    r = prices.where(F.col("daily_return").isNotNull()).select("ticker", "trade_date", "daily_return")
    if tickers:
        r = r.where(F.col("ticker").isin(list(tickers)))
    return pair_correlations(r, "ticker", "trade_date", "daily_return", method).select(
        F.col("a").alias("ticker_a"), F.col("b").alias("ticker_b"), F.round("correlation", digits).alias("correlation"))


def ranked_pairs(corr: DataFrame, exclude: list[tuple[str, str]] = ()) -> DataFrame:
    """Distinct unordered pairs (a < b) ranked by |corr|, optional excluded pairs."""
    out = corr.where(F.col("ticker_a") < F.col("ticker_b"))
    for a, b in exclude:
        out = out.where(~(((F.col("ticker_a") == a) & (F.col("ticker_b") == b))
                          | ((F.col("ticker_a") == b) & (F.col("ticker_b") == a))))
    w = Window.orderBy(F.desc(F.abs("correlation")), "ticker_a", "ticker_b")
    # at most T*(T-1)/2 rows: ranking them in one partition is bounded by the instrument count
    return out.withColumn("rank", F.row_number().over(w))


def best_worst_day(prices: DataFrame) -> DataFrame:
    """Worst and best single-day return with a deterministic tie-break."""
    r = prices.where(F.col("daily_return").isNotNull())
    agg = r.agg(F.min(F.struct("daily_return", "ticker", "trade_date")).alias("w"),
                F.max(F.struct("daily_return", F.col("ticker"), F.col("trade_date"))).alias("b"))
    return agg.select(F.col("w.ticker").alias("worst_ticker"), F.col("w.trade_date").alias("worst_date"),
                      F.col("w.daily_return").alias("worst_return"), F.col("b.ticker").alias("best_ticker"),
                      F.col("b.trade_date").alias("best_date"), F.col("b.daily_return").alias("best_return"))


def previous_business_day(d: Column) -> Column:
    """Weekday arithmetic: Monday -> Friday, Sunday -> Friday, Saturday -> Friday, else -1 day."""
    dow = F.dayofweek(d)  # 1 = Sunday ... 7 = Saturday
    return F.date_sub(d, F.when(dow == 2, 3).when(dow == 1, 2).otherwise(1))


def portfolio_price_index(prices: DataFrame, weights: dict | None = None, base_value: float = 100.0,
                          digits: int = 6) -> DataFrame:
    """Compounded portfolio index with a base row one business day before the first date."""
    pr = portfolio_returns(prices, weights)
    # the portfolio index is one series (one row per date): an ordered running product, which a
    # loss of everything takes to 0
    w = Window.orderBy("trade_date").rowsBetween(Window.unboundedPreceding, 0)
    idx = pr.select("trade_date", (F.product(F.col("daily_return") + 1).over(w) * base_value).alias("index_value"))
    first = pr.agg(F.min("trade_date").alias("_d"))
    base = first.select(previous_business_day(F.col("_d")).alias("trade_date"),
                        F.lit(float(base_value)).alias("index_value"))
    return base.unionByName(idx).select("trade_date", F.round("index_value", digits).alias("index_value"))


def price_range(recent: DataFrame) -> DataFrame:
    """Q8: (max - min) / min of close per ticker over the given days."""
    g = recent.groupBy("ticker").agg(F.max((F.col("close_price") * 100).cast("bigint")).alias("_hi"),
                                     F.min((F.col("close_price") * 100).cast("bigint")).alias("_lo"))
    ratio = F.try_divide(((F.col("_hi") - F.col("_lo")) * 100).cast("decimal(20,0)"), F.col("_lo").cast("decimal(20,0)"))
    return g.select("ticker", F.round(ratio, 2).cast("double").alias("pct_range")).orderBy(F.desc("pct_range"), "ticker")


def daily_returns(prices: DataFrame, price: str = "adj_close", digits: int = 5) -> DataFrame:
    """Price / previous non-NULL price - 1 per ticker, half-even rounded.

    A row whose price is NULL gets a NULL return, and the next return is measured
    against the last non-NULL price (not padded with a zero return).
    """
    w = Window.partitionBy("ticker").orderBy("trade_date").rowsBetween(Window.unboundedPreceding, -1)
    prev = F.last(F.col(price).cast("double"), ignorenulls=True).over(w)
    return prices.withColumn("daily_return", F.bround(F.col(price).cast("double") / prev - 1, digits))
