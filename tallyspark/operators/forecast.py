"""Forecasting (W6-W8, T6-T9): chronological holdout, naive baselines, ARIMA order search.

All series are handled in one job: the long (series, date, value) table is split
by a per-series ``row_number`` window (one series per task), baselines are window
and aggregate expressions, and the ARIMA grid is a grouped ``applyInPandas`` over
(series, order) pairs - each group holds one series once per order, so the work
grows with series x grid, never with a whole table in one task.

The ARIMA fit is a re-aim of a maximum-likelihood state-space solver:
two-stage (Hannan-Rissanen) least squares for ARMA(p, q) on the d-times
differenced series, Gaussian AIC, non-stationary or failed fits skipped.
"""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

HOLDOUT_DAYS = 60
SEASONAL_LAG_DAYS = 5
P_RANGE, D_RANGE, Q_RANGE = range(0, 3), (0, 1), range(0, 3)
DEFAULT_ORDER = (1, 1, 0)
LONG_AR = 8  # lags of the first-stage autoregression that estimates the innovations
COMMON_START = 1 + LONG_AR + max(max(P_RANGE), max(Q_RANGE))  # first observation that every order can predict


def holdout_split(series: DataFrame, holdout: int = HOLDOUT_DAYS) -> DataFrame:
    """Last ``holdout`` non-NULL observations of each series are the holdout.

    Adds ``split`` and ``obs`` (1-based position among the series' observations);
    a series not longer than the holdout is flagged ``too_short``.
    """
    s = series.where(F.col("value").isNotNull())
    w = Window.partitionBy("series")
    s = s.withColumn("obs", F.row_number().over(w.orderBy("trade_date"))).withColumn("_n", F.count(F.lit(1)).over(w))
    return s.withColumn("split", F.when(F.col("_n") <= holdout, F.lit("too_short"))
                        .when(F.col("obs") > F.col("_n") - holdout, F.lit("holdout")).otherwise(F.lit("train"))).drop("_n")


def rejected_series(split: DataFrame) -> DataFrame:
    """Series that cannot be evaluated because they are not longer than the holdout."""
    return (split.where(F.col("split") == "too_short").groupBy("series")
            .agg(F.count(F.lit(1)).alias("n_obs"), F.lit("not longer than the holdout").alias("reason")))


def naive_forecasts(split: DataFrame, lag: int = SEASONAL_LAG_DAYS) -> DataFrame:
    """Last-value (held flat) and seasonal-naive (lag over observations) per holdout row."""
    w = Window.partitionBy("series").orderBy("obs")
    seasonal = split.withColumn("naive_seasonal", F.lag("value", lag).over(w))
    last = split.where(F.col("split") == "train").groupBy("series").agg(
        F.max_by("value", "obs").alias("naive_last_value"))  # one row per series
    h = seasonal.where(F.col("split") == "holdout").join(last, "series")
    return h.select("series", "trade_date", "obs", F.col("value").alias("actual"), "naive_last_value", "naive_seasonal")


def evaluation(forecasts_long: DataFrame, digits: int = 6) -> DataFrame:
    """RMSE and MAPE (%) per (series, model); sorted by RMSE within a series.

    A model without forecasts for a series has NULL measures and status ``failed``.
    """
    e = F.col("actual") - F.col("forecast")
    g = forecasts_long.groupBy("series", "model").agg(
        F.sqrt(F.avg(e * e)).alias("rmse"),
        (F.avg(F.abs(F.try_divide(e, F.col("actual")))) * 100).alias("mape_pct"))
    return g.select("series", "model", F.round("rmse", digits).alias("rmse"), F.round("mape_pct", digits).alias("mape_pct"),
                    F.when(F.col("rmse").isNull(), "failed").otherwise("ok").alias("status")).orderBy("series", "rmse")


def to_long(fc: DataFrame, models: list[str]) -> DataFrame:
    parts = [fc.select("series", "trade_date", "actual", F.lit(m).alias("model"), F.col(m).alias("forecast"))
             for m in models]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ---------------------------------------------------------------------------- ARIMA
def _ols(X, y):
    beta, *_ = np.linalg.lstsq(X, y, rcond=None)
    return beta, y - X @ beta


def _lagmat(x, k, start):
    return np.column_stack([x[start - i: len(x) - i] for i in range(1, k + 1)]) if k else np.empty((len(x) - start, 0))


def fit_arma(y: np.ndarray, p: int, d: int, q: int):
    """Two-stage least squares ARIMA(p, d, q); returns dict or None when the fit is unusable.

    Every order is fitted and scored on the one-step errors of the same observations, so
    AIC values compare across orders and do not depend on the unit of the series.
    """
    z = np.diff(y, n=d) if d else y.astype(float)
    n = len(z)
    start = COMMON_START - d  # the same observations of y for every order
    if n <= start + p + q + 5:
        return None
    const = d == 0
    e = np.zeros(n)
    if q:
        Xl = _lagmat(z, LONG_AR, LONG_AR)
        if const:
            Xl = np.column_stack([np.ones(len(Xl)), Xl])
        _, res = _ols(Xl, z[LONG_AR:])
        e[LONG_AR:] = res
    cols = [np.ones(n - start)] if const else []
    if p:
        cols.append(_lagmat(z, p, start))
    if q:
        cols.append(_lagmat(e, q, start))
    X = np.column_stack(cols) if cols else np.empty((n - start, 0))
    target = z[start:]
    if X.shape[1] == 0:
        return None
    beta, res = _ols(X, target)
    c = beta[0] if const else 0.0
    phi = beta[int(const): int(const) + p]
    theta = beta[int(const) + p:]
    # stationarity: roots of z^p - phi_1 z^(p-1) - ... - phi_p strictly inside the unit circle
    if p and np.any(np.abs(np.roots(np.r_[1.0, -phi])) >= 1.0):
        return None  # non-stationary AR part: skipped as a failed fit
    sigma2 = float(np.mean(res ** 2))
    if not np.isfinite(sigma2) or sigma2 <= 0:
        return None
    nobs = len(res)
    k = p + q + int(const) + 1
    aic = nobs * (np.log(2 * np.pi * sigma2) + 1) + 2 * k
    return {"c": float(c), "phi": phi, "theta": theta, "sigma2": sigma2, "aic": float(aic), "z": z,
            "e": np.r_[np.zeros(n - len(res)), res], "d": d}


def forecast_arma(y: np.ndarray, fit: dict, steps: int) -> np.ndarray:
    z, e = list(fit["z"]), list(fit["e"])
    phi, theta, c = fit["phi"], fit["theta"], fit["c"]
    out = []
    for _ in range(steps):
        ar = sum(phi[i] * z[-1 - i] for i in range(len(phi)))
        ma = sum(theta[j] * e[-1 - j] for j in range(len(theta)))
        nxt = c + ar + ma
        z.append(nxt)
        e.append(0.0)
        out.append(nxt)
    f = np.array(out)
    if fit["d"] == 1:
        f = y[-1] + np.cumsum(f)
    return f


def order_grid() -> list[tuple[int, int, int]]:
    return [(p, d, q) for p, d, q in itertools.product(P_RANGE, D_RANGE, Q_RANGE) if not (p == 0 and q == 0)]


def arima_orders(split: DataFrame) -> DataFrame:
    """T6 step 1: AIC of every grid order per series (train rows only); one group per (series, order)."""
    # each train row is repeated once per grid order (grid size 17): bounded replication
    grid = F.array(*[F.struct(F.lit(p).alias("p"), F.lit(d).alias("d"), F.lit(q).alias("q"))
                     for p, d, q in order_grid()])
    train = split.where(F.col("split") == "train").select("series", "obs", "value")
    pairs = train.select("series", "obs", "value", F.explode(grid).alias("_o")).select(
        "series", "obs", "value", "_o.p", "_o.d", "_o.q")

    def fit_group(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("obs")
        p, d, q = int(pdf["p"].iloc[0]), int(pdf["d"].iloc[0]), int(pdf["q"].iloc[0])
        try:
            f = fit_arma(pdf["value"].to_numpy(float), p, d, q)
        except Exception:  # noqa: BLE001 - failed fits are skipped, as in the grid search
            f = None
        aic = f["aic"] if f else float("nan")
        return pd.DataFrame({"series": [pdf["series"].iloc[0]], "p": [p], "d": [d], "q": [q], "aic": [aic]})

    res = pairs.groupBy("series", "p", "d", "q").applyInPandas(
        fit_group, "series string, p int, d int, q int, aic double")
    return res.where(~F.isnan("aic"))


def best_orders(aics: DataFrame) -> DataFrame:
    """T6 step 2: minimum-AIC order per series (ties -> smallest order)."""
    best = aics.groupBy("series").agg(F.min(F.struct("aic", "p", "d", "q")).alias("b"))
    return best.select("series", F.col("b.p").alias("p"), F.col("b.d").alias("d"), F.col("b.q").alias("q"),
                       F.col("b.aic").alias("aic"))


def arima_forecasts(split: DataFrame, orders: DataFrame) -> DataFrame:
    """T6 step 3: fit the chosen order on train, forecast the holdout horizon (one group per series).

    Where no order fits, ``arima`` is NULL.
    """
    data = split.where(F.col("split").isin("train", "holdout")).join(
        orders.select("series", "p", "d", "q"), "series", "left")

    def fc_group(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("obs")
        tr = pdf[pdf["split"] == "train"]["value"].to_numpy(float)
        ho = pdf[pdf["split"] == "holdout"]
        p = pdf["p"].iloc[0]
        order = DEFAULT_ORDER if pd.isna(p) else (int(p), int(pdf["d"].iloc[0]), int(pdf["q"].iloc[0]))
        f = fit_arma(tr, *order)
        vals = list(forecast_arma(tr, f, len(ho))) if f else [None] * len(ho)  # a failed fit forecasts nothing
        return pd.DataFrame({"series": ho["series"].to_numpy(), "trade_date": ho["trade_date"].to_numpy(),
                             "arima": pd.array(vals, dtype="Float64")})

    return data.groupBy("series").applyInPandas(fc_group, "series string, trade_date date, arima double")
