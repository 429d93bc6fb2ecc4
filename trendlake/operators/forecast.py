"""Per-category trend models on yearly counts (M1-M6).

Inputs are per-category yearly aggregates (``category, year, repo_count``):
at most (#categories x #years) rows whatever the size of the raw table.
The linear models are closed-form grouped aggregates (``regr_*``): one job,
no per-category loop on the driver.  Only the ARIMA fit (M3) needs Python;
it runs as a grouped ``applyInPandas`` whose groups are one category's yearly
series - bounded by the number of years, never by the number of raw rows.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendlake.functions import band
from trendlake.operators.aggregate import quantile
from trendlake.operators.window import split_last
from trendlake.roles import COUNT_COL, YEAR_COL

COUNT = COUNT_COL

# The grouped ARIMA function is shipped to the Python workers by value (code,
# not a module reference), so executors need numpy and pandas but not this
# package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _linear_fit(yearly: DataFrame, category: str, year: str, count: str) -> DataFrame:
    y = F.col(count).cast("double")
    x = F.col(year).cast("double")
    return yearly.where(F.col(year).isNotNull()).groupBy(category).agg(
        F.count(F.lit(1)).alias("_n"),
        F.regr_slope(y, x).alias("_slope"),
        F.regr_avgx(y, x).alias("_avgx"),
        F.regr_avgy(y, x).alias("_avgy"))


def _predict(at_year: Column) -> Column:
    # avg_y + slope * (x - avg_x): same line as intercept + slope * x, without
    # the cancellation of a large intercept against slope * year.
    return F.col("_avgy") + F.col("_slope") * (at_year.cast("double") - F.col("_avgx"))


def forecast(yearly: DataFrame, category: str, years: Sequence[int] = (2025, 2026),
             min_points: int = 3, year: str = YEAR_COL, count: str = COUNT) -> DataFrame:
    """M1 (+ A14, U2, S11): least-squares line through each category's yearly
    counts (at least ``min_points`` years), evaluated at ``years``, rounded to
    2 digits (may be negative).  Null years are ignored."""
    fit = _linear_fit(yearly, category, year, count).where(F.col("_n") >= min_points)
    future = F.explode(F.array(*[F.lit(int(y)) for y in years]))
    return (fit.select(category, "_slope", "_avgx", "_avgy", future.alias(year))
            .select(category, year, F.round(_predict(F.col(year)), 2).alias("predicted_repo_count")))


def forecast_band(fc: DataFrame, pct: float = 0.1, col: str = "predicted_repo_count") -> DataFrame:
    """M5: ``lower_ci`` / ``upper_ci`` = prediction x (1 -/+ pct), half-even 2 digits."""
    lo, hi = band(F.col(col), pct, 2)
    return fc.withColumns({"lower_ci": lo, "upper_ci": hi})


def growth_anomalies(growth: DataFrame, category: str, q: float = 0.9, n: int = 10,
                     growth_col: str = "growth_rate_pct", year: str = YEAR_COL) -> DataFrame:
    """M6 (+ A16, O5): rows whose growth is strictly above the ``q``-quantile
    of the given (already filtered) growth table; the first ``n`` by growth,
    then category, then year."""
    threshold = quantile(growth, growth_col, q)
    return (growth.where(F.col(growth_col) > threshold)
            .orderBy(F.desc(growth_col), F.asc(category), F.asc(year)).limit(n))


def holdout_linear(yearly: DataFrame, category: str, min_points: int = 4, year: str = YEAR_COL,
                   count: str = COUNT) -> DataFrame:
    """M2 (+ W3, A14): fit the line on all but the last year of each category
    with at least ``min_points`` years, predict the last year.  With a single
    test point MAE = RMSE = |error|, rounded to 4 digits."""
    train, test = split_last(yearly, category, year, min_points)
    fit = _linear_fit(train, category, year, count)
    t = test.select(category, F.col(year).alias("test_year"), F.col(count).cast("double").alias("actual"))
    joined = fit.join(t, on=category, how="inner")
    pred = _predict(F.col("test_year"))
    err = F.round(F.abs(F.col("actual") - pred), 4)
    return joined.select(category, "test_year", "actual", F.round(pred, 4).alias("linear_pred"),
                         err.alias("linear_mae"), err.alias("linear_rmse"))


# --- ARIMA(1,1,1) by conditional sum of squares -----------------------------

_GRID = np.round(np.arange(-0.99, 0.9901, 0.01), 4)


def _css(z: np.ndarray, phi: np.ndarray, theta: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum of squared one-step errors of z_t = phi z_{t-1} + e_t + theta e_{t-1}
    (conditional on z_0 and e_0 = 0) for arrays of (phi, theta); also the last error."""
    e_prev = np.zeros_like(phi)
    sse = np.zeros_like(phi)
    for t in range(1, len(z)):
        e = z[t] - phi * z[t - 1] - theta * e_prev
        sse = sse + e * e
        e_prev = e
    return sse, e_prev


def arima111_next(y: np.ndarray) -> float | None:
    """One-step forecast of ARIMA(1,1,1) without constant, CSS fit.

    Deterministic: full grid over |phi|, |theta| < 1 (step 0.01), then a fine
    grid (step 0.0005) around the best point.  None when the series is too
    short or the fit is not finite (the caller falls back to the line).
    """
    y = np.asarray(y, dtype=float)
    if len(y) < 3 or not np.all(np.isfinite(y)):
        return None
    z = np.diff(y)
    P, T = np.meshgrid(_GRID, _GRID, indexing="ij")
    sse, _ = _css(z, P.ravel(), T.ravel())
    i = int(np.argmin(sse))
    p0, t0 = P.ravel()[i], T.ravel()[i]
    fine = np.arange(-0.01, 0.01001, 0.0005)
    pf = np.clip(p0 + fine, -0.999, 0.999)
    tf = np.clip(t0 + fine, -0.999, 0.999)
    P2, T2 = np.meshgrid(pf, tf, indexing="ij")
    sse2, e_last = _css(z, P2.ravel(), T2.ravel())
    j = int(np.argmin(sse2))
    phi, theta, e_t = P2.ravel()[j], T2.ravel()[j], e_last[j]
    nxt = y[-1] + phi * z[-1] + theta * e_t
    return float(nxt) if np.isfinite(nxt) else None


def _arima_group(category: str, year: str, count: str):
    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(year)
        try:
            pred = arima111_next(pdf[count].to_numpy(dtype=float))
        except Exception:  # noqa: BLE001 - any failure falls back to the line
            pred = None
        return pd.DataFrame({category: [pdf[category].iloc[0]], "arima_pred": [pred]})
    return fn


def model_selection(yearly: DataFrame, category: str, min_points: int = 4, year: str = YEAR_COL,
                    count: str = COUNT) -> DataFrame:
    """M3: hold-out comparison of the line (M2) with ARIMA(1,1,1).

    ARIMA is fitted on the training years of each category in a grouped
    ``applyInPandas``; a failed fit falls back to the linear prediction.
    Errors are rounded to 4 digits and ARIMA is selected only when its
    rounded RMSE is strictly lower; a tie keeps ``LinearTrend``.
    """
    lin = holdout_linear(yearly, category, min_points, year, count)
    train, _ = split_last(yearly, category, year, min_points)
    cat_type = yearly.schema[category].dataType.simpleString()
    arima = (train.select(category, year, count)
             .groupBy(category)
             .applyInPandas(_arima_group(category, year, count),
                            schema=f"`{category}` {cat_type}, arima_pred double"))
    j = lin.join(arima, on=category, how="left")
    # A failed fit takes the linear prediction, hence exactly the linear errors.
    a_err = F.coalesce(F.round(F.abs(F.col("actual") - F.col("arima_pred")), 4), F.col("linear_rmse"))
    out = j.select(category, "linear_mae", "linear_rmse", a_err.alias("arima_mae"),
                   a_err.alias("arima_rmse"))
    return out.withColumn("selected_model", F.when(F.col("arima_rmse") < F.col("linear_rmse"), "ARIMA")
                          .otherwise("LinearTrend"))


def selection_summary(report: DataFrame, digits: int | None = None) -> DataFrame:
    """M4 (A18): mean RMSE of each model over the categories (rounded to
    ``digits``: the last bits of a mean depend on the order of the sum)."""
    mean = lambda c: F.avg(c) if digits is None else F.round(F.avg(c), digits)
    return report.agg(mean("linear_rmse").alias("avg_linear_rmse"), mean("arima_rmse").alias("avg_arima_rmse"))
