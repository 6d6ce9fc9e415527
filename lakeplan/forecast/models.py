"""Exponential smoothing per series in grouped pandas, after Holt (1957) and Winters (1960).

One group is one weekly series, at most a few hundred rows; Spark shuffles and spreads the series.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

BASELINE_SCHEMA = (
    "series_key string, zone string, week_start date, forecast_units double, "
    "forecast_lower double, forecast_upper double"
)
YEAR = 52


def smooth(y: np.ndarray, alpha: np.ndarray, beta: np.ndarray, gamma: np.ndarray, period: int):
    """Additive exponential smoothing with damped trend, for all parameter sets at once.

    Returns level and trend per set, season [set, period] and one-step errors [set, week].
    """
    damp, sets = 0.95, len(alpha)
    level, trend = np.full(sets, y[:period].mean()), np.zeros(sets)
    season = np.where(gamma[:, None] > 0, y[:period] - y[:period].mean(), 0.0)
    errors = np.empty((sets, len(y)))
    for i, seen in enumerate(y):
        s = i % period
        ahead = level + damp * trend
        errors[:, i] = seen - (ahead + season[:, s])
        new = alpha * (seen - season[:, s]) + (1 - alpha) * ahead
        trend = beta * (new - level) + (1 - beta) * damp * trend
        season[:, s] = gamma * (seen - new) + (1 - gamma) * season[:, s]
        level = new
    return level, trend, season, errors


def smoothing_forecast(y: np.ndarray, steps: int, z: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best of a small parameter set by squared one-step error, with a normal interval."""
    seasonal = len(y) >= 2 * YEAR
    period = YEAR if seasonal else max(1, min(4, len(y)))
    grid = np.array([(a, b, g) for a in (0.05, 0.2, 0.5) for b in (0.0, 0.05) for g in ((0.1, 0.3) if seasonal else (0.0,))])
    level, trend, season, errors = smooth(y, *grid.T, period)
    warm = period if len(y) > period else 0
    best = int(np.argmin(np.square(errors[:, warm:]).sum(axis=1)))
    h = np.arange(1, steps + 1)
    damped = np.cumsum(0.95 ** h)
    mean = level[best] + trend[best] * damped + season[best, (len(y) + h - 1) % period]
    sd = float(np.std(errors[best, warm:])) * np.sqrt(1 + (h - 1) * grid[best, 0] ** 2)
    return mean, mean - z * sd, mean + z * sd


def band_rows(*bands: np.ndarray) -> list[np.ndarray]:
    """Published values: not below zero, to one digit."""
    return [np.round(np.clip(v, 0, None), 1) for v in bands]


def ets_baseline(grid: DataFrame, horizon: int, width: float = 0.8, partitions: int | None = None) -> DataFrame:
    """Second baseline per series with a ``width`` interval, clipped at zero."""
    from statistics import NormalDist

    z = NormalDist().inv_cdf(0.5 + width / 2)

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("week_start")
        mean, lo, hi = smoothing_forecast(pdf["units"].to_numpy(float), horizon, z)
        first = pd.Timestamp(pdf["week_start"].iloc[-1])
        mean, lo, hi = band_rows(mean, lo, hi)
        return pd.DataFrame({
            "series_key": pdf["series_key"].iloc[0], "zone": pdf["zone"].iloc[0],
            "week_start": [(first + pd.Timedelta(weeks=i)).date() for i in range(1, horizon + 1)],
            "forecast_units": mean, "forecast_lower": lo, "forecast_upper": hi,
        })

    n = partitions or grid.sparkSession.sparkContext.defaultParallelism * 3
    keyed = grid.select("series_key", "zone", "week_start", "units")
    return keyed.repartition(n, "series_key", "zone").groupBy("series_key", "zone").applyInPandas(one, BASELINE_SCHEMA)
