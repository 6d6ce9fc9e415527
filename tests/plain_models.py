"""The structural model one series at a time, as a plain check of the batched one."""

import numpy as np
import pandas as pd

from lakeplan.forecast.grid import SERIES
from lakeplan.forecast.structural import FOURIER_ORDER, KNOTS, SEASONAL_FROM, SHORT, YEAR


def season_columns(week_no: np.ndarray) -> np.ndarray:
    angle = 2 * np.pi * np.outer(week_no * 7 / 365.25, np.arange(1, FOURIER_ORDER + 1))
    return np.hstack([np.sin(angle), np.cos(angle)])


def structural_forecast(y: np.ndarray, promo: np.ndarray, events: np.ndarray, week_no: np.ndarray, cut: int,
                        steps: int, promo_ahead: np.ndarray) -> np.ndarray:
    """Fit on the first ``cut`` weeks, predict the next ``steps``."""
    rows = slice(0, cut + steps)
    t = np.arange(cut + steps) / YEAR
    knots = np.linspace(0, t[cut - 1] * 0.8, KNOTS + 1)[1:]
    blocks = [(np.ones((len(t), 1)), 1e-6), (t[:, None], 0.01), (np.maximum(t[:, None] - knots, 0), 4.0)]
    if cut >= SEASONAL_FROM:
        blocks.append((season_columns(week_no[rows]), 0.3))
    blocks.append((np.concatenate([promo[:cut], promo_ahead])[:, None], 0.5))
    if events.shape[1]:
        blocks.append((events[rows], 1.0))
    x = np.hstack([b for b, _ in blocks])
    penalty = np.concatenate([np.full(b.shape[1], p) for b, p in blocks])
    target = np.log1p(y[:cut])
    train = x[:cut]
    coef = np.linalg.solve(train.T @ train + np.diag(penalty), train.T @ target)
    smear = np.mean(np.exp(target - train @ coef))
    # the log-scale trend must not run away beyond what the series has ever shown
    ahead = np.minimum(x[cut:] @ coef, target.max() + 1.0)
    return np.clip(np.exp(ahead) * smear - 1.0, 0.0, None)


def seasonal_naive(y: np.ndarray, cut: int, steps: int) -> np.ndarray:
    i = cut + np.arange(steps) - YEAR
    fallback = y[max(cut - 4, 0):cut].mean()
    return np.where(i >= 0, y[np.maximum(i, 0)], fallback)


def last_year(promo: np.ndarray, cut: int, steps: int) -> np.ndarray:
    i = cut + np.arange(steps) - YEAR
    return np.where(i >= 0, promo[np.maximum(i, 0)], 0.0)


def series_forecaster(cfg):
    def forecast_one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("week_start")
        dates = pd.to_datetime(pdf["week_start"])
        y = pdf["units"].to_numpy(float)
        n = int(np.isfinite(y).sum())
        promo = np.nan_to_num(pdf["promo_share"].to_numpy(float))
        lists = [list(e) for e in pdf["events"]]
        names = sorted({e for past in lists[:n] for e in past})
        flags = np.array([[float(e in row) for e in names] for row in lists]).reshape(len(lists), len(names))
        week_no = ((dates - pd.Timestamp("1970-01-05")).dt.days // 7).to_numpy()
        origins = [("backtest", n - k * cfg.horizon_weeks, cfg.horizon_weeks) for k in range(cfg.folds, 0, -1)]
        origins = [o for o in origins if o[1] >= cfg.min_train_weeks] + [("forecast", n, len(y) - n)]
        parts = []
        for kind, cut, steps in origins:
            if cut < SHORT or y[:cut].sum() == 0:
                yhat, model = np.full(steps, y[max(cut - 8, 0):cut].mean()), "recent_mean"
            else:
                yhat = structural_forecast(y, promo, flags, week_no, cut, steps, last_year(promo, cut, steps))
                model = "structural"
            parts.append(pd.DataFrame({
                "kind": kind, "cutoff": dates.iloc[cut - 1].date(),
                "week_start": dates.iloc[cut:cut + steps].dt.date.to_numpy(),
                "actual": y[cut:cut + steps] if kind == "backtest" else np.nan,
                "yhat": yhat, "snaive": seasonal_naive(y, cut, steps), "model": model,
            }))
        out = pd.concat(parts, ignore_index=True)
        for c in reversed(SERIES):
            out.insert(0, c, pdf[c].iloc[0])
        return out

    return forecast_one
