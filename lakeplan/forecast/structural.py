"""The structural model for all series of an Arrow batch at once.

The model follows the trend + season + events decomposition of Taylor and Letham (2018), fitted as a ridge regression on
log(1 + y). Spark gathers each series into one row of arrays; a batch of rows becomes padded tensors [series, week, column], and
one stacked solve of the normal equations per origin serves all of them. Weeks after a series' origin are zero rows and columns
that a series does not use are zero columns, so padding changes no coefficient.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeplan.config import PlanConfig
from lakeplan.forecast.grid import SERIES

# The columns of the fitted table.
FIT_SCHEMA = (
    "level string, series_key string, zone string, kind string, cutoff date, week_start date, "
    "actual double, yhat double, snaive double, model string"
)
YEAR = 52
SHORT, SEASONAL_FROM = 26, 60
FOURIER_ORDER, KNOTS = 5, 6
SERIES_AT_ONCE = 64
MONDAY = dt.date(1970, 1, 5)


@dataclass
class Stack:
    """Padded series: values and regressors [series, week], event flags [series, week, name]."""

    first: np.ndarray
    n: np.ndarray
    y: np.ndarray
    promo: np.ndarray
    flags: np.ndarray

    def last_year(self, values: np.ndarray, cut: np.ndarray, steps: int, missing: np.ndarray) -> np.ndarray:
        """Values of the same weeks a year before those that follow ``cut``."""
        at = cut[:, None] + np.arange(steps) - YEAR
        return np.where(at >= 0, np.take_along_axis(values, np.maximum(at, 0), 1), missing[:, None])

    def mean_before(self, cut: np.ndarray, weeks: int) -> np.ndarray:
        week = np.arange(self.y.shape[1])
        inside = (week < cut[:, None]) & (week >= np.maximum(cut - weeks, 0)[:, None])
        return (self.y * inside).sum(1) / inside.sum(1)


def stacked(first: list[dt.date], values: list[list], promos: list[list], events: list[list[list[str]]], ahead: int) -> Stack:
    """``ahead`` weeks fit behind the last value of every series; flags of weeks that the table lacks are zero."""
    n = np.array([sum(v is not None for v in y) for y in values])
    width = max(int(n.max()) + ahead, max(map(len, values)))
    y, promo = np.zeros((len(values), width)), np.zeros((len(values), width))
    names = [sorted({e for week in weeks[:k] for e in week}) for weeks, k in zip(events, n.tolist(), strict=True)]
    flags = np.zeros((len(values), width, max(map(len, names), default=0)))
    for i, (v, p, weeks) in enumerate(zip(values, promos, events, strict=True)):
        y[i, :n[i]] = v[:n[i]]
        promo[i, :len(p)] = [x or 0.0 for x in p]
        known = {e: k for k, e in enumerate(names[i])}
        for w, acting in enumerate(weeks):
            for e in acting:
                if e in known:
                    flags[i, w, known[e]] = 1.0
    return Stack(np.array([(d - MONDAY).days // 7 for d in first]), n, y, promo, flags)


def design(s: Stack, cut: np.ndarray, steps: int) -> tuple[np.ndarray, np.ndarray]:
    """Columns [series, week, column] up to ``steps`` after each origin, and their penalties."""
    week = np.arange(s.y.shape[1])
    within = week < (cut + steps)[:, None]
    t = week / YEAR
    knots = np.linspace(0, t[cut - 1] * 0.8, KNOTS + 1, axis=1)[:, 1:]
    trend = np.broadcast_to(t[None, :, None], (*within.shape, 1))
    angle = 2 * np.pi * ((s.first[:, None] + week) * 7 / 365.25)[..., None] * np.arange(1, FOURIER_ORDER + 1)
    season = np.concatenate([np.sin(angle), np.cos(angle)], 2) * (cut >= SEASONAL_FROM)[:, None, None]
    ahead = np.zeros_like(s.promo)
    future = s.last_year(s.promo, cut, steps, np.zeros(len(cut)))
    np.put_along_axis(ahead, cut[:, None] + np.arange(steps), future, 1)
    promo = np.where(week < cut[:, None], s.promo, ahead)[..., None]
    blocks = [(np.ones_like(trend), 1e-6), (trend, 0.01), (np.maximum(t[None, :, None] - knots[:, None, :], 0), 4.0),
              (season, 0.3), (promo, 0.5), (s.flags, 1.0)]
    x = np.concatenate([b for b, _ in blocks], 2) * within[..., None]
    return x, np.concatenate([np.full(b.shape[2], p) for b, p in blocks])


def forecasts(s: Stack, cut: np.ndarray, steps: int) -> np.ndarray:
    """Fit every series on its first ``cut`` weeks, predict the next ``steps``: [series, step]."""
    x, penalty = design(s, cut, steps)
    past = np.arange(s.y.shape[1]) < cut[:, None]
    train, target = x * past[..., None], np.log1p(s.y) * past
    across = train.transpose(0, 2, 1)
    coef = np.linalg.solve(across @ train + np.diag(penalty), across @ target[..., None])
    fitted = (x @ coef)[..., 0]
    smear = (np.exp(target - fitted) * past).sum(1) / cut
    # the log-scale trend must not run away beyond what the series has ever shown
    most = np.where(past, target, -np.inf).max(1) + 1.0
    ahead = np.take_along_axis(fitted, cut[:, None] + np.arange(steps), 1)
    return np.clip(np.exp(np.minimum(ahead, most[:, None])) * smear[:, None] - 1.0, 0.0, None)


def origin_forecasts(s: Stack, cfg: PlanConfig) -> Iterator[tuple]:
    """(kind, series, cut, steps, yhat, snaive, structural) of every origin that has series."""
    h = cfg.horizon_weeks
    for k in range(cfg.folds, -1, -1):
        cut, steps = s.n - k * h, h if k else h + 1
        able = np.flatnonzero(cut >= (cfg.min_train_weeks if k else 1))
        if len(able):
            part = Stack(s.first[able], s.n[able], s.y[able], s.promo[able], s.flags[able])
            cut = cut[able]
            total = (part.y * (np.arange(part.y.shape[1]) < cut[:, None])).sum(1)
            plain = (cut < SHORT) | (total == 0)
            yhat = np.repeat(part.mean_before(cut, 8)[:, None], steps, 1)
            if not plain.all():
                some = np.flatnonzero(~plain)
                yhat[some] = forecasts(Stack(part.first[some], part.n[some], part.y[some], part.promo[some], part.flags[some]), cut[some], steps)
            naive = part.last_year(part.y, cut, steps, part.mean_before(cut, 4))
            yield "backtest" if k else "forecast", able, cut, steps, yhat, naive, ~plain


def series_rows(grid: DataFrame) -> DataFrame:
    """One row per series: its first week and its weeks in order, at most as many as the calendar has."""
    weeks = F.array_sort(F.collect_list(F.struct("week_start", "units", "promo_share", "events")))
    return grid.groupBy(*SERIES).agg(weeks.alias("weeks")).select(
        *SERIES, F.col("weeks")[0]["week_start"].alias("first"), F.col("weeks.units").alias("y"), F.col("weeks.promo_share").alias("promo"),
        F.col("weeks.events").alias("events"))


def fit_series(grid: DataFrame, cfg: PlanConfig, partitions: int | None = None) -> DataFrame:
    """Backtests and forecast of every series.

    ``grid`` has the series keys, week_start, units (NULL in the future), promo_share and events, one row per week of a
    series' span. The explicit partition count keeps small data from being coalesced into few Python workers.
    """
    def run(batches):
        for batch in batches:
            for start in range(0, len(batch), SERIES_AT_ONCE):
                yield from solved(batch.slice(start, SERIES_AT_ONCE), cfg)

    n = partitions or grid.sparkSession.sparkContext.defaultParallelism * 3
    return series_rows(grid.repartition(n, *SERIES)).mapInArrow(run, FIT_SCHEMA)


def solved(batch: pa.RecordBatch, cfg: PlanConfig) -> Iterator[pa.RecordBatch]:
    keys, first = [batch.column(i) for i in range(len(SERIES))], batch.column(3).to_pylist()
    s = stacked(first, *(batch.column(i).to_pylist() for i in (4, 5, 6)), cfg.horizon_weeks + 1)
    for kind, able, cut, steps, yhat, naive, fitted in origin_forecasts(s, cfg):
        rows, step = np.repeat(able, steps), np.tile(np.arange(steps), len(able))
        at = np.repeat(cut, steps)
        start = np.array(first, dtype="datetime64[D]")[rows]
        actual = s.y[rows, at + step] if kind == "backtest" else None
        columns = [k.take(pa.array(rows)) for k in keys] + [
            pa.array([kind] * len(rows)), pa.array(start + 7 * (at - 1)), pa.array(start + 7 * (at + step)),
            pa.nulls(len(rows), pa.float64()) if actual is None else pa.array(actual), pa.array(yhat.ravel()), pa.array(naive.ravel()),
            pa.array(np.where(np.repeat(fitted, steps), "structural", "recent_mean"))]
        yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in FIT_SCHEMA.split(", ")])
