"""The forecast stage: grid, models, reconciliation, champion, bands and accuracy."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeplan.config import PlanConfig
from lakeplan.forecast.accuracy import series_accuracy
from lakeplan.forecast.conformal import apply_bands, calibrate
from lakeplan.forecast.grid import (
    SERIES, base_forecasts, rolling_origins, rollup_series, series_arrays, weekly_grid, with_events,
)
from lakeplan.forecast.reconcile import blend, champion, chosen, comparison, top_down, trailing_share, wape_by_candidate
from lakeplan.forecast.structural import fit_series
from lakeplan.operators.joins import lookup
from lakeplan.session import checkpoint_table

BAND_GROUPS = ["category", "zone"]
CHILD_LEVEL, PARENT_LEVEL = "sku x zone x week", "base product x zone x week"


@dataclass
class ForecastTables:
    candidates: DataFrame
    comparison: DataFrame
    forecast: DataFrame
    backtest: DataFrame
    accuracy: DataFrame


def raw_forecasts(both: DataFrame, cfg: PlanConfig) -> DataFrame:
    """Relational base models only: recent mean as the forecast, with the seasonal naive beside it."""
    steps = base_forecasts(rolling_origins(series_arrays(both, SERIES), cfg), SERIES)
    return steps.withColumn("yhat", F.col("recent_mean")).withColumn("model", F.lit("recent_mean"))


def structural_forecasts(weekly: DataFrame, products: DataFrame, events: DataFrame, cfg: PlanConfig) -> DataFrame:
    """The per-series model on child and parent level."""
    grid = weekly_grid(weekly, ["sku_id", "zone"], cfg.last_full_week, cfg.horizon_weeks + 1)
    named = lookup(grid, products.select("sku_id", "base_product"), "sku_id")
    return fit_series(with_events(rollup_series(named, "base_product"), events, apart=True), cfg)


def candidate_table(raw: DataFrame, grid: DataFrame, products: DataFrame, cfg: PlanConfig) -> DataFrame:
    """Direct, top-down and naive forecasts per SKU with every blend.

    ``grid`` is the complete child grid with base_product.
    """
    child = raw.where("level = 'sku'").select(
        F.col("series_key").alias("sku_id"), "zone", "kind", "cutoff", "week_start", "actual",
        F.col("yhat").alias("direct"), F.col("snaive").alias("seasonal_naive"))
    child = lookup(child, products.select("sku_id", "category", "base_product"), "sku_id")
    parent = raw.where("level = 'base'").withColumnRenamed("series_key", "base_product")
    share = trailing_share(child.select("cutoff"), grid, "base_product", cfg.share_weeks)
    return blend(top_down(child, parent, share, "base_product"), cfg.naive_weight)


def plan_from_candidates(cand: DataFrame, products: DataFrame, cfg: PlanConfig) -> ForecastTables:
    """Champion, bands and published tables.  The champion stays inside the plan as a scalar."""
    bt = cand.where("kind = 'backtest'")
    board = comparison(bt, "base_product", CHILD_LEVEL, PARENT_LEVEL)
    winner = champion(wape_by_candidate(bt, CHILD_LEVEL)).select("candidate").scalar()
    scored = cand.withColumn("fc", chosen(winner))
    bands = calibrate(scored.where("kind = 'backtest'"), BAND_GROUPS)
    final = apply_bands(scored, bands, BAND_GROUPS, cfg.band_default)
    units = {
        "forecast_units": "fc", "forecast_lower": "lower", "forecast_upper": "upper",
        "seasonal_naive_units": "seasonal_naive", "direct_units": "direct", "topdown_units": "topdown",
    }
    rounded = [F.round(c, 1).alias(n) for n, c in units.items()]
    forecast = final.where("kind = 'forecast'").select(
        "sku_id", "zone", "week_start", *rounded, winner.alias("model"), F.col("cutoff").alias("trained_through_week"))
    backtest = final.where("kind = 'backtest'").select(
        "sku_id", "zone", "cutoff", "week_start", "actual", *rounded, winner.alias("model"))
    return ForecastTables(cand, board, forecast, backtest, series_accuracy(backtest, products))


def run_forecast(weekly: DataFrame, products: DataFrame, events: DataFrame | None, cfg: PlanConfig,
                 structural: bool = True) -> ForecastTables:
    """All forecast tables.  The weekly input and the candidates are written once, since every output reads them."""
    weekly = checkpoint_table(weekly, "weekly")
    grid = lookup(weekly_grid(weekly, ["sku_id", "zone"], cfg.last_full_week),
                  products.select("sku_id", "base_product"), "sku_id")
    raw = (structural_forecasts(weekly, products, events, cfg) if structural
           else raw_forecasts(rollup_series(grid, "base_product"), cfg))
    raw = checkpoint_table(raw, "forecast_raw")
    cand = checkpoint_table(candidate_table(raw, grid, products, cfg), "candidates")
    return plan_from_candidates(cand, products, cfg)
