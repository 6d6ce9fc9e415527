"""Accuracy per series, run summary, model comparison and the run log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeplan.functions.columns import ratio
from lakeplan.operators.joins import lookup
from lakeplan.sources.writers import append_rows


def wape(actual: str, forecast: str):
    return ratio(F.round(F.sum(F.abs(F.col(actual) - F.col(forecast))), 6), F.sum(actual))


def series_accuracy(bt: DataFrame, products: DataFrame) -> DataFrame:
    """WAPE of champion, direct and naive, bias and interval coverage per SKU x zone."""
    inside = F.col("actual").between(F.col("forecast_lower"), F.col("forecast_upper"))
    per_series = bt.groupBy("sku_id", "zone").agg(
        F.max("model").alias("model"),
        F.count(F.lit(1)).alias("backtest_weeks"),
        F.round(F.sum("actual"), 2).alias("actual_units"),
        F.round(wape("actual", "forecast_units"), 4).alias("wape_model"),
        F.round(wape("actual", "direct_units"), 4).alias("wape_direct"),
        F.round(wape("actual", "seasonal_naive_units"), 4).alias("wape_seasonal_naive"),
        F.round(ratio(F.round(F.sum(F.col("forecast_units") - F.col("actual")), 6), F.sum("actual")), 4).alias("bias_model"),
        F.round(F.avg(F.coalesce(inside, F.lit(False)).cast("int")), 3).alias("interval_coverage"),
    )
    return lookup(per_series, products.select("sku_id", "category", "base_product"), "sku_id")


def run_summary(accuracy: DataFrame, bt: DataFrame) -> DataFrame:
    """One row: share of series that beat the naive forecast, and the overall bias."""
    sums = bt.groupBy("sku_id", "zone").agg(F.sum("forecast_units").alias("fc"), F.sum("actual").alias("act"))
    live = accuracy.where("actual_units > 0").join(sums, ["sku_id", "zone"])
    return live.agg(
        F.avg((F.col("wape_model") < F.col("wape_seasonal_naive")).cast("int")).alias("share_beating_naive"),
        ratio(F.round(F.sum(F.col("fc") - F.col("act")), 6), F.sum("act")).alias("bias"),
        F.count(F.lit(1)).alias("series"))


def compare_models(forecast: DataFrame, baseline: DataFrame, keys: list[str]) -> DataFrame:
    """Champion, direct, naive and second baseline side by side."""
    other = baseline.select("sku_id", "zone", "week_start", F.col("forecast_units").alias("_b"))
    return (
        forecast.join(other, ["sku_id", "zone", "week_start"], "left")
        .groupBy(*keys)
        .agg(F.round(F.sum("forecast_units"), 1).alias("champion_units"),
             F.round(F.sum("direct_units"), 1).alias("direct_units"),
             F.round(F.sum("seasonal_naive_units"), 1).alias("seasonal_naive_units"),
             F.round(F.sum("_b"), 1).alias("baseline_units"))
    )


RUN_SCHEMA = "run_name string, logged_at timestamp, params map<string,string>, metrics map<string,double>"


def run_board(board: DataFrame) -> DataFrame:
    """One row: the champion's name, and the WAPE of every candidate at every level."""
    name = F.concat_ws(": ", "level", "candidate")
    return board.agg(F.max(F.when(F.col("is_champion"), F.col("candidate"))).alias("champion"),
                     F.map_from_entries(F.array_sort(F.collect_list(F.struct(name, F.col("wape").cast("double"))))).alias("wapes"))


def log_run(spark: SparkSession, path: str, name: str, params: dict, metrics: DataFrame, board: DataFrame | None = None,
            *more: DataFrame) -> None:
    """Append one row: the parameters and the columns of one-row metrics frames.

    ``board`` (see :func:`run_board`) adds the champion and every candidate's WAPE.
    """
    rows = metrics
    for other in more:
        rows = rows.crossJoin(other)  # one row each
    pairs = [x for c in rows.columns for x in (F.lit(c), F.col(f"`{c}`").cast("double"))]
    settings = [x for k, v in params.items() for x in (F.lit(k), F.lit(str(v)))]
    chosen, measured = F.create_map(*settings), F.create_map(*pairs)
    if board is not None:
        rows = rows.crossJoin(board)
        chosen = F.map_concat(chosen, F.create_map(F.lit("champion"), F.col("champion")))
        measured = F.map_concat(measured, F.col("wapes"))
    append_rows(
        rows.select(F.lit(name).alias("run_name"), F.current_timestamp().alias("logged_at"),
                    chosen.alias("params"), measured.alias("metrics")),
        path)
