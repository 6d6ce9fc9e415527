"""Complete weekly series, their parents, and the rolling-origin folds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeplan.config import PlanConfig
from lakeplan.functions.calendar import spine_of
from lakeplan.functions.columns import week_start
from lakeplan.operators.joins import broadcast_if_small

SERIES = ["level", "series_key", "zone"]


def weekly_grid(weekly: DataFrame, keys: list[str], last_week: str, future_weeks: int = 0) -> DataFrame:
    """Every Monday from a series' first sale to ``last_week``, zeros in the gaps.

    ``future_weeks`` further rows per series carry NULL units.  Each series spans its own
    range, so no calendar is crossed with the keys.
    """
    last = F.lit(last_week).cast("date")
    known = weekly.where(F.col("week_start") <= last)
    spans = known.groupBy(*keys).agg(F.min("week_start").alias("_first"))
    spans = spans.withColumn("_last", F.date_add(last, 7 * future_weeks))
    grid = spine_of(spans, "_first", "_last", "7 DAY", "week_start").drop("_first", "_last")
    filled = grid.join(known.select(*keys, "week_start", "units", "promo_share"), [*keys, "week_start"], "left")
    past = F.col("week_start") <= last
    return filled.withColumns({
        "units": F.when(past, F.coalesce(F.col("units").cast("double"), F.lit(0.0))),
        "promo_share": F.when(past, F.coalesce(F.col("promo_share"), F.lit(0.0))),
    })


def rollup_series(grid: DataFrame, parent: str, child: str = "sku_id") -> DataFrame:
    """Child and parent series in one long table with a ``level`` column."""
    children = grid.select(F.lit("sku").alias("level"), F.col(child).alias("series_key"), "zone", "week_start",
                           "units", "promo_share")
    parents = (
        grid.groupBy(parent, "zone", "week_start")
        .agg(F.sum("units").alias("units"), F.avg("promo_share").alias("promo_share"))
        .select(F.lit("base").alias("level"), F.col(parent).alias("series_key"), "zone", "week_start", "units",
                "promo_share")
    )
    return children.unionByName(parents)


def event_weeks(events: DataFrame, apart: bool = False, name: str = "event_name", day: str = "event_date") -> DataFrame:
    """Weeks an event acts on: its own and the one before, under a name of its own with ``apart``."""
    ahead = F.concat(F.col(name), F.lit(" (week before)")) if apart else F.col(name)
    both = F.array(F.struct(F.col(name).alias("event_name"), week_start(day).alias("week_start")),
                   F.struct(ahead.alias("event_name"), F.date_sub(week_start(day), 7).alias("week_start")))
    return events.select(F.inline(both)).distinct()


def with_events(grid: DataFrame, events: DataFrame, apart: bool = False) -> DataFrame:
    """Add the sorted list of event names acting on each week.

    ``apart`` gives the week before an event a name of its own, so that a model can weigh it differently.
    """
    names = event_weeks(events, apart).groupBy("week_start").agg(F.array_sort(F.collect_set("event_name")).alias("events"))
    return grid.join(broadcast_if_small(names), "week_start", "left").withColumn(
        "events", F.coalesce("events", F.array().cast("array<string>")))


def series_arrays(grid: DataFrame, keys: list[str]) -> DataFrame:
    """One row per series with its values in week order.

    A complete grid has one row per week, so an array is as long as the calendar.
    """
    rows = F.array_sort(F.collect_list(F.struct("week_start", "units", "promo_share")))
    return (
        grid.where(F.col("units").isNotNull()).groupBy(*keys).agg(rows.alias("_r"))
        .select(*keys, F.col("_r")[0]["week_start"].alias("first_week"), F.size("_r").alias("n"),
                F.col("_r")["units"].alias("y"), F.col("_r")["promo_share"].alias("promo"))
    )


def rolling_origins(series: DataFrame, cfg: PlanConfig, with_future: bool = True) -> DataFrame:
    """Backtest origins (k = folds..1, cut = n - k x horizon, at least the minimum history) and the forecast origin."""
    h = cfg.horizon_weeks
    past = [
        F.struct(F.lit("backtest").alias("kind"), (F.col("n") - k * h).alias("cut"), F.lit(h).alias("steps"))
        for k in range(cfg.folds, 0, -1)
    ]
    future = [F.struct(F.lit("forecast").alias("kind"), F.col("n").alias("cut"), F.lit(h + 1).alias("steps"))]
    origins = F.array(*(past + (future if with_future else [])))
    enough = F.filter(origins, lambda o: (o["kind"] == "forecast") | (o["cut"] >= cfg.min_train_weeks))
    return (
        series.select("*", F.inline(enough))
        .withColumn("cutoff", F.expr("date_add(first_week, 7 * (cut - 1))"))
    )


def tail_mean(n: int):
    """Mean of the last ``n`` training values (fewer if the history is shorter)."""
    return F.expr(
        f"aggregate(slice(y, greatest(cut - {n} + 1, 1), least({n}, cut)), 0D, (a, x) -> a + x) / least({n}, cut)")


def base_forecasts(origins: DataFrame, keys: list[str], short: int = 26) -> DataFrame:
    """Seasonal naive, recent mean and the future promo regressor for every step ahead.

    Naive is the value 52 weeks earlier, else the mean of the last four; the promo share is
    that of the same week last year, else zero.
    """
    prepared = origins.withColumns({
        "_m4": tail_mean(4),
        "recent_mean": tail_mean(8),
        "is_short": F.expr(f"cut < {short} OR aggregate(slice(y, 1, cut), 0D, (a, x) -> a + x) = 0"),
    })
    steps = prepared.withColumn("step", F.explode(F.sequence(F.lit(1), F.col("steps"))))
    at = lambda arr, i: f"CASE WHEN {i} >= 1 THEN element_at({arr}, {i}) END"
    return steps.select(
        *keys, "kind", "cutoff",
        F.expr("date_add(cutoff, 7 * step)").alias("week_start"),
        F.expr("CASE WHEN kind = 'backtest' THEN element_at(y, cut + step) END").alias("actual"),
        F.coalesce(F.expr(at("y", "(cut + step - 52)")), F.col("_m4")).alias("snaive"),
        "recent_mean", "is_short",
        F.coalesce(F.expr(at("promo", "(cut + step - 52)")), F.lit(0.0)).alias("promo_future"),
    )
