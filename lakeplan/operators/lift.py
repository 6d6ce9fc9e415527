"""Lift of an event window over a baseline window."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeplan.functions.columns import avg_if, ratio, sum_if
from lakeplan.operators.joins import event_window_join


def promotion_lift(promos: DataFrame, daily: DataFrame, base_days: int = 28, as_of: str | None = None) -> DataFrame:
    """Mean daily revenue in the promotion against the days before it in the same channel.

    ``daily`` has order_date, channel_code, net_revenue, discount_amount at any finer grain.
    Means run over days that have rows.
    """
    per_day = daily.groupBy("order_date", "channel_code").agg(
        F.sum("net_revenue").alias("rev"), F.sum("discount_amount").alias("disc"))
    live = promos if as_of is None else promos.where(F.col("start_date") <= F.lit(as_of).cast("date"))
    joined = event_window_join(live, per_day, "start_date", "end_date", base_days, ["channel_code"])
    in_promo = F.col("order_date") >= F.col("start_date")
    keys = ["promo_id", "promo_code", "promo_name", "promo_type", "channel_code", "category_scope",
            "event_name", "discount_pct", "start_date", "end_date"]
    return (
        joined.groupBy(*keys)
        .agg(avg_if(in_promo, "rev").alias("_p"), avg_if(~in_promo, "rev").alias("_b"),
             sum_if(in_promo, "disc").alias("_d"))
        .select(
            *keys,
            F.round("_p", 2).alias("promo_daily_revenue"),
            F.round("_b", 2).alias("baseline_daily_revenue"),
            F.round("_d", 2).alias("discount_cost"),
            F.round(100 * (ratio("_p", "_b") - 1), 1).alias("revenue_lift_pct"),
        )
    )


def event_uplift(events: DataFrame, daily: DataFrame, dims: list[str], window: int = 10,
                 base: tuple[int, int] = (60, 31), between: tuple[str, str] | None = None) -> DataFrame:
    """Daily revenue of the ``window`` days ending on the event against days -60..-31.

    Both sums are divided by the fixed number of days, also where days have no rows.
    """
    per_day = daily.groupBy("order_date", *dims).agg(F.sum("net_revenue").alias("rev"))
    if between:
        lo, hi = (F.lit(d).cast("date") for d in between)
        events = events.where(F.col("event_date").between(lo, hi))
    joined = event_window_join(events, per_day, "event_date", "event_date", base[0], [])
    back = F.date_diff(F.col("event_date"), F.col("order_date"))
    keys = ["event_name", "event_date", "year", "region_relevance", *dims]
    base_days = base[0] - base[1] + 1
    return (
        joined.groupBy(*keys)
        .agg((F.round(sum_if(back < window, "rev"), 2) / window).alias("_e"),
             (F.round(sum_if(back.between(base[1], base[0]), "rev"), 2) / base_days).alias("_b"))
        .select(
            *keys,
            F.round("_e", 2).alias("event_daily_revenue"),
            F.round("_b", 2).alias("baseline_daily_revenue"),
            F.round(100 * (ratio("_e", "_b") - 1), 1).alias("uplift_pct"),
        )
    )
