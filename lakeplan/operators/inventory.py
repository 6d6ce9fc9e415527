"""Stock positions, ledger and service level."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeplan.functions.columns import mean, money, ratio, week_start
from lakeplan.operators.facts import dec
from lakeplan.operators.joins import lookup, monthly_lookup
from lakeplan.operators.windows import rolling_mean, running_sum

ITEM = ["warehouse_id", "sku_id"]


def ledger(movements: DataFrame, opening: int = 0) -> DataFrame:
    """Opening and closing stock as running balances of recorded movements.

    ``movements`` has one row per item and day with receipts_units and shipped_units, so a
    window group is at most as long as the calendar.
    """
    net = movements.withColumn("_net", F.col("receipts_units") - F.col("shipped_units"))
    return (
        net.withColumn("closing_units", F.lit(opening) + running_sum("_net", ITEM, "snapshot_date"))
        .withColumn("opening_units", F.col("closing_units") - F.col("_net"))
        .drop("_net")
    )


def inventory_daily(snapshots: DataFrame, costs: DataFrame, cover_rows: int = 28) -> DataFrame:
    """Daily position with unfulfilled demand, stockout flags, cover and value."""
    demand = F.nullif(rolling_mean("demand_units", ITEM, "snapshot_date", cover_rows), F.lit(0.0))
    covered = snapshots.withColumn("days_of_cover", F.round(F.col("closing_units") / demand, 1))
    valued = monthly_lookup(covered, costs.select("sku_id", "month", "unit_cost"), ["sku_id"], "snapshot_date")
    return valued.withColumns({
        "unfulfilled_units": F.col("demand_units") - F.col("shipped_units"),
        "is_stockout": F.col("shipped_units") < F.col("demand_units"),
        "below_safety_stock": F.col("closing_units") < F.col("safety_stock_units"),
        "stock_value": money(dec("closing_units", 14, 0) * dec("unit_cost", 12, 2)),
    }).drop("unit_cost")


def inventory_weekly(inv: DataFrame, products: DataFrame) -> DataFrame:
    last = lambda c: F.max_by(c, "snapshot_date")  # noqa: E731  one row per item and day, so no ties
    weekly = (
        inv.groupBy(week_start("snapshot_date").alias("week_start"), *ITEM)
        .agg(F.sum("demand_units").alias("demand_units"), F.sum("shipped_units").alias("shipped_units"),
             F.sum("unfulfilled_units").alias("unfulfilled_units"),
             F.sum(F.col("is_stockout").cast("long")).alias("stockout_days"),
             F.round(mean("days_of_cover", 1), 1).alias("avg_days_of_cover"),
             last("closing_units").alias("closing_units"),
             F.round(last("stock_value"), 2).alias("closing_stock_value"))
        .withColumn("fill_rate", F.round(ratio("shipped_units", "demand_units"), 4))
    )
    return lookup(weekly, products.select("sku_id", "base_product", "category"), "sku_id")


def policy_levels(demand: DataFrame, lead_days: int, review_days: int = 7, z: float = 1.65,
                  rows: int = 28) -> DataFrame:
    """Reorder point and safety stock from the ``rows`` days before each day.

    The first day of an item has no history; its levels are NULL.
    """
    w = Window.partitionBy(*ITEM).orderBy("snapshot_date").rowsBetween(-rows, -1)
    span = float(lead_days + review_days)
    daily = F.greatest(F.avg("demand_units").over(w), F.lit(0.05))
    safety = z * F.stddev_pop("demand_units").over(w) * F.sqrt(F.lit(span))
    return demand.withColumns({
        "safety_stock": F.round(safety, 4),
        "reorder_point": F.round(daily * span + safety, 4),
    })


def weekly_variability(inv: DataFrame, since: str | None = None) -> DataFrame:
    """Mean and sample deviation of weekly demand per item."""
    recent = inv if since is None else inv.where(F.col("snapshot_date") > F.lit(since).cast("date"))
    weekly = recent.groupBy(*ITEM, week_start("snapshot_date").alias("wk")).agg(F.sum("demand_units").alias("demand"))
    return weekly.groupBy(*ITEM).agg(F.stddev_samp("demand").alias("sd_week"), F.avg("demand").alias("avg_week"))
