"""Warehouse x SKU reorder recommendations from the zone forecast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeplan.config import PlanConfig
from lakeplan.functions.columns import band, mean, sum_if
from lakeplan.operators.aggregates import DELIVERED
from lakeplan.operators.inventory import ITEM, weekly_variability
from lakeplan.operators.joins import lookup
from lakeplan.operators.windows import share_of


def d(text: str):
    return F.lit(text).cast("date")


def warehouse_share(fact: DataFrame, as_of: str, days: int = 84) -> DataFrame:
    """Share of each warehouse in a zone's recent demand for a SKU."""
    recent = fact.where(DELIVERED).where(F.col("order_date") > F.date_sub(d(as_of), days))
    units = recent.groupBy("zone", *ITEM).agg(F.sum("quantity").alias("units"))
    return share_of(units, "units", ["zone", "sku_id"])


def allocate(forecast: DataFrame, share: DataFrame, first_week: str) -> DataFrame:
    """Zone forecast split over the warehouses that serve the zone."""
    ahead = forecast.where(F.col("week_start") >= d(first_week))
    return (
        ahead.join(share.select("zone", *ITEM, "share"), ["zone", "sku_id"])
        .groupBy(*ITEM, "week_start")
        .agg(F.round(F.sum(F.col("forecast_units") * F.col("share")), 6).alias("fc_units"),
             F.round(F.sum(F.col("forecast_upper") * F.col("share")), 6).alias("fc_upper"))
    )


def horizon_sums(allocated: DataFrame, first_week: str) -> DataFrame:
    """Four- and twelve-week demand and the weekly mean over the whole horizon.

    ``weekly`` is the item's own horizon as a list: a dozen entries.
    """
    before = lambda days: F.col("week_start") < F.date_add(d(first_week), days)
    return allocated.groupBy(*ITEM).agg(
        F.round(sum_if(before(28), "fc_units"), 6).alias("fc_next_4w"),
        F.round(sum_if(before(84), "fc_units"), 6).alias("fc_next_12w"),
        mean("fc_units").alias("fc_avg_week"),
        F.sort_array(F.collect_list(F.struct("week_start", "fc_units"))).alias("weekly"),
    )


def stock_on_hand(inv: DataFrame, as_of: str, latest: bool = False) -> DataFrame:
    """Closing stock on the as-of day, or with ``latest`` the last position up to it."""
    if not latest:
        return inv.where(F.col("snapshot_date") == d(as_of)).select(
            *ITEM, F.col("closing_units").alias("on_hand_units"), "stock_value")
    return inv.where(F.col("snapshot_date") <= d(as_of)).groupBy(*ITEM).agg(
        F.max_by("closing_units", "snapshot_date").alias("on_hand_units"),
        F.max_by("stock_value", "snapshot_date").alias("stock_value"))


def open_orders(pos: DataFrame, as_of: str) -> DataFrame:
    pending = pos.where(F.col("received_date").isNull() | (F.col("received_date") > d(as_of)))
    return pending.groupBy(*ITEM).agg(F.sum("ordered_units").alias("open_po_units"),
                                      F.min("expected_date").alias("next_po_eta"))


def lead_times(pos: DataFrame, as_of: str, default_days: int = 14, days: int = 365) -> DataFrame:
    recent = pos.where(F.col("po_date") > F.date_sub(d(as_of), days))
    days_mean = F.avg(F.coalesce(F.col("actual_lead_days"), F.lit(default_days)))
    return recent.groupBy(*ITEM).agg(F.greatest(F.lit(1.0), F.round(days_mean / 7, 1)).alias("lead_time_weeks"))


def reorder(horizon: DataFrame, stock: DataFrame, open_po: DataFrame, variability: DataFrame, leads: DataFrame,
            products: DataFrame, warehouses: DataFrame, cfg: PlanConfig) -> DataFrame:
    """Order quantity, safety stock, cover and stockout risk per item.

    A mean weekly forecast of zero gives no cover; both risk comparisons then fail and the
    risk is Low.
    """
    wide = (
        lookup(horizon.drop("weekly"), products.select(
            "sku_id", "product_name", "base_product", "category", "mrp", "tax_rate"), "sku_id")
    )
    wide = lookup(wide, warehouses.select("warehouse_id", "warehouse_name"), "warehouse_id")
    for part in (stock.select(*ITEM, "on_hand_units"), open_po, variability.select(*ITEM, "sd_week"), leads):
        wide = wide.join(part, ITEM, "left")
    on_hand = F.coalesce(F.col("on_hand_units"), F.lit(0))
    pending = F.coalesce(F.col("open_po_units"), F.lit(0))
    lead = F.coalesce(F.col("lead_time_weeks"), F.lit(cfg.default_lead_weeks))
    weekly = F.col("fc_avg_week")
    safety = cfg.service_z * F.coalesce(F.col("sd_week"), F.lit(0.0)) * F.sqrt(lead)
    cover = on_hand / F.nullif(weekly, F.lit(0.0))
    need = weekly * (lead + cfg.review_weeks) + safety - on_hand - pending
    return wide.select(
        *ITEM, "warehouse_name", "product_name", "base_product", "category",
        on_hand.cast("long").alias("on_hand_units"),
        pending.cast("long").alias("open_po_units"),
        "next_po_eta",
        F.round("fc_next_4w", 0).alias("forecast_next_4w_units"),
        F.round("fc_next_12w", 0).alias("forecast_next_12w_units"),
        lead.alias("lead_time_weeks"),
        F.round(safety, 0).alias("safety_stock_units"),
        F.round(cover, 1).alias("weeks_of_cover"),
        F.greatest(F.lit(0.0), F.round(need, 0)).alias("recommended_order_units"),
        band([(cover < lead, "High"), (cover < lead + 2, "Medium")], "Low").alias("stockout_risk"),
        F.date_add(d(cfg.as_of), (7 * cover).try_cast("int")).alias("projected_stockout_date"),
        F.round(F.col("fc_next_4w") * F.col("mrp") * cfg.price_factor / (1 + F.col("tax_rate").cast("double")), 0)
        .alias("forecast_revenue_4w"),
        d(cfg.as_of).alias("as_of_date"),
    )


def reorder_plan(forecast: DataFrame, fact: DataFrame, inv: DataFrame, pos: DataFrame, products: DataFrame,
                 warehouses: DataFrame, cfg: PlanConfig, first_week: str, latest_stock: bool = False) -> DataFrame:
    """The whole recommendation from forecast, sales, stock and purchase orders."""
    allocated = allocate(forecast, warehouse_share(fact, cfg.as_of), first_week)
    recent = inv.where(F.col("snapshot_date") > F.date_sub(d(cfg.as_of), 84))
    return reorder(
        horizon_sums(allocated, first_week),
        stock_on_hand(inv, cfg.as_of, latest_stock),
        open_orders(pos, cfg.as_of),
        weekly_variability(recent),
        lead_times(pos, cfg.as_of, cfg.default_lead_days),
        products, warehouses, cfg,
    )


def risk_distribution(recommendations: DataFrame) -> DataFrame:
    return recommendations.groupBy("stockout_risk").agg(F.count(F.lit(1)).alias("n"))
