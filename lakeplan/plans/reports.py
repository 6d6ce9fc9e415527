"""Report queries over the gold tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeplan.forecast.accuracy import compare_models
from lakeplan.functions.columns import ratio, sum_if
from lakeplan.operators.decisions import planner_view
from lakeplan.operators.filters import apply_filters
from lakeplan.operators.joins import lookup
from lakeplan.operators.metrics import Field, MetricView
from lakeplan.operators.quality import outcome, union_all

SALES_SUMS = {"net_revenue": 2, "gross_margin": 2, "units": 0, "volume_kg": 2, "discount_amount": 2,
              "promo_revenue": 2, "lines": 0, "returned_lines": 0}


def sums(columns: dict[str, int]) -> list[Column]:
    return [(F.round(F.sum(c), n) if n else F.sum(c)).alias(c) for c, n in columns.items()]


def between(df: DataFrame, column: str, lo: str, hi: str) -> DataFrame:
    return df.where(F.col(column).between(F.lit(lo).cast("date"), F.lit(hi).cast("date")))


def sales(daily: DataFrame, dim_date: DataFrame) -> DataFrame:
    calendar = dim_date.select(F.col("date").alias("order_date"), "fiscal_year", "month_start", "season")
    keys = ["order_date", "zone", "channel_name", "channel_group", "category", "base_product"]
    return lookup(daily.groupBy(*keys).agg(*sums(SALES_SUMS)), calendar, "order_date")


def sales_kpis(report: DataFrame) -> MetricView:
    """Calculated measures on the sales report."""
    dims = ["order_date", "fiscal_year", "month_start", "season", "zone", "channel_name", "channel_group", "category",
            "base_product"]
    return MetricView(report, [Field(d, f"source.{d}") for d in dims], [
        Field("total_net_revenue", "sum(source.net_revenue)"),
        Field("gross_margin_share", "sum(source.gross_margin) / nullif(sum(source.net_revenue), 0)"),
        Field("volume_tonnes", "round(sum(source.volume_kg), 2) / 1000"),
        Field("promo_share", "sum(source.promo_revenue) / nullif(sum(source.net_revenue), 0)"),
        Field("return_rate", "sum(source.returned_lines) / nullif(sum(source.lines), 0)"),
    ])


def orders(fact_orders: DataFrame, channels: DataFrame) -> DataFrame:
    counted = fact_orders.where("order_status = 'Delivered'").groupBy("order_date", "zone", "channel_code").agg(
        F.count(F.lit(1)).alias("orders"), F.round(F.sum("net_revenue"), 2).alias("net_revenue"))
    return lookup(counted, channels.select("channel_code", "channel_name", "channel_group"), "channel_code").drop(
        "channel_code")


def orders_kpis(report: DataFrame) -> MetricView:
    dims = ["order_date", "zone", "channel_name", "channel_group"]
    return MetricView(report, [Field(d, f"source.{d}") for d in dims], [
        Field("total_orders", "sum(source.orders)"),
        Field("aov", "round(sum(source.net_revenue), 2) / nullif(sum(source.orders), 0)"),
    ])


def state_centroid(geography: DataFrame) -> DataFrame:
    return geography.groupBy("state").agg(F.round(F.avg("lat"), 6).alias("lat"), F.round(F.avg("lon"), 6).alias("lon"))


def state_map(monthly: DataFrame, channels: DataFrame, geography: DataFrame) -> DataFrame:
    totals = monthly.groupBy("month", "state", "zone", "channel_code", "category").agg(
        F.round(F.sum("net_revenue"), 2).alias("net_revenue"), F.round(F.sum("gross_margin"), 2).alias("gross_margin"))
    named = lookup(totals, channels.select("channel_code", "channel_name"), "channel_code").drop("channel_code")
    return lookup(named, state_centroid(geography), "state").withColumnRenamed("month", "order_date")


def event_rows(uplift: DataFrame, min_base: float = 20000) -> DataFrame:
    return uplift.where(F.col("baseline_daily_revenue") > min_base).select(
        "event_name", "event_date", "year", "zone", "base_product", "category", "event_daily_revenue",
        "baseline_daily_revenue", (F.col("uplift_pct") / 100).alias("uplift"))


def event_daily(daily: DataFrame, lo: str, hi: str) -> DataFrame:
    return between(daily, "order_date", lo, hi).groupBy("order_date", "zone").agg(*sums({"net_revenue": 2}))


def promo(effect: DataFrame, channels: DataFrame) -> DataFrame:
    named = lookup(effect.where("baseline_daily_revenue IS NOT NULL"),
                   channels.select("channel_code", "channel_name"), "channel_code")
    return named.select("promo_code", "promo_name", "promo_type", "channel_name", "category_scope", "event_name",
                        "discount_pct", "start_date", "promo_daily_revenue", "baseline_daily_revenue",
                        "discount_cost", (F.col("revenue_lift_pct") / 100).alias("revenue_lift"))


def actual_forecast(weekly: DataFrame, forecast: DataFrame, products: DataFrame, lo: str, last: str) -> DataFrame:
    """Actuals, one bridge row at the last actual week, and the forecast with its band."""
    cat = products.select("sku_id", "category")
    keys = ["week_start", "zone", "category"]
    none = F.lit(None).cast("double")
    act = lookup(between(weekly, "week_start", lo, last), cat, "sku_id").groupBy(*keys).agg(
        F.sum("units").cast("double").alias("actual_units"))
    fc = lookup(forecast, cat, "sku_id").groupBy(*keys).agg(
        *[F.round(F.sum(c), 1).alias(c) for c in ("forecast_units", "forecast_lower", "forecast_upper")])
    cols = ["forecast_units", "forecast_lower", "forecast_upper"]
    bridge = act.where(F.col("week_start") == F.lit(last).cast("date"))
    return union_all([
        act.select(*keys, "actual_units", *[none.alias(c) for c in cols]),
        bridge.select(*keys, "actual_units", *[F.col("actual_units").alias(c) for c in cols]),
        fc.select(*keys, none.alias("actual_units"), *cols),
    ])


def model_compare(forecast: DataFrame, baseline: DataFrame, products: DataFrame) -> DataFrame:
    named = lookup(forecast, products.select("sku_id", "category"), "sku_id")
    return compare_models(named, baseline, ["week_start", "zone", "category"])


def accuracy_rows(accuracy: DataFrame) -> DataFrame:
    """Series accuracy with its error mass, so any grouping can be re-weighted."""
    u = F.col("actual_units")
    return accuracy.where("actual_units > 0").withColumns({
        "abs_err_model": F.round(F.col("wape_model") * u, 4),
        "abs_err_direct": F.round(F.col("wape_direct") * u, 4),
        "abs_err_snaive": F.round(F.col("wape_seasonal_naive") * u, 4),
        "covered_weeks": F.round(F.col("interval_coverage") * F.col("backtest_weeks"), 4),
    })


def accuracy_kpis(rows: DataFrame) -> MetricView:
    dims = ["zone", "category", "base_product", "sku_id"]
    return MetricView(rows, [Field(d, f"source.{d}") for d in dims], [
        Field("total_wape_model", "round(sum(source.abs_err_model), 4) / nullif(sum(source.actual_units), 0)"),
        Field("total_wape_direct", "round(sum(source.abs_err_direct), 4) / nullif(sum(source.actual_units), 0)"),
        Field("total_wape_naive", "round(sum(source.abs_err_snaive), 4) / nullif(sum(source.actual_units), 0)"),
        Field("coverage", "round(sum(source.covered_weeks), 4) / nullif(sum(source.backtest_weeks), 0)"),
    ])


def leaderboard(board: DataFrame) -> DataFrame:
    return board.select("level", "candidate", "wape", "is_champion").orderBy("level", "wape")


def reorder_rows(plan: DataFrame, warehouses: DataFrame) -> DataFrame:
    return lookup(plan, warehouses.select("warehouse_id", "zone"), "warehouse_id").select(
        "warehouse_name", "zone", "sku_id", "product_name", "base_product", "category", "on_hand_units",
        "open_po_units", "forecast_next_4w_units", "weeks_of_cover", "lead_time_weeks", "safety_stock_units",
        "recommended_order_units", "stockout_risk", "projected_stockout_date", "forecast_revenue_4w")


def product_group(test: Column, label: str, rest: str) -> Column:
    return F.when(test, label).otherwise(rest).alias("product_group")


def inventory(weekly: DataFrame, warehouses: DataFrame, group: Column) -> DataFrame:
    totals = weekly.groupBy("week_start", "warehouse_id", "base_product", "category", group).agg(
        F.sum("demand_units").alias("demand_units"), F.sum("shipped_units").alias("shipped_units"),
        F.sum("stockout_days").alias("stockout_days"),
        F.round(F.sum("closing_stock_value"), 2).alias("stock_value"))
    return lookup(totals, warehouses.select("warehouse_id", "warehouse_name", "zone"), "warehouse_id").drop(
        "warehouse_id")


def inventory_kpis(rows: DataFrame) -> MetricView:
    dims = ["week_start", "warehouse_name", "zone", "base_product", "category", "product_group"]
    return MetricView(rows, [Field(d, f"source.{d}") for d in dims], [
        Field("fill_rate", "sum(source.shipped_units) / nullif(sum(source.demand_units), 0)")])


def margin(monthly: DataFrame, group: Column) -> DataFrame:
    return monthly.groupBy("month", group).agg(
        F.round(F.sum("net_revenue"), 2).alias("net_revenue"), F.round(F.sum("gross_margin"), 2).alias("gross_margin"),
        F.round(F.avg("raw_material_index"), 6).alias("raw_material_index"))


def margin_kpis(rows: DataFrame) -> MetricView:
    return MetricView(rows, [Field(d, f"source.{d}") for d in ("month", "product_group")], [
        Field("gm_share", "sum(source.gross_margin) / nullif(sum(source.net_revenue), 0)")])


def rfm(scores: DataFrame) -> DataFrame:
    return scores.groupBy("rfm_segment", "zone", "loyalty_tier").agg(
        F.count(F.lit(1)).alias("customers"), F.round(F.sum("monetary"), 2).alias("monetary"),
        F.round(F.avg("frequency"), 6).alias("avg_orders"),
        F.round(F.avg("recency_days"), 6).alias("avg_recency_days"))


def dq(summary: DataFrame) -> DataFrame:
    return summary.withColumn("outcome", outcome())


def zone_revenue(kpi: MetricView, fiscal_year: str) -> DataFrame:
    out = kpi.query(["zone"], ["net_revenue"], where={"fiscal_year": fiscal_year})
    return out.select("zone", F.round(F.col("net_revenue") / 1e7, 2).alias("net_revenue_cr")).orderBy(
        F.col("net_revenue_cr").desc(), "zone")


def fy_trend(kpi: MetricView) -> DataFrame:
    out = kpi.query(["fiscal_year"], ["net_revenue", "gross_margin_pct"])
    return out.select("fiscal_year", F.round(F.col("net_revenue") / 1e7, 2).alias("net_revenue_cr"),
                      F.round(F.col("gross_margin_pct") * 100, 1).alias("gross_margin_pct")).orderBy("fiscal_year")


def event_growth(uplift: DataFrame, event: str, first: int, second: int, k: int = 10) -> DataFrame:
    """Products by growth between two occurrences of one event."""
    per_year = uplift.where((F.col("event_name") == event) & F.col("year").isin(first, second)).groupBy(
        "base_product", "year").agg(F.round(F.sum("event_daily_revenue"), 2).alias("rev"))
    at = lambda y: F.max(F.when(F.col("year") == y, F.col("rev")))
    wide = per_year.groupBy("base_product").agg(at(first).alias("_a"), at(second).alias("_b"))
    return wide.select(
        "base_product", F.round("_a", 0).alias("first_daily"), F.round("_b", 0).alias("second_daily"),
        F.round(100 * (ratio("_b", "_a") - 1), 1).alias("growth_pct"),
    ).orderBy(F.col("growth_pct").desc_nulls_last(), "base_product").limit(k)


def high_risk(plan: DataFrame, name: str) -> DataFrame:
    return plan.where(F.col("warehouse_name").like(f"%{name}%") & (F.col("stockout_risk") == "High")).select(
        "product_name", "on_hand_units", "open_po_units", "forecast_next_4w_units", "weeks_of_cover",
        "recommended_order_units", "projected_stockout_date").orderBy("weeks_of_cover")


def margin_squeeze(monthly: DataFrame, group: Column, lo: str, hi: str) -> DataFrame:
    return between(monthly, "month", lo, hi).groupBy("month", group).agg(
        F.round(100 * ratio(F.round(F.sum("gross_margin"), 2), F.round(F.sum("net_revenue"), 2)), 1)
        .alias("gross_margin_pct"),
        F.round(F.avg("raw_material_index"), 2).alias("raw_material_index")).orderBy("month", "product_group")


def top_promos(effect: DataFrame, k: int = 5) -> DataFrame:
    return effect.where("baseline_daily_revenue IS NOT NULL").orderBy(
        F.col("revenue_lift_pct").desc_nulls_last(), "promo_name", "channel_code").limit(k).select(
        "promo_name", "channel_code", "discount_pct", "revenue_lift_pct", "discount_cost")


def product_forecast(forecast: DataFrame, products: DataFrame, base_product: str, zone: str) -> DataFrame:
    mine = forecast.where(F.col("zone") == zone).join(
        products.where(F.col("base_product") == base_product).select("sku_id"), "sku_id")
    return mine.groupBy("week_start").agg(
        F.round(F.round(F.sum("forecast_units"), 1), 0).alias("forecast_units"),
        F.round(F.round(F.sum("forecast_lower"), 1), 0).alias("lower_80"),
        F.round(F.round(F.sum("forecast_upper"), 1), 0).alias("upper_80")).orderBy("week_start")


def channel_share(kpi: MetricView) -> DataFrame:
    out = kpi.query(["fiscal_year", "channel_group"], ["net_revenue"])
    return out.select("fiscal_year", "channel_group", F.round(F.col("net_revenue") / 1e7, 2).alias("net_revenue_cr")
                      ).orderBy("fiscal_year", "channel_group")


def chosen_series(df: DataFrame, products: DataFrame, selection: dict) -> DataFrame:
    """Rows of the products and zones a user picked; nothing picked means all."""
    picked = {k: v for k, v in selection.items() if k != "zone"}
    names = apply_filters(products.select("sku_id", "base_product", "product_name"), picked)
    return lookup(apply_filters(df, {"zone": selection.get("zone")}), names, "sku_id")


def explorer_actual(weekly: DataFrame, products: DataFrame, selection: dict, lo: str, hi: str) -> DataFrame:
    return chosen_series(between(weekly, "week_start", lo, hi), products, selection).groupBy("week_start").agg(
        F.sum("units").alias("units")).orderBy("week_start")


def explorer_forecast(forecast: DataFrame, baseline: DataFrame, products: DataFrame, selection: dict) -> DataFrame:
    other = baseline.select("sku_id", "zone", "week_start", F.col("forecast_units").alias("_b"))
    mine = chosen_series(forecast, products, selection).join(other, ["sku_id", "zone", "week_start"], "left")
    named = {"champion": "forecast_units", "lower": "forecast_lower", "upper": "forecast_upper",
             "seasonal_naive": "seasonal_naive_units", "baseline": "_b"}
    return mine.groupBy("week_start").agg(
        *[F.round(F.sum(c), 1).alias(n) for n, c in named.items()]).orderBy("week_start")


def explorer_accuracy(accuracy: DataFrame, products: DataFrame, selection: dict) -> DataFrame:
    mine = chosen_series(accuracy.drop("base_product"), products, selection)
    weighted = lambda c: F.round(F.sum(F.col(c) * F.col("actual_units")), 4)
    return mine.agg(ratio(weighted("wape_model"), F.sum("actual_units")).alias("wape_model"),
                    ratio(weighted("wape_seasonal_naive"), F.sum("actual_units")).alias("wape_snaive"))


def explorer_totals(by_week: DataFrame) -> DataFrame:
    """The four weeks after the partial one, and the whole horizon, from the weekly explorer rows.

    The window runs over the horizon's thirteen weeks.
    """
    n = F.row_number().over(Window.orderBy("week_start"))
    return by_week.withColumn("_n", n).agg(
        F.round(sum_if(F.col("_n").between(2, 5), "champion"), 1).alias("next_4_weeks"),
        F.round(F.sum("champion"), 1).alias("next_12_weeks"))


def planner(plan: DataFrame, log: DataFrame, warehouses: list[str] | None, risks: list[str] | None) -> DataFrame:
    return planner_view(plan, log, warehouses, risks).select(
        "warehouse_id", "warehouse_name", "sku_id", "product_name", "stockout_risk", "on_hand_units", "open_po_units",
        "forecast_next_4w_units", "weeks_of_cover", "recommended_order_units", "projected_stockout_date",
        "last_decision", "last_override").orderBy("weeks_of_cover")


def planner_totals(view: DataFrame) -> DataFrame:
    return view.agg(F.count(F.lit(1)).alias("items"),
                    F.coalesce(F.sum("recommended_order_units"), F.lit(0.0)).alias("recommended_units"),
                    F.count("last_decision").alias("already_decided"))


def picker(df: DataFrame, columns: list[str], order: list[str]) -> DataFrame:
    """Sorted distinct values for a selection list."""
    return df.select(*columns, *[c for c in order if c not in columns]).distinct().orderBy(*order).select(*columns)
