"""Governed KPI views (SEM)."""

import datetime as dt

from pyspark.sql import functions as F

from lakeplan.plans import kpi, reports
from lakeplan.operators.filters import Range
from lakeplan.plans.catalogue import query
from lakeplan.plans.oracle import R, ratio, month
from lakeplan.plans.stand_in import StandIn


def sales_view(s: StandIn):
    return kpi.sales_metrics(s.daily, s.dim_date, s.dim_product)


def order_view(s: StandIn):
    return kpi.order_metrics(s.fact_orders, s.dim_date, s.channels)


def inventory_view(s: StandIn):
    return kpi.inventory_metrics(s.inventory, s.dim_product, s.warehouses)


def rounded(df, digits: dict[str, int]):
    return df.withColumns({c: F.round(c, n) for c, n in digits.items()})


SALES = {
    "net_revenue": ("sum(a.net_revenue)", 2), "net_revenue_cr": ("sum(a.net_revenue) / 1e7", 6),
    "gross_margin": ("sum(a.gross_margin)", 2),
    "gross_margin_pct": (ratio("sum(a.gross_margin)", "sum(a.net_revenue)"), 6), "cogs": ("sum(a.cogs)", 2),
    "units": ("sum(a.units)", 0), "volume_kg": ("sum(a.volume_kg)", 2), "discount": ("sum(a.discount_amount)", 2),
    "discount_rate": (ratio("sum(a.discount_amount)", "sum(a.net_revenue) + sum(a.discount_amount)"), 6),
    "promo_revenue_share": (ratio("sum(a.promo_revenue)", "sum(a.net_revenue)"), 6),
    "return_rate": (ratio("sum(a.returned_lines)", "sum(a.lines)"), 6), "order_lines": ("sum(a.lines)", 0),
}
ORDERS = {
    "orders": ("count(*)", 0), "net_revenue": ("sum(a.net_revenue)", 2),
    "average_order_value": (R("sum(a.net_revenue)", 2) + " / count(*)", 4), "lines_per_order": ("avg(a.line_count)", 6),
    "active_customers": ("count(DISTINCT a.customer_id)", 0),
}
STOCK = {
    "demand_units": ("sum(a.demand_units)", 0), "shipped_units": ("sum(a.shipped_units)", 0),
    "fill_rate": (ratio("sum(a.shipped_units)", "sum(a.demand_units)"), 6),
    "stockout_days": ("count(*) FILTER (a.is_stockout)", 0),
    "stockout_rate": ("count(*) FILTER (a.is_stockout) / count(*)", 6),
    "unfulfilled_units": ("sum(a.unfulfilled_units)", 0),
}


def measures_sql(measures: dict, names=None) -> str:
    def one(n):
        e, d = measures[n]
        return f"{R(e, d)} AS {n}" if d else f"CAST({e} AS BIGINT) AS {n}"
    return ", ".join(one(n) for n in (names or measures))


def ask(view, measures: dict, dims: list[str], names=None, **kw):
    names = list(names or measures)
    return rounded(view.query(dims, names, **kw), {n: measures[n][1] for n in names if measures[n][1]})


@query("sem1_named_definitions", f"""SELECT d.fiscal_year AS fy, a.zone AS region, {R('sum(a.net_revenue)', 2)} AS turnover,
    CAST(sum(a.units) AS BIGINT) AS packs FROM s_daily a JOIN s_dim_date d ON a.order_date = d.date GROUP BY ALL""")
def sem1(s):
    """The same view asked by synonym."""
    return sales_view(s).query(["fy", "region"], ["turnover", "packs"]).withColumn("turnover", F.round("turnover", 2))


@query("sem2_any_grain", f"""SELECT d.season, a.channel_group, {measures_sql(SALES, ['net_revenue', 'units'])} FROM s_daily a
    JOIN s_dim_date d ON a.order_date = d.date WHERE a.zone IN ('ASIA', 'EUROPE') GROUP BY ALL""")
def sem2(s):
    return ask(sales_view(s), SALES, ["season", "channel_group"], ["net_revenue", "units"], where={"zone": ["ASIA", "EUROPE"]})


@query("sem2_month_range", f"""SELECT a.zone, {measures_sql(SALES, ['net_revenue'])} FROM s_daily a
    JOIN s_dim_date d ON a.order_date = d.date WHERE d.month_start BETWEEN DATE '1996-01-01' AND DATE '1996-03-01' GROUP BY ALL""")
def sem2_range(s):
    months = Range(dt.date(1996, 1, 1), dt.date(1996, 3, 1))
    return ask(sales_view(s), SALES, ["zone"], ["net_revenue"], where={"month": months})


@query("sem3_join_pruning", f"SELECT a.zone, a.category, {measures_sql(SALES, ['gross_margin'])} FROM s_daily a GROUP BY ALL")
def sem3(s):
    """Neither dimension table is read: no chosen name needs one."""
    return ask(sales_view(s), SALES, ["zone", "category"], ["gross_margin"])


@query("sem4_sales_measures", f"""SELECT d.month_start AS month, a.zone, {measures_sql(SALES)} FROM s_daily a
    JOIN s_dim_date d ON a.order_date = d.date GROUP BY ALL""")
def sem4(s):
    return ask(sales_view(s), SALES, ["month", "zone"])


@query("sem4_sales_by_product", f"""SELECT p.pack_band, p.is_organic, a.base_product, d.event_name AS event, {measures_sql(SALES)}
    FROM s_daily a JOIN s_dim_product p ON a.sku_id = p.sku_id JOIN s_dim_date d ON a.order_date = d.date GROUP BY ALL""")
def sem4_product(s):
    return ask(sales_view(s), SALES, ["pack_band", "is_organic", "base_product", "event"])


@query("sem5_order_measures", f"""SELECT d.fiscal_year, c.channel_name AS channel, a.used_promo, {measures_sql(ORDERS)}
    FROM s_fact_orders a JOIN s_dim_date d ON a.order_date = d.date JOIN s_channels c ON a.channel_code = c.channel_code
    WHERE a.order_status = 'Delivered' GROUP BY ALL""")
def sem5(s):
    return ask(order_view(s), ORDERS, ["fiscal_year", "channel", "used_promo"])


@query("sem5_orders_by_state", f"""SELECT a.state, a.payment_mode, {measures_sql(ORDERS)} FROM s_fact_orders a
    WHERE a.order_status = 'Delivered' GROUP BY ALL""")
def sem5_state(s):
    return ask(order_view(s), ORDERS, ["state", "payment_mode"])


@query("sem6_inventory_measures", f"""SELECT {month('a.snapshot_date')} AS month, w.warehouse_name AS warehouse, p.category,
    {measures_sql(STOCK)} FROM s_inv a JOIN s_warehouses w ON a.warehouse_id = w.warehouse_id
    LEFT JOIN s_products p ON a.sku_id = p.sku_id GROUP BY ALL""")
def sem6(s):
    return ask(inventory_view(s), STOCK, ["month", "warehouse", "category"])


@query("sem7_report_measures", f"""SELECT a.zone, a.channel_group, {R('sum(a.net_revenue)', 2)} AS total_net_revenue,
    {R(ratio('sum(a.gross_margin)', 'sum(a.net_revenue)'), 6)} AS gross_margin_share,
    {R(R('sum(a.volume_kg)', 2) + ' / 1000', 4)} AS volume_tonnes,
    {R(ratio('sum(a.promo_revenue)', 'sum(a.net_revenue)'), 6)} AS promo_share,
    {R(ratio('sum(a.returned_lines)', 'sum(a.lines)'), 6)} AS return_rate FROM s_daily a GROUP BY ALL""")
def sem7(s):
    view = reports.sales_kpis(reports.sales(s.daily, s.dim_date))
    names = {"total_net_revenue": 2, "gross_margin_share": 6, "volume_tonnes": 4, "promo_share": 6, "return_rate": 6}
    return rounded(view.query(["zone", "channel_group"], list(names)), names)
