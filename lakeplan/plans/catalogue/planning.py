"""Inventory, reorder and quality gate (INV, DQ)."""

from pyspark.sql import functions as F

from lakeplan.operators import inventory as iv
from lakeplan.operators import quality as ql
from lakeplan.operators import reorder as ro
from lakeplan.operators.aggregates import DAILY_INPUT
from lakeplan.operators.decisions import planner_view
from lakeplan.plans.catalogue import query
from lakeplan.plans.catalogue.kpis import sales_view
from lakeplan.plans.oracle import AS_OF, FIRST_FC, R, W
from lakeplan.plans.stand_in import CFG, FIRST_FORECAST_WEEK


def shown(df, **digits):
    return df.withColumns({c: F.round(c, n) for c, n in digits.items()})


INV_COLUMNS = ("warehouse_id, sku_id, snapshot_date, receipts_units, demand_units, shipped_units, opening_units, closing_units, "
               "unfulfilled_units, is_stockout, below_safety_stock, days_of_cover, stock_value")


@query("inv1_daily_position", f"SELECT {INV_COLUMNS} FROM s_inv")
def inv1(s):
    return s.inventory.select(*INV_COLUMNS.split(", "))


@query("inv2_purchase_orders", """SELECT * REPLACE (CAST(actual_lead_days AS DOUBLE) AS actual_lead_days,
    CAST(delay_days AS DOUBLE) AS delay_days) FROM s_pos""")
def inv2(s):
    return s.pos.withColumns({c: F.col(c).cast("double") for c in ("actual_lead_days", "delay_days")})


@query("inv3_returns", f"""SELECT r.return_id, r.line_id, r.return_date, r.return_qty, f.order_date, f.channel_code, f.zone,
    f.warehouse_id, p.category, CAST(r.return_date - f.order_date AS INTEGER) AS days_to_return FROM s_returns r
    JOIN s_fact f ON r.line_id = f.line_id JOIN s_products p ON r.sku_id = p.sku_id""")
def inv3(s):
    return s.fact_returns.select("return_id", "line_id", "return_date", "return_qty", "order_date", "channel_code", "zone",
                                 "warehouse_id", "category", "days_to_return")


@query("inv4_warehouse_share", "SELECT zone, warehouse_id, sku_id, units, share FROM s_wh_share")
def inv4(s):
    return ro.warehouse_share(s.fact, CFG.as_of).select("zone", "warehouse_id", "sku_id", "units", "share")


def allocated(s):
    s.share_sold()
    return ro.allocate(s.plan.forecast, ro.warehouse_share(s.fact, CFG.as_of), FIRST_FORECAST_WEEK)


@query("inv5_allocated_forecast", f"SELECT warehouse_id, sku_id, week_start, {R('fc_units', 6)} AS fc_units, {R('fc_upper', 6)} AS fc_upper FROM s_alloc")
def inv5(s):
    return shown(allocated(s), fc_units=6, fc_upper=6)


@query("inv6_stock_on_hand", "SELECT * FROM s_stock")
def inv6_stock(s):
    return ro.stock_on_hand(s.inventory, CFG.as_of, latest=True)


@query("inv6_stock_on_day", f"SELECT warehouse_id, sku_id, closing_units AS on_hand_units, stock_value FROM s_inv WHERE snapshot_date = {AS_OF}")
def inv6_day(s):
    return ro.stock_on_hand(s.inventory, CFG.as_of)


@query("inv6_open_orders", "SELECT * FROM s_open_po")
def inv6_open(s):
    return ro.open_orders(s.pos, CFG.as_of)


@query("inv6_lead_times", "SELECT * FROM s_lead")
def inv6_lead(s):
    return ro.lead_times(s.pos, CFG.as_of, CFG.default_lead_days)


@query("inv7_horizon_sums", f"""SELECT h.warehouse_id, h.sku_id, {R('fc_next_4w', 6)} AS fc_next_4w, {R('fc_next_12w', 6)} AS fc_next_12w,
    {R('fc_avg_week', 6)} AS fc_avg_week, w.weeks FROM s_horizon h JOIN (SELECT warehouse_id, sku_id, CAST(count(*) AS INTEGER) AS weeks
    FROM s_alloc WHERE week_start >= {FIRST_FC} GROUP BY ALL) w ON w.warehouse_id = h.warehouse_id AND w.sku_id = h.sku_id""")
def inv7(s):
    sums = ro.horizon_sums(allocated(s), FIRST_FORECAST_WEEK)
    return shown(sums.withColumn("weeks", F.size("weekly")).drop("weekly"), fc_next_4w=6, fc_next_12w=6, fc_avg_week=6)


@query("inv8_reorder", "SELECT * FROM s_reorder")
def inv8(s):
    return s.reorder


@query("inv9_policy_levels", f"""SELECT warehouse_id, sku_id, snapshot_date,
    {R('1.65::DOUBLE * sd * sqrt(14.0::DOUBLE)', 4)} AS safety_stock,
    {R('greatest(mean, 0.05::DOUBLE) * 14 + 1.65::DOUBLE * sd * sqrt(14.0::DOUBLE)', 4)} AS reorder_point FROM (
    SELECT *, avg(demand_units) OVER w AS mean, stddev_pop(demand_units) OVER w AS sd FROM s_movements
    WINDOW w AS (PARTITION BY warehouse_id, sku_id ORDER BY snapshot_date ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING))""")
def inv9(s):
    return iv.policy_levels(s.movements, 7).select("warehouse_id", "sku_id", "snapshot_date", "safety_stock", "reorder_point")


@query("inv10_stock_ledger", """SELECT warehouse_id, sku_id, snapshot_date, opening_units, receipts_units, shipped_units, closing_units
    FROM s_ledger""")
def inv10(s):
    return s.raw_inventory.select("warehouse_id", "sku_id", "snapshot_date", "opening_units", "receipts_units",
                                  "shipped_units", "closing_units")


@query("inv11_risk_distribution", "SELECT stockout_risk, count(*) AS n FROM s_reorder GROUP BY 1")
def inv11(s):
    return ro.risk_distribution(s.reorder)


@query("inv12_planner_view", """SELECT r.warehouse_id, r.sku_id, r.stockout_risk, r.recommended_order_units, d.decision AS last_decision,
    d.override_units AS last_override FROM s_reorder r LEFT JOIN s_latest d ON d.warehouse_id = r.warehouse_id AND d.sku_id = r.sku_id
    WHERE r.stockout_risk IN ('High', 'Medium')""")
def inv12(s):
    view = planner_view(s.reorder, s.decisions, risks=["High", "Medium"])
    return view.select("warehouse_id", "sku_id", "stockout_risk", "recommended_order_units", "last_decision", "last_override")


REJECTS = """(SELECT CAST(sum(rows) AS BIGINT) FROM s_dq WHERE source_table = 'sales_lines' AND dq_reason NOT LIKE '%accepted%')"""


@query("dq1_reject_rate", f"""SELECT {REJECTS} AS rejected, CAST((SELECT count(*) FROM s_raw_lines) AS BIGINT) AS raw,
    {R(REJECTS + ' / (SELECT count(*) FROM s_raw_lines)', 6)} AS reject_rate""")
def dq1(s):
    return shown(ql.reject_rate(s.dq_summary, s.raw_lines), reject_rate=6)


@query("dq2_orphans", """SELECT CAST((SELECT count(*) FROM s_raw_lines WHERE sku_id NOT IN (SELECT sku_id FROM s_products)) +
    (SELECT count(*) FROM s_raw_lines l JOIN s_raw_orders o ON l.order_id = o.order_id WHERE o.store_id IS NULL) AS BIGINT) AS orphans""")
def dq2(s):
    """Before cleaning, so that there are orphans to find: unknown SKUs and orders without a store."""
    lines = s.raw_lines.join(s.raw_orders.select("order_id", "store_id"), "order_id")
    return ql.orphan_count(lines, [(s.products, "sku_id"), (s.stores, "store_id")])


@query("dq3_reconcile", f"""SELECT {R('sum(net_revenue)', 2)} AS gold, {R('sum(net_revenue)', 2)} AS kpi, 0.0::DOUBLE AS gap FROM s_daily""")
def dq3(s):
    return ql.reconcile(s.daily, sales_view(s).query(["fiscal_year"], ["net_revenue"]))


@query("dq4_freshness", f"""SELECT max(order_date) AS latest, CAST(greatest(0, {AS_OF} - max(order_date)) AS INTEGER) AS days_behind
    FROM s_daily""")
def dq4(s):
    return ql.days_behind(s.daily, "order_date", CFG.as_of)


@query("dq5_horizon", "SELECT count(DISTINCT week_start) AS weeks FROM s_forecast")
def dq5(s):
    return ql.horizon_weeks(s.plan.forecast)


@query("dq6_gate_status", f"""SELECT 'reject_rate' AS check_name, {R(REJECTS + ' / (SELECT count(*) FROM s_raw_lines)', 6)} AS value,
    0.01::DOUBLE AS limit_value, {REJECTS} / (SELECT count(*) FROM s_raw_lines) > 0.01 AS breached UNION ALL
    SELECT 'orphans', 0.0, 0.0, false UNION ALL SELECT 'reconcile', 0.0, 0.0001, false UNION ALL
    SELECT 'freshness', CAST(greatest(0, {AS_OF} - max(order_date)) AS DOUBLE), 0.0, {AS_OF} > max(order_date) FROM s_daily UNION ALL
    SELECT 'horizon', CAST(count(DISTINCT week_start) AS DOUBLE), 12.0, count(DISTINCT week_start) < 12 FROM s_forecast""")
def dq6(s):
    """The status rows only; a breach is reported here and raised by ``enforce``."""
    s.split_lines()
    s.share(fact=[*DAILY_INPUT, "store_id"])
    s.share(daily=["order_date", "sku_id", "zone", "units", "net_revenue", "promo_revenue"])
    kpi = sales_view(s).query([], ["net_revenue"])
    return ql.gate(s.dq_summary, s.raw_lines, s.fact, s.products, s.stores, s.daily, kpi, s.plan.forecast, CFG.as_of)


@query("dq7_summary", "SELECT * FROM s_dq")
def dq7(s):
    return s.dq_summary


@query("dq8_alerts", f"""SELECT 'high_risk_items' AS check_name, CAST(count(*) FILTER (stockout_risk = 'High') AS DOUBLE) AS value,
    100.0::DOUBLE AS limit_value, count(*) FILTER (stockout_risk = 'High') > 100 AS breached FROM s_reorder UNION ALL
    SELECT 'forecast_wape', {R(W('forecast_units'), 6)}, 0.3,
    sum(abs(actual - forecast_units)) / sum(actual) > 0.3 FROM s_backtest UNION ALL
    SELECT 'reject_rate', {R(REJECTS + ' / (SELECT count(*) FROM s_raw_lines)', 6)}, 0.01,
    {REJECTS} / (SELECT count(*) FROM s_raw_lines) > 0.01""")
def dq8(s):
    s.split_lines()
    return ql.alerts(s.reorder, s.plan.backtest, s.dq_summary, s.raw_lines)


