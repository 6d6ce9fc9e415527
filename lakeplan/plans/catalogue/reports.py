"""Report queries (RPT)."""

from pyspark.sql import functions as F

from lakeplan.operators.aggregates import layer_counts, margin_monthly, supplier_score
from lakeplan.operators.lift import event_uplift, promotion_lift
from lakeplan.operators.rfm import customer_rfm
from lakeplan.plans import reports as rp
from lakeplan.plans.catalogue import query
from lakeplan.plans.catalogue.kpis import rounded, sales_view
from lakeplan.plans.oracle import B, M, PRODUCT_GROUP, R, S, ratio
from lakeplan.plans.stand_in import CFG, group_a

MIN_BASE = 1000
PICK = {"zone": "ASIA", "base_product": "Brand#1"}


def uplift(s):
    return event_uplift(s.events, s.daily, ["zone", "base_product", "category"], between=("1996-01-01", CFG.as_of))


def effect(s):
    return promotion_lift(s.promotions, s.daily, as_of=CFG.as_of)


def product_group():
    return rp.product_group(group_a(), "Group A", "Other")


def brand_group():
    """The same groups where only the base product's name is at hand."""
    return rp.product_group(F.col("base_product").isin("Brand#1", "Brand#2"), "Group A", "Other")


@query("rpt1_sales", f"""SELECT a.order_date, d.fiscal_year, d.month_start, d.season, a.zone, a.channel_name, a.channel_group, a.category,
    a.base_product, {S('net_revenue')}, {S('gross_margin')}, {B('sum(units)')} AS units, {S('volume_kg')}, {S('discount_amount')},
    {S('promo_revenue')}, {B('sum(lines)')} AS lines, {B('sum(returned_lines)')} AS returned_lines
    FROM s_daily a JOIN s_dim_date d ON a.order_date = d.date GROUP BY ALL""")
def rpt1(s):
    return rp.sales(s.daily, s.dim_date)


@query("rpt2_orders", f"""SELECT o.order_date, o.zone, c.channel_name, c.channel_group, count(*) AS orders, {S('net_revenue')}
    FROM s_fact_orders o JOIN s_channels c ON o.channel_code = c.channel_code WHERE order_status = 'Delivered' GROUP BY ALL""")
def rpt2(s):
    return rp.orders(s.fact_orders, s.channels)


@query("rpt2_orders_kpis", f"""SELECT c.channel_group, count(*) AS total_orders, {R(R('sum(o.net_revenue)', 2) + ' / count(*)', 4)} AS aov
    FROM s_fact_orders o JOIN s_channels c ON o.channel_code = c.channel_code WHERE order_status = 'Delivered' GROUP BY ALL""")
def rpt2_kpis(s):
    view = rp.orders_kpis(rp.orders(s.fact_orders, s.channels))
    return rounded(view.query(["channel_group"], ["total_orders", "aov"]), {"aov": 4})


@query("rpt3_state_map", f"""SELECT m.month AS order_date, m.state, m.zone, c.channel_name, m.category, g.lat, g.lon, {S('net_revenue')},
    {S('gross_margin')} FROM s_monthly m JOIN s_channels c ON m.channel_code = c.channel_code
    JOIN (SELECT state, {R('avg(lat)', 6)} AS lat, {R('avg(lon)', 6)} AS lon FROM s_geo GROUP BY state) g ON m.state = g.state GROUP BY ALL""")
def rpt3(s):
    return rp.state_map(s.monthly, s.channels, s.geography)


@query("rpt4_event_uplift", f"""SELECT event_name, event_date, year, zone, base_product, category, event_daily_revenue,
    baseline_daily_revenue, uplift_pct / 100 AS uplift FROM s_uplift WHERE baseline_daily_revenue > {MIN_BASE}""")
def rpt4(s):
    return rp.event_rows(uplift(s), MIN_BASE)


@query("rpt5_event_daily", f"""SELECT order_date, zone, {S('net_revenue')} FROM s_daily
    WHERE order_date BETWEEN DATE '1998-08-01' AND DATE '1999-11-30' GROUP BY ALL""")
def rpt5(s):
    return rp.event_daily(s.daily, "1998-08-01", "1999-11-30")


@query("rpt6_promotions", """SELECT p.promo_code, p.promo_name, p.promo_type, c.channel_name, p.category_scope, p.event_name,
    p.discount_pct, p.start_date, p.promo_daily_revenue, p.baseline_daily_revenue, p.discount_cost,
    p.revenue_lift_pct / 100 AS revenue_lift FROM s_promo_effect p JOIN s_channels c ON p.channel_code = c.channel_code
    WHERE p.baseline_daily_revenue IS NOT NULL""")
def rpt6(s):
    return rp.promo(effect(s), s.channels)


@query("rpt7_actual_forecast", f"""SELECT week_start, zone, category, actual_units, NULL::DOUBLE AS forecast_units,
    NULL::DOUBLE AS forecast_lower, NULL::DOUBLE AS forecast_upper FROM s_act UNION ALL
    SELECT week_start, zone, category, actual_units, actual_units, actual_units, actual_units FROM s_act
    WHERE week_start = DATE '2001-07-23' UNION ALL
    SELECT f.week_start, f.zone, p.category, NULL, {R('sum(forecast_units)', 1)}, {R('sum(forecast_lower)', 1)},
    {R('sum(forecast_upper)', 1)} FROM s_forecast f JOIN s_products p ON f.sku_id = p.sku_id GROUP BY ALL""", {
    "s_act": """SELECT w.week_start, w.zone, p.category, CAST(sum(w.units) AS DOUBLE) AS actual_units FROM s_weekly w
        JOIN s_products p ON w.sku_id = p.sku_id WHERE w.week_start BETWEEN DATE '1999-07-26' AND DATE '2001-07-23' GROUP BY ALL"""})
def rpt7(s):
    return rp.actual_forecast(s.saved_weekly, s.plan.forecast, s.products, "1999-07-26", CFG.last_full_week)


@query("rpt8_model_compare", f"""SELECT f.week_start, f.zone, p.category, {R('sum(f.forecast_units)', 1)} AS champion_units,
    {R('sum(f.direct_units)', 1)} AS direct_units, {R('sum(f.seasonal_naive_units)', 1)} AS seasonal_naive_units,
    {R('sum(b.forecast_units)', 1)} AS baseline_units FROM s_forecast f JOIN s_products p ON f.sku_id = p.sku_id
    LEFT JOIN s_baseline b ON b.sku_id = f.sku_id AND b.zone = f.zone AND b.week_start = f.week_start GROUP BY ALL""")
def rpt8(s):
    return rp.model_compare(s.plan.forecast, s.baseline, s.products)


ACCURACY_SQL = f"""SELECT *, {R('wape_model * actual_units', 4)} AS abs_err_model, {R('wape_direct * actual_units', 4)} AS abs_err_direct,
    {R('wape_seasonal_naive * actual_units', 4)} AS abs_err_snaive, {R('interval_coverage * backtest_weeks', 4)} AS covered_weeks
    FROM s_accuracy WHERE actual_units > 0"""


@query("rpt9_accuracy", ACCURACY_SQL)
def rpt9(s):
    return rp.accuracy_rows(s.plan.accuracy)


@query("rpt9_accuracy_kpis", f"""SELECT zone, {R(R('sum(abs_err_model)', 4) + ' / sum(actual_units)', 6)} AS total_wape_model,
    {R(R('sum(abs_err_direct)', 4) + ' / sum(actual_units)', 6)} AS total_wape_direct,
    {R(R('sum(abs_err_snaive)', 4) + ' / sum(actual_units)', 6)} AS total_wape_naive,
    {R(R('sum(covered_weeks)', 4) + ' / sum(backtest_weeks)', 6)} AS coverage FROM ({ACCURACY_SQL}) GROUP BY zone""")
def rpt9_kpis(s):
    names = ["total_wape_model", "total_wape_direct", "total_wape_naive", "coverage"]
    return rounded(rp.accuracy_kpis(rp.accuracy_rows(s.plan.accuracy)).query(["zone"], names), {n: 6 for n in names})


@query("rpt10_candidates", f"SELECT level, candidate, {R('wape', 6)} AS wape, is_champion FROM s_board")
def rpt10(s):
    return rp.leaderboard(s.plan.comparison).withColumn("wape", F.round("wape", 6))


REORDER_COLUMNS = ("r.warehouse_name, w.zone, r.sku_id, r.product_name, r.base_product, r.category, r.on_hand_units, r.open_po_units, "
                   "r.forecast_next_4w_units, r.weeks_of_cover, r.lead_time_weeks, r.safety_stock_units, r.recommended_order_units, "
                   "r.stockout_risk, r.projected_stockout_date, r.forecast_revenue_4w")


@query("rpt11_reorder", f"SELECT {REORDER_COLUMNS} FROM s_reorder r JOIN s_warehouses w ON r.warehouse_id = w.warehouse_id")
def rpt11(s):
    return rp.reorder_rows(s.reorder, s.warehouses)


@query("rpt12_inventory", f"""SELECT i.week_start, w.warehouse_name, w.zone, i.base_product, i.category,
    CASE WHEN i.base_product IN ('Brand#1', 'Brand#2') THEN 'Group A' ELSE 'Other' END AS product_group,
    {B('sum(demand_units)')} AS demand_units, {B('sum(shipped_units)')} AS shipped_units, {B('sum(stockout_days)')} AS stockout_days,
    {R('sum(closing_stock_value)', 2)} AS stock_value FROM s_inv_weekly i JOIN s_warehouses w ON i.warehouse_id = w.warehouse_id
    GROUP BY ALL""")
def rpt12(s):
    return rp.inventory(s.inventory_weekly, s.warehouses, brand_group())


@query("rpt12_inventory_kpis", f"""SELECT w.zone, CASE WHEN i.base_product IN ('Brand#1', 'Brand#2') THEN 'Group A' ELSE 'Other' END
    AS product_group, {R(ratio('sum(shipped_units)', 'sum(demand_units)'), 6)} AS fill_rate FROM s_inv_weekly i
    JOIN s_warehouses w ON i.warehouse_id = w.warehouse_id GROUP BY ALL""")
def rpt12_kpis(s):
    view = rp.inventory_kpis(rp.inventory(s.inventory_weekly, s.warehouses, brand_group()))
    return rounded(view.query(["zone", "product_group"], ["fill_rate"]), {"fill_rate": 6})


@query("rpt13_margin", f"""SELECT month, {PRODUCT_GROUP} AS product_group, {S('net_revenue')}, {S('gross_margin')},
    {R('avg(raw_material_index)', 6)} AS raw_material_index FROM s_margin GROUP BY ALL""")
def rpt13(s):
    return rp.margin(margin_monthly(s.fact, s.materials), product_group())


@query("rpt13_margin_kpis", f"""SELECT {PRODUCT_GROUP} AS product_group,
    {R(ratio('sum(gross_margin)', 'sum(net_revenue)'), 6)} AS gm_share FROM s_margin GROUP BY ALL""")
def rpt13_kpis(s):
    view = rp.margin_kpis(rp.margin(margin_monthly(s.fact, s.materials), product_group()))
    return rounded(view.query(["product_group"], ["gm_share"]), {"gm_share": 6})


@query("rpt14_supplier", f"""SELECT supplier_name, supplier_tier, base_product, quality_grade, count(*) AS pos, {S('po_value')},
    {R(M('fill_rate', 3), 6)} AS avg_fill_rate, {R('avg(delay_days)', 6)} AS avg_delay_days FROM s_pos GROUP BY ALL""")
def rpt14(s):
    return supplier_score(s.pos, ["supplier_name", "supplier_tier", "base_product", "quality_grade"])


@query("rpt15_rfm", f"""SELECT rfm_segment, zone, loyalty_tier, count(*) AS customers, {S('monetary')},
    {R('avg(frequency)', 6)} AS avg_orders, {R('avg(recency_days)', 6)} AS avg_recency_days FROM s_rfm GROUP BY ALL""")
def rpt15(s):
    return rp.rfm(customer_rfm(s.fact_orders, s.dim_customer, CFG.as_of, ["zone", "loyalty_tier"]))


@query("rpt16_quality", """SELECT *, CASE WHEN dq_reason LIKE '%accepted%' THEN 'Accepted (flagged)' ELSE 'Rejected (quarantined)' END
    AS outcome FROM s_dq""")
def rpt16(s):
    return rp.dq(s.dq_summary)


@query("rpt17_layers", """SELECT 'Bronze raw lines' AS layer, 1 AS ord, count(*) AS rows FROM s_raw_lines UNION ALL
    SELECT 'Silver clean lines', 2, count(*) FROM s_lines UNION ALL SELECT 'Gold fact lines', 3, count(*) FROM s_fact UNION ALL
    SELECT 'Gold orders', 4, count(*) FROM s_fact_orders""")
def rpt17(s):
    return layer_counts([("Bronze raw lines", s.raw_lines), ("Silver clean lines", s.lines), ("Gold fact lines", s.fact),
                         ("Gold orders", s.fact_orders)])


CR = f"{R(R('sum(a.net_revenue)', 2) + ' / 1e7', 2)} AS net_revenue_cr"


@query("rpt18_zone_revenue", f"""SELECT a.zone, {CR} FROM s_daily a JOIN s_dim_date d ON a.order_date = d.date
    WHERE d.fiscal_year = 'FY98-99' GROUP BY ALL""")
def rpt18(s):
    return rp.zone_revenue(sales_view(s), "FY98-99")


@query("rpt19_fy_trend", f"""SELECT d.fiscal_year, {CR}, {R('100 * (' + ratio('sum(a.gross_margin)', 'sum(a.net_revenue)') + ')', 1)}
    AS gross_margin_pct FROM s_daily a JOIN s_dim_date d ON a.order_date = d.date GROUP BY ALL""")
def rpt19(s):
    return rp.fy_trend(sales_view(s))


@query("rpt20_event_growth", f"""SELECT base_product, {R('a', 0)} AS first_daily, {R('b', 0)} AS second_daily,
    {R('100 * (' + ratio('b', 'a') + ' - 1)', 1)} AS growth_pct FROM (SELECT base_product, max(CASE WHEN year = 1998 THEN rev END) AS a,
    max(CASE WHEN year = 1999 THEN rev END) AS b FROM (SELECT base_product, year, {R('sum(event_daily_revenue)', 2)} AS rev FROM s_uplift
    WHERE event_name = 'Harvest' AND year IN (1998, 1999) GROUP BY ALL) GROUP BY 1)
    ORDER BY growth_pct DESC NULLS LAST, base_product LIMIT 10""")
def rpt20(s):
    return rp.event_growth(uplift(s), "Harvest", 1998, 1999)


@query("rpt21_high_risk", """SELECT product_name, on_hand_units, open_po_units, forecast_next_4w_units, weeks_of_cover,
    recommended_order_units, projected_stockout_date FROM s_reorder WHERE warehouse_name LIKE '%ASIA%' AND stockout_risk = 'High'""")
def rpt21(s):
    return rp.high_risk(s.reorder, "ASIA")


@query("rpt22_margin_squeeze", f"""SELECT month, {PRODUCT_GROUP} AS product_group,
    {R('100 * (' + ratio(R('sum(gross_margin)', 2), R('sum(net_revenue)', 2)) + ')', 1)} AS gross_margin_pct,
    {R('avg(raw_material_index)', 2)} AS raw_material_index FROM s_margin
    WHERE month BETWEEN DATE '1998-01-01' AND DATE '1999-06-01' GROUP BY ALL""")
def rpt22(s):
    return rp.margin_squeeze(margin_monthly(s.fact, s.materials), product_group(), "1998-01-01", "1999-06-01")


@query("rpt23_top_promos", """SELECT promo_name, channel_code, discount_pct, revenue_lift_pct, discount_cost FROM s_promo_effect
    WHERE baseline_daily_revenue IS NOT NULL ORDER BY revenue_lift_pct DESC NULLS LAST, promo_name, channel_code LIMIT 5""")
def rpt23(s):
    return rp.top_promos(effect(s))


@query("rpt24_product_forecast", f"""SELECT f.week_start, {R(R('sum(forecast_units)', 1), 0)} AS forecast_units,
    {R(R('sum(forecast_lower)', 1), 0)} AS lower_80, {R(R('sum(forecast_upper)', 1), 0)} AS upper_80 FROM s_forecast f
    JOIN s_products p ON f.sku_id = p.sku_id WHERE p.base_product = 'Brand#1' AND f.zone = 'ASIA' GROUP BY 1""")
def rpt24(s):
    return rp.product_forecast(s.plan.forecast, s.products, "Brand#1", "ASIA")


@query("rpt25_channel_share", f"""SELECT d.fiscal_year, a.channel_group, {CR} FROM s_daily a JOIN s_dim_date d ON a.order_date = d.date
    GROUP BY ALL""")
def rpt25(s):
    return rp.channel_share(sales_view(s))


PICKED = "p.base_product = 'Brand#1'"


@query("rpt26_explorer_actual", f"""SELECT w.week_start, {B('sum(w.units)')} AS units FROM s_weekly w JOIN s_products p ON w.sku_id = p.sku_id
    WHERE w.zone = 'ASIA' AND {PICKED} AND w.week_start BETWEEN DATE '1999-01-04' AND DATE '2001-07-23' GROUP BY 1""")
def rpt26(s):
    return rp.explorer_actual(s.weekly, s.products, PICK, "1999-01-04", CFG.last_full_week)


EXPLORER = f"""SELECT f.week_start, {R('sum(f.forecast_units)', 1)} AS champion, {R('sum(f.forecast_lower)', 1)} AS lower,
    {R('sum(f.forecast_upper)', 1)} AS upper, {R('sum(f.seasonal_naive_units)', 1)} AS seasonal_naive,
    {R('sum(b.forecast_units)', 1)} AS baseline FROM s_forecast f JOIN s_products p ON f.sku_id = p.sku_id
    LEFT JOIN s_baseline b ON b.sku_id = f.sku_id AND b.zone = f.zone AND b.week_start = f.week_start
    WHERE f.zone = 'ASIA' AND {PICKED} GROUP BY 1"""


@query("rpt27_explorer_forecast", EXPLORER)
def rpt27(s):
    return rp.explorer_forecast(s.plan.forecast, s.baseline, s.products, PICK)


@query("rpt28_explorer_accuracy", f"""SELECT {R(R('sum(wape_model * actual_units)', 4) + ' / sum(actual_units)', 6)} AS wape_model,
    {R(R('sum(wape_seasonal_naive * actual_units)', 4) + ' / sum(actual_units)', 6)} AS wape_snaive FROM s_accuracy a
    JOIN s_products p ON a.sku_id = p.sku_id WHERE a.zone = 'ASIA' AND {PICKED}""")
def rpt28(s):
    return rounded(rp.explorer_accuracy(s.plan.accuracy, s.products, PICK), {"wape_model": 6, "wape_snaive": 6})


PLANNER = """SELECT r.warehouse_id, r.warehouse_name, r.sku_id, r.product_name, r.stockout_risk, r.on_hand_units, r.open_po_units,
    r.forecast_next_4w_units, r.weeks_of_cover, r.recommended_order_units, r.projected_stockout_date, d.decision AS last_decision,
    d.override_units AS last_override FROM s_reorder r LEFT JOIN s_latest d ON d.warehouse_id = r.warehouse_id AND d.sku_id = r.sku_id
    WHERE r.warehouse_name IN ('ASIA DC', 'EUROPE DC') AND r.stockout_risk IN ('High')"""


def planner(s):
    return rp.planner(s.reorder, s.decisions, ["ASIA DC", "EUROPE DC"], ["High"])


@query("rpt29_planner", PLANNER)
def rpt29(s):
    return planner(s)


@query("rpt30_explorer_totals", f"""SELECT {R('sum(champion) FILTER (n BETWEEN 2 AND 5)', 1)} AS next_4_weeks,
    {R('sum(champion)', 1)} AS next_12_weeks FROM (SELECT *, row_number() OVER (ORDER BY week_start) AS n FROM ({EXPLORER}))""")
def rpt30(s):
    return rp.explorer_totals(rp.explorer_forecast(s.plan.forecast, s.baseline, s.products, PICK))


@query("rpt31_planner_totals", f"""SELECT count(*) AS items, coalesce(sum(recommended_order_units), 0) AS recommended_units,
    count(last_decision) AS already_decided FROM ({PLANNER})""")
def rpt31(s):
    return rp.planner_totals(planner(s))


@query("rpt32_picker_products", "SELECT DISTINCT p_brand AS base_product FROM part")
def rpt32(s):
    return rp.picker(s.products, ["base_product"], ["base_product"])


@query("rpt32_picker_packs", "SELECT sku_id, product_name FROM s_products WHERE base_product = 'Brand#1'")
def rpt32_packs(s):
    return rp.picker(s.products.where("base_product = 'Brand#1'"), ["sku_id", "product_name"], ["pack_size", "sku_id"])


@query("rpt32_picker_warehouses", "SELECT DISTINCT warehouse_name FROM s_reorder")
def rpt32_warehouses(s):
    return rp.picker(s.reorder, ["warehouse_name"], ["warehouse_name"])
