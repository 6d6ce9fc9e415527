"""Aggregations (AGG), sorting and set operations (ORD, SET)."""

from pyspark.sql import functions as F

from lakeplan.forecast.conformal import quantiles
from lakeplan.functions.calendar import names_per_day
from lakeplan.functions.columns import avg_if, count_if, month_start, ratio, sum_if
from lakeplan.operators import aggregates as ag
from lakeplan.operators import distinct as ds
from lakeplan.operators.inventory import weekly_variability
from lakeplan.operators.joins import lookup
from lakeplan.operators.lift import event_uplift, promotion_lift
from lakeplan.operators.quality import union_all
from lakeplan.operators.rfm import rfm_totals
from lakeplan.plans import reports
from lakeplan.plans.catalogue import query
from lakeplan.plans.oracle import B, M, R, S, month, ratio as sql_ratio, week
from lakeplan.plans.stand_in import CFG
from lakeplan.session import checkpoint_table

ZONES = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]


@query("agg1_sales_daily", "SELECT * FROM s_daily")
def agg1(s):
    return s.daily


@query("agg2_sales_monthly", "SELECT * FROM s_monthly")
def agg2(s):
    return s.monthly


@query("agg3_sales_weekly", "SELECT * FROM s_weekly")
def agg3(s):
    return s.weekly


@query("agg4_order_headers", "SELECT * REPLACE (strftime(order_ts, '%Y-%m-%d %H:%M:%S') AS order_ts) FROM s_fact_orders")
def agg4(s):
    return s.fact_orders.withColumn("order_ts", F.date_format("order_ts", "yyyy-MM-dd HH:mm:ss"))


@query("agg5_distinct_count", """SELECT sku_id, count(DISTINCT order_id) AS orders FROM s_raw_lines GROUP BY sku_id""")
def agg5(s):
    return s.raw_lines.groupBy("sku_id").agg(F.countDistinct("order_id").alias("orders"))


ACTIVE_KEYS = ["order_date", "zone", "channel_code"]


def active_customers(s):
    """The stored daily aggregate of delivered customers."""
    orders = checkpoint_table(s.fact.where("order_status = 'Delivered'").select(*ACTIVE_KEYS, "customer_id"), "active")
    return checkpoint_table(ds.member_bitmaps(orders, ds.dense_ids(orders, "customer_id"), "customer_id", ACTIVE_KEYS), "bitmaps")


@query("agg5_mergeable_distinct", f"""SELECT {month('order_date')} AS month, zone, count(DISTINCT customer_id) AS active_customers
    FROM s_fact WHERE order_status = 'Delivered' AND customer_id IS NOT NULL GROUP BY ALL""")
def agg5_mergeable(s):
    """Active customers by month and zone, merged from the daily bitmaps alone."""
    return ds.distinct_members(active_customers(s).withColumn("month", month_start("order_date")), ["month", "zone"], "active_customers")


@query("sem5_active_customers", f"""SELECT d.fiscal_year, c.channel_name AS channel, count(DISTINCT f.customer_id) AS active_customers
    FROM s_fact f JOIN s_dim_date d ON f.order_date = d.date JOIN s_channels c ON c.channel_code = f.channel_code
    WHERE f.order_status = 'Delivered' AND f.customer_id IS NOT NULL GROUP BY ALL""")
def sem5_active(s):
    """The same measure at the grain of fiscal year and channel, asked of the pre-aggregated table."""
    dated = lookup(active_customers(s), s.dim_date.select(F.col("date").alias("order_date"), "fiscal_year"), "order_date")
    named = lookup(dated, s.channels.select("channel_code", F.col("channel_name").alias("channel")), "channel_code")
    return ds.distinct_members(named, ["fiscal_year", "channel"], "active_customers")


@query("agg6_conditional", f"""SELECT o_orderpriority AS channel_code,
    {R("sum(CASE WHEN o_orderstatus = 'P' THEN o_totalprice END)", 2)} AS cancelled,
    {R(M("CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END", 2), 4)} AS delivered_mean,
    count(CASE WHEN o_totalprice > 400000 THEN 1 END) AS large FROM orders GROUP BY 1""")
def agg6(s):
    p, cancelled = F.col("o_totalprice"), F.col("o_orderstatus") == "P"
    return s.orders_tbl.groupBy(F.col("o_orderpriority").alias("channel_code")).agg(
        F.round(sum_if(cancelled, p), 2).alias("cancelled"), F.round(avg_if(~cancelled, p), 4).alias("delivered_mean"),
        count_if(p > 400000).alias("large"))


@query("agg7_filter_clause", """SELECT warehouse_id, count(*) FILTER (is_stockout) AS stockout_days,
    count(*) AS days FROM s_inv GROUP BY 1""")
def agg7(s):
    return s.inventory.groupBy("warehouse_id").agg(
        F.expr("count(1) FILTER (WHERE is_stockout)").alias("stockout_days"), F.count(F.lit(1)).alias("days"))


@query("agg8_safe_ratio", f"""SELECT sku_id, zone, {R(sql_ratio('sum(promo_revenue)', 'sum(net_revenue)'), 6)} AS promo_share
    FROM s_daily GROUP BY ALL""")
def agg8(s):
    return s.daily.groupBy("sku_id", "zone").agg(
        F.round(ratio(F.sum("promo_revenue"), F.sum("net_revenue")), 6).alias("promo_share"))


@query("agg9_promotion_lift", "SELECT * FROM s_promo_effect")
def agg9(s):
    return promotion_lift(s.promotions, s.daily, as_of=CFG.as_of)


@query("agg10_event_uplift", "SELECT * FROM s_uplift")
def agg10(s):
    return event_uplift(s.events, s.daily, ["zone", "base_product", "category"], between=("1996-01-01", CFG.as_of))


@query("agg11_value_at_latest", """SELECT warehouse_id, sku_id, arg_max(closing_units, snapshot_date) AS closing_units,
    max(snapshot_date) AS latest FROM s_snapshots GROUP BY ALL""")
def agg11(s):
    return s.snapshots.groupBy("warehouse_id", "sku_id").agg(
        F.max_by("closing_units", "snapshot_date").alias("closing_units"), F.max("snapshot_date").alias("latest"))


@query("agg12_service_level", "SELECT * FROM s_inv_weekly")
def agg12(s):
    return s.inventory_weekly


@query("agg13_margin_monthly", "SELECT * FROM s_margin")
def agg13(s):
    return ag.margin_monthly(s.fact, s.materials)


@query("agg14_dependent_column", "SELECT store_id, max(zone) AS zone, max(state) AS state, count(*) AS lines FROM s_fact GROUP BY 1")
def agg14(s):
    return s.fact.groupBy("store_id").agg(F.max("zone").alias("zone"), F.max("state").alias("state"),
                                          F.count(F.lit(1)).alias("lines"))


@query("agg15_rfm_totals", "SELECT * FROM s_rfm_totals")
def agg15(s):
    return rfm_totals(s.fact_orders, CFG.as_of)


@query("agg16_weekly_variability", f"""SELECT warehouse_id, sku_id, {R('stddev_samp(demand)', 4)} AS sd_week,
    {R('avg(demand)', 4)} AS avg_week FROM (SELECT warehouse_id, sku_id, {week('snapshot_date')} AS wk,
    {B('sum(demand_units)')} AS demand FROM s_inv GROUP BY ALL) GROUP BY ALL""")
def agg16(s):
    return weekly_variability(s.inventory).withColumns(
        {"sd_week": F.round("sd_week", 4), "avg_week": F.round("avg_week", 4)})


@query("agg17_group_quantiles", """SELECT category, zone, quantile_disc(net_revenue, 0.1) AS q10, quantile_disc(net_revenue, 0.9) AS q90
    FROM s_fact GROUP BY ALL""")
def agg17(s):
    return quantiles(s.fact, ["category", "zone"], "net_revenue", {"q10": 0.1, "q90": 0.9})


@query("agg18_join_names", """SELECT order_date AS date, string_agg(event_name, ' / ' ORDER BY event_name) AS event_name FROM
    (SELECT DISTINCT order_date, o.channel_code AS event_name FROM s_raw_orders o) GROUP BY 1""")
def agg18(s):
    """Distinct channel names of every order day; a day has at most as many as there are channels."""
    return names_per_day(s.raw_orders, "channel_code", "order_date")


@query("agg19_series_list", """SELECT sku_id, zone, count(*) AS weeks, list(units ORDER BY week_start)[1] AS first_units,
    list(units ORDER BY week_start)[-1] AS last_units, CAST(sum(units) AS BIGINT) AS total FROM s_weekly GROUP BY ALL""")
def agg19(s):
    """Weekly values of a series as one sorted list, one entry per week."""
    rows = F.sort_array(F.collect_list(F.struct("week_start", "units")))
    return s.weekly.groupBy("sku_id", "zone").agg(rows.alias("r")).select(
        "sku_id", "zone", F.size("r").cast("long").alias("weeks"), F.col("r")[0]["units"].alias("first_units"),
        F.element_at("r", -1)["units"].alias("last_units"),
        F.expr("aggregate(r, 0L, (a, x) -> a + x.units)").alias("total"))


@query("agg20_group_by_all", """SELECT channel_code, order_status, payment_mode, count(*) AS orders FROM s_raw_orders GROUP BY ALL""")
def agg20(s):
    return s.spark.sql("SELECT channel_code, order_status, payment_mode, count(*) AS orders FROM {src} GROUP BY ALL",
                       src=s.raw_orders)


@query("agg21_global", f"""SELECT {R('sum(net_revenue)', 2)} AS net_revenue, max(order_date) AS latest, count(*) AS lines,
    count(DISTINCT sku_id) AS skus FROM s_fact""")
def agg21(s):
    return s.fact.agg(F.round(F.sum("net_revenue"), 2).alias("net_revenue"), F.max("order_date").alias("latest"),
                      F.count(F.lit(1)).alias("lines"), F.countDistinct("sku_id").alias("skus"))


@query("agg22_pivot_product_zone", "SELECT base_product, " + ", ".join(
    f"{R(f'sum(net_revenue) FILTER (zone = {z!r})', 2)} AS \"{z}\"" for z in ZONES) + " FROM s_daily GROUP BY 1")
def agg22(s):
    return ag.pivot(s.daily, ["base_product"], "zone", ZONES, F.round(F.sum("net_revenue"), 2))


@query("agg22_pivot_category_zone", "SELECT category, " + ", ".join(
    f"{B(f'sum(units) FILTER (zone = {z!r})')} AS \"{z}\"" for z in ZONES) + " FROM s_daily GROUP BY 1")
def agg22_units(s):
    return ag.pivot(s.daily, ["category"], "zone", ZONES, F.sum("units"))


@query("agg23_by_month", f"SELECT {month('order_date')} AS period, zone, {S('net_revenue')} FROM s_daily GROUP BY ALL")
def agg23_month(s):
    return ag.by_period(s.daily, "order_date", "month", ["zone"], net_revenue=F.round(F.sum("net_revenue"), 2))


@query("agg23_by_week", f"SELECT {week('order_date')} AS period, channel_group, {B('sum(units)')} AS units FROM s_daily GROUP BY ALL")
def agg23_week(s):
    return ag.by_period(s.daily, "order_date", "week", ["channel_group"], units=F.sum("units"))


@query("agg24_weighted_mean", f"""SELECT zone, {R('sum(gross_margin * quantity) / sum(quantity)', 4)} AS margin_per_unit
    FROM s_fact GROUP BY zone""")
def agg24(s):
    return s.fact.groupBy("zone").agg(F.round(ag.weighted_mean("gross_margin", "quantity"), 4).alias("margin_per_unit"))


@query("agg25_layer_counts", """SELECT 'Raw lines' AS layer, 1 AS ord, count(*) AS rows FROM s_raw_lines UNION ALL
    SELECT 'Clean lines', 2, count(*) FROM s_lines UNION ALL SELECT 'Fact lines', 3, count(*) FROM s_fact UNION ALL
    SELECT 'Orders', 4, count(*) FROM s_fact_orders""")
def agg25(s):
    return ag.layer_counts([("Raw lines", s.raw_lines), ("Clean lines", s.lines), ("Fact lines", s.fact),
                            ("Orders", s.fact_orders)])


@query("agg26_supplier_score", f"""SELECT supplier_name, supplier_tier, count(*) AS pos, {S('po_value')},
    {R(M('fill_rate', 3), 6)} AS avg_fill_rate, {R('avg(delay_days)', 6)} AS avg_delay_days FROM s_pos GROUP BY ALL""")
def agg26(s):
    return ag.supplier_score(s.pos, ["supplier_name", "supplier_tier"])


@query("agg27_centroid", f"""SELECT g.zone, {R('avg(lat)', 6)} AS lat, {R('avg(lon)', 6)} AS lon, count(*) AS customers
    FROM s_customers c JOIN s_geo g ON c.city = g.city GROUP BY g.zone""")
def agg27(s):
    placed = s.customers.join(s.geography.select("city", "zone", "lat", "lon"), "city")
    return placed.groupBy("zone").agg(F.round(F.avg("lat"), 6).alias("lat"), F.round(F.avg("lon"), 6).alias("lon"),
                                      F.count(F.lit(1)).alias("customers"))


@query("ord1_sort_by_measure", f"SELECT base_product, {S('net_revenue')} FROM s_daily GROUP BY 1 ORDER BY 2 DESC, 1")
def ord1(s):
    return s.daily.groupBy("base_product").agg(F.round(F.sum("net_revenue"), 2).alias("net_revenue")).orderBy(
        F.col("net_revenue").desc(), "base_product")


@query("ord2_top_k", f"SELECT order_id, {R('sum(line_amount)', 2)} AS amount FROM s_raw_lines GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10")
def ord2(s):
    return s.raw_lines.groupBy("order_id").agg(F.round(F.sum("line_amount"), 2).alias("amount")).orderBy(
        F.col("amount").desc(), "order_id").limit(10)


@query("ord3_distinct_values", "SELECT DISTINCT warehouse_id, sku_id FROM s_snapshots ORDER BY ALL")
def ord3(s):
    return reports.picker(s.snapshots, ["warehouse_id", "sku_id"], ["warehouse_id", "sku_id"])


@query("set1_tagged_union", """SELECT 'orders' AS feed, count(*) AS rows FROM orders UNION ALL
    SELECT 'lines', count(*) FROM lineitem UNION ALL SELECT 'events', count(*) FROM events""")
def set1(s):
    parts = [("orders", s.orders_tbl), ("lines", s.lineitem), ("events", s.events_tbl)]
    return union_all([df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("feed"), "rows") for n, df in parts])


@query("set2_actual_and_forecast", """SELECT 'actual' AS part, week_start, zone, CAST(sum(units) AS DOUBLE) AS units
    FROM s_weekly GROUP BY ALL UNION ALL
    SELECT 'forecast', week_start, zone, """ + R("sum(forecast_units)", 1) + " FROM s_forecast GROUP BY ALL")
def set2(s):
    actual = s.saved_weekly.groupBy("week_start", "zone").agg(F.sum("units").cast("double").alias("units"))
    fc = s.plan.forecast.groupBy("week_start", "zone").agg(F.round(F.sum("forecast_units"), 1).alias("units"))
    return union_all([actual.select(F.lit("actual").alias("part"), "*"), fc.select(F.lit("forecast").alias("part"), "*")])


@query("set3_two_grains", f"SELECT level, series_key, zone, week_start, units, {R('promo_share', 6)} AS promo_share FROM s_both")
def set3(s):
    return s.both_levels.withColumn("promo_share", F.round("promo_share", 6))


