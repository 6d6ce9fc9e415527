"""Joins (JON)."""

from pyspark.sql import functions as F

from lakeplan.operators import joins as jn
from lakeplan.operators.windows import scd2
from lakeplan.plans.catalogue import query
from lakeplan.plans.oracle import R
from lakeplan.plans.stand_in import CFG

# Five sites (id, latitude, longitude) of the nearest-site check.
SITES = [("A", 10.5, 70.5), ("B", 14.25, 80.0), ("C", 20.0, 93.5), ("D", 26.0, 104.0), ("E", 31.5, 116.0)]
HISTORY_CUTS = ("1997-04-01", "1999-07-01")


@query("jon1_inner_dims", """SELECT o.order_id, s.zone, s.state, o.channel_code FROM s_orders o
    JOIN s_stores s ON o.store_id = s.store_id""")
def jon1(s):
    places = s.stores.select("store_id", "zone", "state")
    return jn.lookup(s.orders, places, "store_id").select("order_id", "zone", "state", "channel_code")


@query("jon2_left_enrich", """SELECT c.customer_id, c.full_name, c.zone, c.tier FROM s_dim_customer c""")
def jon2(s):
    return s.dim_customer.select("customer_id", "full_name", "zone", "tier")


@query("jon3_composite_month", """SELECT l.line_id, l.sku_id, c.unit_cost FROM s_lines l LEFT JOIN s_costs c
    ON l.sku_id = c.sku_id AND c.month = date_trunc('month', l.order_date)""")
def jon3(s):
    return jn.monthly_lookup(s.lines, s.costs, ["sku_id"], "order_date").select("line_id", "sku_id", "unit_cost")


@query("jon4_known_key", "SELECT line_id, l_partkey, l_suppkey, sku_known FROM s_ranked")
def jon4(s):
    return jn.flag_known(s.raw_lines, s.products, "sku_id", "sku_known").select(
        "line_id", "l_partkey", "l_suppkey", "sku_known")


@query("jon5_exists_flag", """SELECT l.line_id, l.line_id IN (SELECT line_id FROM s_returns) AS is_returned FROM s_lines l""")
def jon5(s):
    return jn.exists_flag(s.lines, s.returns, "line_id", "is_returned").select("line_id", "is_returned")


@query("jon6_anti_orphans", """SELECT sku_id, count(*) AS rows FROM s_raw_lines
    WHERE sku_id NOT IN (SELECT sku_id FROM s_products) GROUP BY sku_id""")
def jon6(s):
    return jn.orphans(s.raw_lines, s.products, "sku_id")


@query("jon7_keyed_range", f"""SELECT p.promo_id, d.order_date, {R('sum(d.net_revenue)', 2)} AS net_revenue FROM s_promos p
    JOIN s_daily d ON d.channel_code = p.channel_code AND d.order_date BETWEEN p.start_date - 28 AND p.end_date GROUP BY ALL""")
def jon7(s):
    per_day = s.daily.groupBy("order_date", "channel_code").agg(F.round(F.sum("net_revenue"), 2).alias("net_revenue"))
    return jn.event_window_join(s.promotions, per_day, "start_date", "end_date", 28, ["channel_code"]).select(
        "promo_id", "order_date", "net_revenue")


@query("jon8_pure_range", f"""SELECT e.event_name, e.event_date, d.order_date, d.zone, {R('sum(d.net_revenue)', 2)} AS net_revenue
    FROM s_events e JOIN s_daily d ON d.order_date BETWEEN e.event_date - 60 AND e.event_date GROUP BY ALL""")
def jon8(s):
    per_day = s.daily.groupBy("order_date", "zone").agg(F.round(F.sum("net_revenue"), 2).alias("net_revenue"))
    return jn.event_window_join(s.events, per_day, "event_date", "event_date", 60, []).select(
        "event_name", "event_date", "order_date", "zone", "net_revenue")


@query("jon9_trailing_weeks", """SELECT c.cutoff, w.sku_id, w.zone, CAST(sum(w.units) AS BIGINT) AS units FROM
    (SELECT CAST(DATE '2001-07-23' - 84 * k AS DATE) AS cutoff FROM (VALUES (0), (1), (2), (3)) f(k)) c
    JOIN s_weekly w ON w.week_start > c.cutoff - 84 AND w.week_start <= c.cutoff GROUP BY ALL""")
def jon9(s):
    """The last full week and the three fold ends before it."""
    cutoffs = s.spark.range(CFG.folds + 1).select(
        F.expr(f"date_sub(DATE'{CFG.last_full_week}', CAST(id AS int) * {7 * CFG.horizon_weeks})").alias("cutoff"))
    return jn.trailing_join(cutoffs, s.weekly, 12).groupBy("cutoff", "sku_id", "zone").agg(F.sum("units").alias("units"))


@query("jon10_grid", """SELECT o.o_orderkey, v.payment, o.o_totalprice * v.weight AS part FROM orders o,
    (VALUES ('card', 0.5::DOUBLE), ('cash', 0.25::DOUBLE), ('wallet', 0.25::DOUBLE)) v(payment, weight)""")
def jon10(s):
    weights = F.create_map(F.lit("card"), F.lit(0.5), F.lit("cash"), F.lit(0.25), F.lit("wallet"), F.lit(0.25))
    return jn.grid_with(s.orders_tbl, ["card", "cash", "wallet"], "payment").select(
        "o_orderkey", "payment", (F.col("o_totalprice") * weights[F.col("payment")]).alias("part"))


@query("jon11_active_grid", """SELECT d.date, count(*) AS open_stores FROM s_stores s JOIN s_days d
    ON d.date >= s.opened_date AND (s.closed_date IS NULL OR d.date < s.closed_date) GROUP BY d.date""")
def jon11(s):
    """Stores with equal life spans are counted together before their days are laid out."""
    spans = s.stores.groupBy("opened_date", "closed_date").agg(F.count(F.lit(1)).alias("n"))
    return jn.active_days(spans, "opened_date", "closed_date", CFG.calendar_end, CFG.calendar_start).groupBy("date").agg(
        F.sum("n").alias("open_stores"))


@query("jon12_shifted_date", f"""SELECT d.order_date, d.zone, d.n AS orders, coalesce(e.n, 0) AS orders_in_10_days FROM
    (SELECT order_date, zone, count(*) AS n FROM s_fact_orders GROUP BY ALL) d LEFT JOIN
    (SELECT order_date, zone, count(*) AS n FROM s_fact_orders GROUP BY ALL) e
    ON e.zone = d.zone AND e.order_date = d.order_date + 10""")
def jon12(s):
    per_day = s.fact_orders.groupBy("order_date", "zone").agg(F.count(F.lit(1)).alias("orders"))
    ahead = per_day.select("zone", F.col("order_date").alias("day"), F.col("orders").alias("orders_in_10_days"))
    return jn.shifted_join(per_day, ahead, "order_date", 10, ["zone"], "orders_in_10_days", "day", 0)


@query("jon13_checked_broadcast", """SELECT n_name, count(*) AS customers FROM customer JOIN nation
    ON c_nationkey = n_nationkey GROUP BY 1""")
def jon13(s):
    return jn.lookup(s.customer, s.nation, F.col("c_nationkey") == F.col("n_nationkey")).groupBy("n_name").agg(
        F.count(F.lit(1)).alias("customers"))


def price_history(s):
    """Three price versions per SKU: list price, then +5 % and +10 %."""
    steps = F.array(*[F.struct(F.lit(d).cast("date").alias("valid_from"), F.lit(m).alias("factor")) for d, m in
                      [("1995-01-01", 1.0), (HISTORY_CUTS[0], 1.05), (HISTORY_CUTS[1], 1.10)]])
    base = s.products.select("sku_id", "mrp", F.inline(steps))
    versions = base.select("sku_id", "valid_from", F.round(
        F.col("mrp").cast("decimal(12,4)") * F.col("factor").cast("decimal(6,4)"), 2).cast("double").alias("price"))
    return scd2(versions, "sku_id")


@query("jon14_asof_price", f"""SELECT r.line_id, r.l_partkey, r.l_suppkey, CAST(round(CAST(p.mrp AS DECIMAL(12,4)) *
    CASE WHEN r.order_date >= DATE '{HISTORY_CUTS[1]}' THEN 1.1000 WHEN r.order_date >= DATE '{HISTORY_CUTS[0]}' THEN 1.0500
    ELSE 1.0000 END, 2) AS DOUBLE) AS price FROM s_raw_lines r LEFT JOIN s_products p ON r.sku_id = p.sku_id""")
def jon14(s):
    return jn.asof_price(s.raw_lines, price_history(s), "sku_id", "order_date").select(
        "line_id", "l_partkey", "l_suppkey", "price")


KM = ("12742 * asin(sqrt(least(1.0, power(sin(radians(s.lat - g.lat) / 2), 2) + cos(radians(g.lat)) * cos(radians(s.lat)) * "
      "power(sin(radians(s.lon - g.lon) / 2), 2))))")
SITES_SQL = "(VALUES " + ", ".join(f"('{a}', {b}::DOUBLE, {c}::DOUBLE)" for a, b, c in SITES) + ") s(site, lat, lon)"


@query("jon15_nearest_site", f"""SELECT customer_id, site FROM (SELECT c.customer_id, s.site, g.zone,
    row_number() OVER (PARTITION BY c.customer_id ORDER BY CASE WHEN g.zone = 'ASIA' THEN CASE WHEN s.site = 'E' THEN 0 ELSE 1 END
    ELSE 0 END, {R(KM, 6)}, s.site) AS rn FROM s_customers c JOIN s_geo g ON c.city = g.city, {SITES_SQL}) WHERE rn = 1""")
def jon15(s):
    points = jn.lookup(s.customers, s.geography.select("city", "zone", "lat", "lon"), "city")
    return jn.nearest(points, SITES, override={"ASIA": "E"}).select("customer_id", "site")


@query("jon16_using", """SELECT channel_code, channel_name, count(*) AS orders FROM s_orders JOIN s_channels
    USING (channel_code) GROUP BY ALL""")
def jon16(s):
    return s.orders.join(s.channels, on="channel_code").groupBy("channel_code", "channel_name").agg(
        F.count(F.lit(1)).alias("orders"))


@query("jon17_sales_fact", "SELECT * REPLACE (strftime(order_ts, '%Y-%m-%d %H:%M:%S') AS order_ts) FROM s_fact")
def jon17(s):
    return s.fact.withColumn("order_ts", F.date_format("order_ts", "yyyy-MM-dd HH:mm:ss"))


