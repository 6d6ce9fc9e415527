"""Window operators (WIN)."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from lakeplan.operators import windows as wn
from lakeplan.operators.dedupe import argmax_per, first_per_key
from lakeplan.operators.rfm import customer_rfm, rfm_scores, rfm_totals
from lakeplan.plans.catalogue import query
from lakeplan.plans.catalogue.joins import price_history
from lakeplan.plans.oracle import B, R
from lakeplan.plans.stand_in import CFG


@query("win1_row_number", """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_suppkey) = 1""")
def win1(s):
    order = [F.col("l_extendedprice").desc(), *[F.col(c).asc() for c in ("l_orderkey", "l_linenumber", "l_suppkey")]]
    return first_per_key(s.lineitem, ["l_partkey"], order).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@query("win2_rolling_cover", f"""SELECT warehouse_id, sku_id, snapshot_date, {R('''avg(demand_units) OVER (PARTITION BY
    warehouse_id, sku_id ORDER BY snapshot_date ROWS BETWEEN 27 PRECEDING AND CURRENT ROW)''', 6)} AS mean_demand FROM s_snapshots""")
def win2(s):
    mean = wn.rolling_mean("demand_units", ["warehouse_id", "sku_id"], "snapshot_date", 28)
    return s.snapshots.select("warehouse_id", "sku_id", "snapshot_date", F.round(mean, 6).alias("mean_demand"))


@query("win3_running_total", f"""SELECT zone, order_date, {B('sum(n) OVER (PARTITION BY zone ORDER BY order_date)')} AS orders_to_date
    FROM (SELECT zone, order_date, count(*) AS n FROM s_fact_orders GROUP BY ALL)""")
def win3(s):
    per_day = s.fact_orders.groupBy("zone", "order_date").agg(F.count(F.lit(1)).alias("n"))
    return per_day.select("zone", "order_date", wn.running_sum("n", ["zone"], "order_date").alias("orders_to_date"))


@query("win4_share_of_group", """SELECT zone, warehouse_id, sku_id, units, share FROM s_wh_share""")
def win4(s):
    from lakeplan.operators.reorder import warehouse_share
    return warehouse_share(s.fact, CFG.as_of)


@query("win5_share_after_group", """SELECT zone, base_product, units / CAST(sum(units) OVER (PARTITION BY zone) AS DOUBLE) AS share
    FROM (SELECT zone, base_product, sum(units) AS units FROM s_daily GROUP BY ALL)""")
def win5(s):
    total = F.sum(F.sum("units")).over(Window.partitionBy("zone"))
    return s.daily.groupBy("zone", "base_product").agg((F.sum("units") / total.cast("double")).alias("share"))


RFM_COLUMNS = ["customer_id", "recency_days", "frequency", "monetary", "r_score", "f_score", "m_score", "rfm_segment"]


@query("win6_global_quintiles", "SELECT customer_id, r_score, f_score, m_score FROM s_rfm_scores")
def win6(s):
    return rfm_scores(rfm_totals(s.fact_orders, CFG.as_of)).select("customer_id", "r_score", "f_score", "m_score")


@query("win6_ntile_orders", """SELECT o_orderkey, CAST(ntile(10) OVER (ORDER BY o_totalprice, o_orderkey) AS INTEGER) AS decile FROM orders""")
def win6_orders(s):
    return wn.global_ntile(s.orders_tbl.select("o_orderkey", "o_totalprice"), 10,
                           [F.col("o_totalprice"), F.col("o_orderkey")], "decile").select("o_orderkey", "decile")


@query("rfm_segments", f"SELECT {', '.join(RFM_COLUMNS)}, zone, city, loyalty_tier, first_order, last_order FROM s_rfm")
def rfm_segments(s):
    out = customer_rfm(s.fact_orders, s.dim_customer, CFG.as_of, ["zone", "city", "loyalty_tier"])
    return out.select(*RFM_COLUMNS, "zone", "city", "loyalty_tier", "first_order", "last_order")


@query("win7_dense_index", """SELECT order_id, channel_code, row_number() OVER (PARTITION BY channel_code
    ORDER BY order_date, order_id) - 1 AS idx FROM s_raw_orders""")
def win7(s):
    rows = s.raw_orders.select("order_id", "channel_code", "order_date")
    return wn.dense_index(rows, ["channel_code"], [F.col("order_date"), F.col("order_id")]).select(
        "order_id", "channel_code", "idx")


@query("win8_scd2", """SELECT sku_id, valid_from, lead(valid_from) OVER (PARTITION BY sku_id ORDER BY valid_from) AS valid_to,
    valid_from = DATE '1999-07-01' AS is_current FROM s_products,
    (VALUES (DATE '1995-01-01'), (DATE '1997-04-01'), (DATE '1999-07-01')) v(valid_from)""")
def win8(s):
    return price_history(s).select("sku_id", "valid_from", "valid_to", "is_current")


@query("win9_cumulative_share", f"""SELECT zone, base_product, {R('hi', 9)} AS cum_hi, {R('hi - share', 9)} AS cum_lo FROM (
    SELECT *, sum(share) OVER (PARTITION BY zone ORDER BY base_product) AS hi FROM (
    SELECT zone, base_product, units / CAST(sum(units) OVER (PARTITION BY zone) AS DOUBLE) AS share FROM (
    SELECT zone, base_product, sum(units) AS units FROM s_daily GROUP BY ALL)))""")
def win9(s):
    units = s.daily.groupBy("zone", "base_product").agg(F.sum("units").alias("units"))
    out = wn.cumulative_intervals(wn.share_of(units, "units", ["zone"]), "share", ["zone"], ["base_product"])
    return out.select("zone", "base_product", F.round("cum_hi", 9).alias("cum_hi"), F.round("cum_lo", 9).alias("cum_lo"))


@query("win10_winner_per_bucket", f"""SELECT zone, order_date, sku_id, units FROM (
    SELECT zone, order_date, sku_id, {B('sum(units)')} AS units FROM s_daily GROUP BY ALL)
    QUALIFY row_number() OVER (PARTITION BY zone, order_date ORDER BY units DESC, sku_id) = 1""")
def win10(s):
    units = s.daily.groupBy("zone", "order_date", "sku_id").agg(F.sum("units").alias("units"))
    return argmax_per(units, ["zone", "order_date"], "units", F.col("sku_id")).select(
        "zone", "order_date", "sku_id", "units")


@query("win11_year_ago", """SELECT sku_id, zone, week_start, units,
    lag(units, 52) OVER (PARTITION BY sku_id, zone ORDER BY week_start) AS year_ago FROM s_grid""")
def win11(s):
    return s.grid.select("sku_id", "zone", "week_start", "units",
                         wn.seasonal_lag("units", ["sku_id", "zone"], "week_start").alias("year_ago"))
