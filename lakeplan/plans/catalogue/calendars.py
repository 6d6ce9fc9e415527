"""Calendar and reference-table builders (CAL)."""

from pyspark.sql import functions as F

from lakeplan.functions.calendar import dim_date, spine_of
from lakeplan.functions.columns import in_season, md5_bucket
from lakeplan.operators import demand as dm
from lakeplan.operators.windows import share_of
from lakeplan.plans.catalogue import query
from lakeplan.plans.oracle import M, R, week
from lakeplan.plans.stand_in import CFG

ZONES = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
# Event reach of the curve check (event -> lead days, uplift, zones) and price revisions.
REACH = {"Harvest": (14, 1.5, "All"), "Lights": (10, 1.8, "ASIA,EUROPE"), "Colour": (7, 1.2, "ASIA"),
         "Spring": (7, 1.1, "EUROPE"), "Kite": (5, 1.3, "AMERICA")}
REVISIONS = [("1997-04-01", None, 0.05), ("1998-10-01", ["Brand#1", "Brand#2"], 0.08), ("2000-04-01", None, 0.04)]
START = "1995-01-01"

DATE_COLUMNS = ("date_key, date, day_name, day_of_week, is_weekend, week_start, iso_week, month, month_name, month_start, "
                "calendar_quarter, calendar_year, fiscal_year, fiscal_quarter, season, is_wedding_season, is_salary_week, "
                "is_actuals_period, is_event_day, event_name")


@query("cal1_dim_date", f"""SELECT {DATE_COLUMNS} FROM s_dim_date WHERE date BETWEEN
    (SELECT min(CAST(o_orderdate AS DATE)) FROM orders) AND (SELECT max(CAST(o_orderdate AS DATE)) FROM orders)""")
def cal1(s):
    """Calendar over the span of the order dates."""
    span = s.raw_orders.agg(F.min("order_date").alias("a"), F.max("order_date").alias("b"))
    return dim_date(spine_of(span, "a", "b").select("date"), s.events, actuals_to=CFG.as_of)


@query("cal1_orders_by_calendar", """SELECT d.fiscal_year, d.fiscal_quarter, d.season, d.is_weekend, d.is_wedding_season,
    d.is_event_day, count(*) AS orders FROM s_raw_orders o JOIN s_dim_date d ON o.order_date = d.date GROUP BY ALL""")
def cal1_orders(s):
    per_day = s.raw_orders.groupBy("order_date").agg(F.count(F.lit(1)).alias("n"))
    dated = per_day.join(s.dim_date, F.col("order_date") == F.col("date"))
    return dated.groupBy("fiscal_year", "fiscal_quarter", "season", "is_weekend", "is_wedding_season", "is_event_day").agg(
        F.sum("n").alias("orders"))


@query("cal2_winner_per_day", """SELECT o.channel_code, o.order_date AS date, count(DISTINCT order_id) AS orders,
    max(w.promo_id) AS promo_id FROM s_raw_orders o LEFT JOIN s_winner w ON w.channel_code = o.channel_code
    AND w.date = o.order_date GROUP BY ALL""", {
    "s_laid": """SELECT channel_code, promo_id, discount_pct, CAST(unnest(generate_series(CAST(start_date AS TIMESTAMP),
        CAST(end_date AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS date FROM (SELECT * FROM s_promos UNION ALL
        SELECT * REPLACE ('X' || promo_id AS promo_id, discount_pct / 2 AS discount_pct) FROM s_promos)""",
    "s_winner": """SELECT * FROM s_laid QUALIFY row_number() OVER (PARTITION BY channel_code, date
        ORDER BY discount_pct DESC, promo_id) = 1"""})
def cal2(s):
    """Two overlapping promotions per window; the larger discount must win each channel-day."""
    weaker = s.promotions.withColumns({"promo_id": F.concat(F.lit("X"), "promo_id"),
                                       "discount_pct": F.col("discount_pct") / 2})
    days = dm.winner_per_day(s.promotions.unionByName(weaker), ["channel_code"], "discount_pct", F.col("promo_id"))
    per_day = s.raw_orders.groupBy("channel_code", F.col("order_date").alias("date")).agg(
        F.countDistinct("order_id").alias("orders"))
    return per_day.join(days.select("channel_code", "date", "promo_id"), ["channel_code", "date"], "left").select(
        "channel_code", "date", "orders", "promo_id")


def multipliers(s):
    events = s.events
    for i, name in enumerate(("lead_days", "uplift", "zones")):
        pick = F.create_map(*[F.lit(x) for k, v in REACH.items() for x in (k, v[i])])
        events = events.withColumn(name, pick[F.col("event_name")])
    per_day = s.fact_orders.groupBy("order_date", "zone").agg(F.count(F.lit(1)).alias("orders"))
    curve = dm.event_multiplier(events, ZONES).withColumnRenamed("date", "order_date")
    return per_day.join(curve, ["order_date", "zone"], "left").withColumn(
        "multiplier", F.coalesce("multiplier", F.lit(1.0)))


REACH_SQL = ", ".join(f"('{k}', {a}, {b}::DOUBLE, '{z}')" for k, (a, b, z) in REACH.items())
CURVE = {
    "s_reach": f"""SELECT e.event_date + CAST(off AS INTEGER) AS order_date, zone, off, lead_days, uplift,
        (zones = 'All' OR list_contains(string_split(zones, ','), zone)) AS own
        FROM s_events e JOIN (VALUES {REACH_SQL}) r(event_name, lead_days, uplift, zones) ON r.event_name = e.event_name,
        range(-14, 11) o(off), (SELECT r_name AS zone FROM region) WHERE off >= -lead_days""",
    "s_curve": """SELECT order_date, zone, CAST(round(product((CASE WHEN off >= 3 AND own THEN 1 - 0.12::DOUBLE * (1 - (off - 3) / 8) ELSE 1 END) *
        (1 + (uplift - 1) * (CASE WHEN off BETWEEN -7 AND 0 THEN 1 WHEN off < -7 THEN 0.5 WHEN off BETWEEN 1 AND 2 THEN 0.3 ELSE 0 END)
        * CASE WHEN own THEN 1 ELSE 0.25 END)), 9) AS DOUBLE) AS m FROM s_reach GROUP BY ALL""",
    "s_mult": """SELECT o.order_date, o.zone, o.orders, coalesce(c.m, 1) AS multiplier FROM (SELECT order_date, zone,
        count(*) AS orders FROM s_fact_orders GROUP BY ALL) o LEFT JOIN s_curve c ON c.order_date = o.order_date AND c.zone = o.zone""",
}


@query("cal3_event_curve", f"SELECT order_date, zone, orders, {R('multiplier', 6)} AS multiplier FROM s_mult", CURVE)
def cal3(s):
    return multipliers(s).withColumn("multiplier", F.round("multiplier", 6))


@query("cal4_season_flag", """SELECT order_date, count(*) AS orders, (strftime(order_date, '%m-%d') >= '11-15'
    OR strftime(order_date, '%m-%d') <= '02-28' OR strftime(order_date, '%m-%d') BETWEEN '04-15' AND '05-31') AS in_season
    FROM s_raw_orders GROUP BY ALL""")
def cal4(s):
    from lakeplan.functions.calendar import WEDDING_WINDOWS
    return s.raw_orders.groupBy("order_date").agg(F.count(F.lit(1)).alias("orders")).withColumn(
        "in_season", in_season("order_date", WEDDING_WINDOWS))


@query("cal5_weekly_mean", f"""SELECT {week('order_date')} AS week_start, zone, {R(M('multiplier', 9), 6)} AS multiplier
    FROM s_mult GROUP BY ALL""", CURVE)
def cal5(s):
    return dm.weekly_mean(multipliers(s), "multiplier", ["zone"], "order_date").withColumn(
        "multiplier", F.round("multiplier", 6))


@query("cal6_normalise", """SELECT zone, base_product, units / CAST(sum(units) OVER (PARTITION BY zone) AS DOUBLE) AS p FROM (
    SELECT zone, base_product, sum(units) AS units FROM s_daily GROUP BY ALL)""")
def cal6(s):
    units = s.daily.groupBy("zone", "base_product").agg(F.sum("units").alias("units"))
    return share_of(units, "units", ["zone"], "p").select("zone", "base_product", "p")


LAID = {
    "s_mix": """SELECT zone, base_product, units / CAST(sum(units) OVER (PARTITION BY zone) AS DOUBLE) AS share
        FROM (SELECT zone, base_product, sum(units) AS units FROM s_daily GROUP BY ALL)""",
    "s_laid": """SELECT *, round(sum(share) OVER w, 12) AS hi, round(sum(share) OVER w - share, 12) AS lo FROM s_mix
        WINDOW w AS (PARTITION BY zone ORDER BY base_product ROWS UNBOUNDED PRECEDING)""",
}


@query("cal7_bucket_allocate", """SELECT o.order_id, o.zone, l.base_product FROM (SELECT order_id, zone,
        (('0x' || left(md5(CAST(order_id AS VARCHAR)), 8))::BIGINT % 4000 + 0.5) / 4000::DOUBLE AS point FROM s_fact_orders) o
    LEFT JOIN s_laid l ON o.zone = l.zone AND point >= lo AND point < hi""", LAID)
def cal7(s):
    """Every order gets a product in proportion to its zone's mix."""
    units = s.daily.groupBy("zone", "base_product").agg(F.sum("units").alias("units"))
    mix = share_of(units, "units", ["zone"]).select("zone", "base_product", "share")
    return dm.bucket_allocate(s.fact_orders.select("order_id", "zone"), mix, ["zone"], "base_product", "share", ["order_id"],
                              bucket_of=md5_bucket)


REVISION_SQL = "(VALUES " + ", ".join(
    f"({i}, DATE '{d}', {change}::DOUBLE, {'NULL' if c is None else repr(','.join(c))})"
    for i, (d, c, change) in enumerate(REVISIONS, 1)) + ") r(no, day, change, codes)"
PRICES = {
    "s_applied": f"""SELECT p.sku_id, p.mrp, r.day, r.change, row_number() OVER (PARTITION BY p.sku_id ORDER BY r.day) AS i
        FROM s_products p, {REVISION_SQL} WHERE codes IS NULL OR list_contains(string_split(codes, ','), p.base_code)""",
    "s_prices": """SELECT sku_id, valid_from, lead(valid_from) OVER (PARTITION BY sku_id ORDER BY valid_from) AS valid_to,
        CAST(round(CAST(CAST(mrp AS VARCHAR) AS DECIMAL(20,10)) * CAST(CAST(f AS VARCHAR) AS DECIMAL(18,8)), 0) AS DOUBLE) AS mrp FROM (
        SELECT sku_id, DATE '1995-01-01' AS valid_from, mrp, 1::DOUBLE AS f FROM s_products UNION ALL
        SELECT a.sku_id, a.day, a.mrp, round((SELECT product(1 + b.change) FROM s_applied b WHERE b.sku_id = a.sku_id AND b.i <= a.i), 8)
        FROM s_applied a)""",
}


def revised(s):
    return dm.apply_revisions(s.products, REVISIONS, START)


@query("cal8_price_revisions", "SELECT sku_id, valid_from, valid_to, mrp, valid_to IS NULL AS is_current FROM s_prices", PRICES)
def cal8(s):
    return revised(s)


@query("cal9_cost_from_index", f"""SELECT p.sku_id, m.month, h.mrp, {R('''p.mrp * 0.5::DOUBLE * (0.7::DOUBLE * m.price_index +
    (1 - 0.7::DOUBLE) * power(1.04::DOUBLE, (m.month - DATE '1995-01-01') / 365.0::DOUBLE))''', 2)} AS unit_cost
    FROM s_products p JOIN s_materials m ON m.base_code = p.base_code LEFT JOIN s_prices h ON h.sku_id = p.sku_id
    AND h.valid_from <= m.month + 14 AND (h.valid_to IS NULL OR m.month + 14 < h.valid_to)""", PRICES)
def cal9(s):
    months = s.months(s.products.select("sku_id", "base_code", F.col("mrp").alias("base_mrp"), F.lit(0.5).alias("cost_ratio")),
                      START)
    return dm.cost_from_index(months, revised(s), s.materials, START)


@query("cal10_explode_units", """SELECT order_id, CAST(i AS INTEGER) AS unit_no, order_id || '-' || lpad(CAST(i AS VARCHAR), 2, '0') AS unit_id
    FROM (SELECT order_id, unnest(generate_series(1, count(*))) AS i FROM s_raw_lines GROUP BY order_id)""")
def cal10(s):
    counted = s.raw_lines.groupBy("order_id").agg(F.count(F.lit(1)).alias("n"))
    return dm.explode_units(counted, "n", "order_id").select("order_id", "unit_no", "unit_id")


