"""SQL building blocks of the DuckDB checks: the stand-in layers as common table expressions."""

from __future__ import annotations

import re

from lakeplan.plans.stand_in import CHANNELS, DECISIONS, EVENTS, GROUP_A, PACKS, PROMOS, SEGMENT_WAREHOUSE


def R(expr: str, digits: int) -> str:
    """Round half up on the shortest decimal text of a double, as Spark's ``round`` does."""
    return f"CAST(round(CAST(CAST(({expr}) AS VARCHAR) AS DECIMAL(38,17)), {digits}) AS DOUBLE)"


def S(column: str, digits: int = 2) -> str:
    return f"{R(f'sum({column})', digits)} AS {column}"


def M(expr: str, digits: int = 6) -> str:
    """Mean from a rounded sum."""
    return f"({R(f'sum({expr})', digits)} / nullif(count({expr}), 0))"


def W(fc: str, op: str = "abs(actual - {})") -> str:
    """Error sum over actual sum."""
    return f"({R('sum(' + op.format(fc) + ')', 6)} / nullif(sum(actual), 0))"


def I(num: str, den: str) -> str:  # noqa: E743
    """num / den cents, rounded half up, as an amount; exact in integers."""
    return f"(floor((2 * ({num}) + ({den})) / (2.0 * ({den}))) / 100.0)"


def B(expr: str) -> str:
    return f"CAST({expr} AS BIGINT)"


def lit(v) -> str:
    return "NULL" if v is None else repr(v) if isinstance(v, str) else str(v)


def values(rows, columns: str, dates: tuple[int, ...] = ()) -> str:
    body = ", ".join(
        "(" + ", ".join(f"DATE {lit(v)}" if i in dates else lit(v) for i, v in enumerate(r)) + ")" for r in rows)
    return f"SELECT * FROM (VALUES {body}) v({columns})"


def case_map(column: str, mapping: dict) -> str:
    return f"CASE {column} " + " ".join(f"WHEN {lit(k)} THEN {lit(v)}" for k, v in mapping.items()) + " END"


WEEK = "CAST(date_trunc('week', {}) AS DATE)"
MONTH = "CAST(date_trunc('month', {}) AS DATE)"


def week(c: str) -> str:
    return WEEK.format(c)


def month(c: str) -> str:
    return MONTH.format(c)


def ratio(a: str, b: str) -> str:
    return f"CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0)"


def fiscal_year(d: str) -> str:
    y = f"(year({d}) - CASE WHEN month({d}) >= 4 THEN 0 ELSE 1 END)"
    return (f"'FY' || lpad(CAST({y} % 100 AS VARCHAR), 2, '0') || '-' || "
            f"lpad(CAST(({y} + 1) % 100 AS VARCHAR), 2, '0')")


KNOWN_GROUP = "(" + ", ".join(lit(b) for b in GROUP_A) + ")"
PRODUCT_GROUP = f"CASE WHEN base_code IN {KNOWN_GROUP} THEN 'Group A' ELSE 'Other' END"
AS_OF = "DATE '2001-07-31'"
LAST_WEEK = "DATE '2001-07-23'"
FIRST_FC = "DATE '2001-07-30'"
SERIES = "level, series_key, zone"

CTES: dict[str, str] = {
    "s_channels": values(CHANNELS, "channel_code, channel_name, channel_group"),
    "s_events": "SELECT *, CAST(year(event_date) AS INTEGER) AS year, 'All' AS region_relevance FROM ("
                + values(EVENTS, "event_name, event_date", (1,)) + ")",
    "s_promos": values(PROMOS, "promo_id, promo_code, promo_name, promo_type, discount_pct, start_date, end_date, "
                               "channel_code, category_scope, event_name", (5, 6)),
    "s_geo": """SELECT 'CITY_' || CAST(n_nationkey AS VARCHAR) AS city, n_name AS state, r_name AS zone,
        CASE WHEN n_nationkey < 8 THEN 1 WHEN n_nationkey < 16 THEN 2 ELSE 3 END AS tier,
        CAST(8 + n_nationkey AS DOUBLE) AS lat, CAST(68 + 2 * n_nationkey AS DOUBLE) AS lon, n_nationkey AS city_id
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "s_warehouses": "SELECT 'WH-' || r_name AS warehouse_id, r_name || ' DC' AS warehouse_name, r_name AS zone FROM region",
    "s_products": f"""SELECT p_brand || '|' || p_type AS sku_id, p_brand || ' ' || p_type AS product_name,
        p_brand AS base_code, p_brand AS base_product, p_type AS category, {case_map('p_type', PACKS)} AS pack_size,
        max(p_retailprice) AS mrp, CASE WHEN p_type = 'PROMO' THEN 15 ELSE 5 END AS tax,
        p_type = 'PROMO' AS is_organic, DATE '1994-01-01' AS launch_date FROM part GROUP BY p_brand, p_type""",
    "s_dim_product": """SELECT *, CASE WHEN pack_size <= 50 THEN 'Small (<=50g)' WHEN pack_size <= 200
        THEN 'Medium (100-200g)' ELSE 'Bulk (500g-1kg)' END AS pack_band FROM s_products""",
    "s_months": """SELECT CAST(m AS DATE) AS month
        FROM generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '2001-12-01', INTERVAL 1 MONTH) g(m)""",
    "s_costs": """SELECT sku_id, month, CAST(round(CAST(mrp AS DECIMAL(12,4)) *
        CAST(0.5 + month(month) / 100.0 AS DECIMAL(6,4)), 2) AS DOUBLE) AS unit_cost
        FROM s_products, s_months WHERE month >= DATE '1995-06-01'""",
    "s_materials": f"""SELECT base_code, month, {R('1 + month(month) / 100.0', 2)} AS price_index,
        CAST(100 + month(month) AS DOUBLE) AS price_per_kg
        FROM (SELECT DISTINCT p_brand AS base_code FROM part), s_months""",
    "s_suppliers": """SELECT s_suppkey AS supplier_id, s_name AS supplier_name,
        CASE WHEN s_acctbal >= 0 THEN 'Primary' ELSE 'Alternate' END AS supplier_tier FROM supplier""",
    "s_site": """SELECT s_suppkey, 'WH-' || r_name AS warehouse_id FROM supplier
        JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "s_days": """SELECT CAST(d AS DATE) AS date
        FROM generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '2001-12-31', INTERVAL 1 DAY) g(d)""",
    "s_event_names": """SELECT event_date, string_agg(event_name, ' / ' ORDER BY event_name) AS event_name
        FROM (SELECT DISTINCT event_date, event_name FROM s_events) GROUP BY event_date""",
    "s_dim_date": f"""SELECT CAST(strftime(date, '%Y%m%d') AS INTEGER) AS date_key, date, dayname(date) AS day_name,
        CAST(dayofweek(date) + 1 AS INTEGER) AS day_of_week, dayofweek(date) IN (0, 6) AS is_weekend,
        {week('date')} AS week_start, CAST(weekofyear(date) AS INTEGER) AS iso_week, CAST(month(date) AS INTEGER) AS month,
        left(monthname(date), 3) AS month_name, {month('date')} AS month_start,
        CAST(quarter(date) AS INTEGER) AS calendar_quarter, CAST(year(date) AS INTEGER) AS calendar_year,
        {fiscal_year('date')} AS fiscal_year,
        'Q' || CAST(((month(date) + 8) % 12) // 3 + 1 AS VARCHAR) AS fiscal_quarter,
        CASE WHEN month(date) IN (3, 4, 5) THEN 'Summer' WHEN month(date) IN (6, 7, 8, 9) THEN 'Monsoon'
             WHEN month(date) IN (10, 11) THEN 'Post-Monsoon' ELSE 'Winter' END AS season,
        (strftime(date, '%m-%d') >= '11-15' OR strftime(date, '%m-%d') <= '02-28'
         OR strftime(date, '%m-%d') BETWEEN '04-15' AND '05-31') AS is_wedding_season,
        dayofmonth(date) <= 7 AS is_salary_week, date <= {AS_OF} AS is_actuals_period,
        e.event_name IS NOT NULL AS is_event_day, e.event_name
        FROM s_days LEFT JOIN s_event_names e ON date = e.event_date""",
    "s_raw_stores": f"""SELECT c_custkey AS store_id, c_name AS store_name, c_mktsegment AS store_type,
        'CITY_' || CAST(c_nationkey AS VARCHAR) AS city,
        CASE WHEN c_acctbal < 0 THEN 'Nation ' || CAST(c_nationkey AS VARCHAR)
             WHEN c_acctbal > 9000 THEN ' ' || n_name ELSE n_name END AS state,
        {case_map('c_mktsegment', SEGMENT_WAREHOUSE)} AS warehouse_id, DATE '1994-06-01' AS opened_date,
        CASE WHEN c_acctbal > 9500 THEN DATE '2001-01-01' END AS closed_date
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "s_std_stores": """SELECT * REPLACE (CASE WHEN trim(state) LIKE 'Nation %' THEN 'NATION_' || substr(trim(state), 8)
        ELSE trim(state) END AS state), state AS state_raw FROM s_raw_stores""",
    "s_stores": """SELECT s.* EXCLUDE (state_raw), s.state <> s.state_raw AS state_was_corrected, g.zone, g.tier, g.city_id
        FROM s_std_stores s LEFT JOIN s_geo g ON s.city = g.city AND s.state = g.state""",
    "s_customers": """SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS full_name, 'CITY_' || CAST(c_nationkey AS VARCHAR) AS city,
        n_name AS state, c_mktsegment AS loyalty_tier, c_acctbal FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "s_dim_customer": """SELECT c.*, g.zone, g.tier FROM s_customers c LEFT JOIN s_geo g
        ON c.city = g.city AND c.state = g.state""",
    "s_raw_orders": """SELECT o_orderkey AS order_id, o_orderdate AS order_ts, CAST(o_orderdate AS DATE) AS order_date,
        CASE WHEN o_totalprice >= 2500 THEN o_custkey END AS store_id, o_orderpriority AS channel_code,
        CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(o_custkey AS VARCHAR) END AS customer_id,
        CASE WHEN o_totalprice >= 250000 THEN 'Credit' ELSE 'Cash' END AS payment_mode,
        CASE WHEN o_totalprice > 499000 THEN 'Lost' WHEN o_orderstatus = 'P' THEN 'Cancelled' ELSE 'Delivered' END
        AS order_status FROM orders""",
    "s_orders": "SELECT * FROM s_raw_orders WHERE store_id IS NOT NULL AND order_status IN ('Delivered', 'Cancelled')",
    "s_line_base": """SELECT l.*, CAST(o_orderdate AS DATE) AS order_date, CAST(l_shipdate AS DATE) AS ship_date,
        p_brand, p_type, p_size, p_retailprice,
        CASE WHEN p_size > 45 THEN 'X-' || p_brand ELSE p_brand || '|' || p_type END AS sku_id,
        CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS line_id,
        CAST(round(l_extendedprice * 100) AS BIGINT) AS ext_c, CAST(round(l_discount * 100) AS BIGINT) AS disc_c,
        CAST(l_quantity AS BIGINT) AS qty
        FROM lineitem l JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey""",
    "s_raw_lines": f"""SELECT line_id, l_orderkey AS order_id, l_linenumber AS line_no, order_date, sku_id,
        CAST(CASE WHEN l_quantity = 50 THEN -50 ELSE qty END AS INTEGER) AS quantity, p_retailprice AS unit_mrp,
        CASE WHEN ext_c >= 95000 THEN {I('ext_c', 'qty')} END AS unit_price,
        CASE WHEN l_discount >= 0.08 THEN 'PROMO-8' WHEN l_discount >= 0.05 THEN 'PROMO-5' END AS promo_code,
        l_discount AS discount_pct, {I('ext_c * (100 - disc_c)', '100')} AS line_amount,
        strftime(l_shipdate, '%Y-%m') AS batch, l_shipdate, l_partkey, l_suppkey, l_extendedprice, disc_c
        FROM s_line_base""",
    "s_ranked": """SELECT r.*, row_number() OVER (PARTITION BY line_id
        ORDER BY l_shipdate, l_partkey, l_suppkey, l_extendedprice) AS rn,
        r.sku_id IN (SELECT sku_id FROM s_products) AS sku_known FROM s_raw_lines r""",
    "s_lines": """SELECT *, batch <> strftime(order_date, '%Y-%m') AS arrived_late FROM s_ranked
        WHERE rn = 1 AND quantity > 0 AND sku_known AND unit_price IS NOT NULL""",
    "s_rejected": """SELECT *, CASE WHEN rn > 1 THEN 'duplicate line' WHEN quantity <= 0 THEN 'non-positive quantity'
        WHEN NOT sku_known THEN 'unknown sku' ELSE 'missing price' END AS dq_reason FROM s_ranked
        WHERE rn > 1 OR quantity <= 0 OR NOT sku_known OR unit_price IS NULL""",
    "s_rejected_orders": """SELECT *, CASE WHEN store_id IS NULL THEN 'missing store_id' ELSE 'invalid status' END AS dq_reason
        FROM s_raw_orders WHERE store_id IS NULL OR order_status NOT IN ('Delivered', 'Cancelled')""",
    "s_raw_returns": """SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS return_id,
        line_id, l_orderkey AS order_id, sku_id, ship_date AS return_date,
        CAST(CASE WHEN l_discount >= 0.1 THEN 0 ELSE qty END AS INTEGER) AS return_qty,
        CASE WHEN l_linestatus = 'F' THEN 'Damaged' ELSE 'Wrong item' END AS return_reason,
        l_extendedprice AS refund_amount FROM s_line_base WHERE l_returnflag = 'R'""",
    "s_returns": "SELECT * FROM s_raw_returns WHERE return_qty > 0",
    "s_fact_base": """SELECT l.*, o.order_ts, o.store_id, o.channel_code, o.customer_id, o.order_status, o.payment_mode,
        p.category, p.base_product, p.base_code, p.pack_size, p.tax, s.warehouse_id, s.zone, s.state, s.city,
        CAST(round(line_amount * 100) AS BIGINT) AS a_c, CAST(round(unit_price * 100) AS BIGINT) AS p_c,
        CAST(quantity AS BIGINT) AS q, CAST(round(c.unit_cost * 100) AS BIGINT) AS c_c,
        l.line_id IN (SELECT line_id FROM s_returns) AS is_returned
        FROM s_lines l JOIN s_orders o ON l.order_id = o.order_id JOIN s_products p ON l.sku_id = p.sku_id
        JOIN s_stores s ON o.store_id = s.store_id
        LEFT JOIN s_costs c ON c.sku_id = l.sku_id AND c.month = date_trunc('month', l.order_date)""",
    "s_fact": f"""SELECT line_id, order_id, line_no, order_date, order_ts, CAST(strftime(order_date, '%Y%m%d') AS INTEGER) AS date_key,
        sku_id, category, base_product, base_code, store_id, channel_code, customer_id, warehouse_id, zone, state, city,
        promo_code, order_status, payment_mode, quantity, {R('q * pack_size / 1000.0', 3)} AS volume_kg, unit_mrp,
        unit_price, discount_pct, q * p_c / 100.0 AS gross_amount, line_amount, {I('a_c * 100', '100 + tax')} AS net_revenue,
        {I('a_c * tax', '100 + tax')} AS tax_amount, {I('q * p_c * disc_c', '100 + tax')} AS discount_amount,
        q * c_c / 100.0 AS cogs, {I('a_c * 100 - q * c_c * (100 + tax)', '100 + tax')} AS gross_margin, is_returned
        FROM s_fact_base""",
    "s_fact_orders": f"""SELECT order_id, order_date, max(order_ts) AS order_ts, max(store_id) AS store_id, max(channel_code) AS channel_code,
        max(customer_id) AS customer_id, max(zone) AS zone, max(state) AS state, max(city) AS city,
        max(order_status) AS order_status, max(payment_mode) AS payment_mode, count(*) AS line_count,
        {B('sum(quantity)')} AS units, {S('volume_kg', 3)}, {S('net_revenue')}, {S('gross_margin')},
        bool_or(promo_code IS NOT NULL) AS used_promo FROM s_fact GROUP BY order_id, order_date""",
    "s_daily": f"""SELECT f.order_date, f.sku_id, f.category, f.base_product, f.zone, f.channel_code, c.channel_name,
        c.channel_group, count(*) AS lines, count(DISTINCT f.order_id) AS orders, {B('sum(f.quantity)')} AS units,
        {S('volume_kg')}, {S('gross_amount')}, {S('net_revenue')}, {S('discount_amount')}, {S('cogs')},
        {S('gross_margin')}, {S('tax_amount')},
        {R('sum(CASE WHEN promo_code IS NOT NULL THEN net_revenue ELSE 0 END)', 2)} AS promo_revenue,
        {B('sum(CASE WHEN is_returned THEN 1 ELSE 0 END)')} AS returned_lines
        FROM s_fact f JOIN s_channels c ON f.channel_code = c.channel_code WHERE f.order_status = 'Delivered'
        GROUP BY ALL""",
    "s_monthly": f"""SELECT {month('f.order_date')} AS month, d.fiscal_year, f.category, f.zone, f.state, f.channel_code,
        count(DISTINCT f.order_id) AS orders, {B('sum(f.quantity)')} AS units, {S('volume_kg')}, {S('net_revenue')},
        {S('gross_margin')}, {S('discount_amount')} FROM s_fact f JOIN s_dim_date d ON f.order_date = d.date
        WHERE f.order_status = 'Delivered' GROUP BY ALL""",
    "s_weekly": f"""SELECT week_start, sku_id, zone, units, net_revenue,
        {R(ratio('promo', 'net_revenue'), 4)} AS promo_share FROM (
        SELECT {week('order_date')} AS week_start, sku_id, zone, {B('sum(units)')} AS units, {S('net_revenue')},
        {R('sum(promo_revenue)', 2)} AS promo FROM s_daily GROUP BY ALL)""",
    "s_margin": f"""SELECT m.month, m.base_code, m.base_product, m.category, m.net_revenue, m.gross_margin,
        {R('100 * (' + ratio('m.gross_margin', 'm.net_revenue') + ')', 2)} AS gross_margin_pct,
        r.price_index AS raw_material_index, r.price_per_kg AS raw_material_price_per_kg FROM (
        SELECT {month('order_date')} AS month, base_code, base_product, category, {S('net_revenue')}, {S('gross_margin')}
        FROM s_fact WHERE order_status = 'Delivered' GROUP BY ALL) m
        LEFT JOIN s_materials r ON r.base_code = m.base_code AND r.month = m.month""",
    "s_promo_effect": f"""SELECT promo_id, promo_code, promo_name, promo_type, channel_code, category_scope, event_name,
        discount_pct, start_date, end_date, {R('p', 2)} AS promo_daily_revenue, {R('b', 2)} AS baseline_daily_revenue,
        {R('d', 2)} AS discount_cost, {R('100 * (' + ratio('p', 'b') + ' - 1)', 1)} AS revenue_lift_pct FROM (
        SELECT s.*, {M('CASE WHEN order_date >= start_date THEN rev END', 2)} AS p,
        {M('CASE WHEN order_date < start_date THEN rev END', 2)} AS b, sum(CASE WHEN order_date >= start_date THEN disc END) AS d
        FROM s_promos s JOIN (SELECT order_date, channel_code, sum(net_revenue) AS rev, sum(discount_amount) AS disc
             FROM s_daily GROUP BY ALL) x ON x.channel_code = s.channel_code
        AND x.order_date BETWEEN s.start_date - 28 AND s.end_date WHERE s.start_date <= {AS_OF} GROUP BY ALL)""",
    "s_uplift": f"""SELECT event_name, event_date, year, region_relevance, zone, base_product, category,
        {R('e', 2)} AS event_daily_revenue, {R('b', 2)} AS baseline_daily_revenue,
        {R('100 * (' + ratio('e', 'b') + ' - 1)', 1)} AS uplift_pct FROM (
        SELECT v.event_name, v.event_date, v.year, v.region_relevance, zone, base_product, category,
        {R('sum(CASE WHEN order_date >= event_date - 9 THEN rev END)', 2)} / 10 AS e,
        {R('sum(CASE WHEN order_date BETWEEN event_date - 60 AND event_date - 31 THEN rev END)', 2)} / 30 AS b
        FROM s_events v JOIN (SELECT order_date, zone, base_product, category, sum(net_revenue) AS rev
             FROM s_daily GROUP BY ALL) d ON d.order_date BETWEEN event_date - 60 AND event_date
        WHERE event_date BETWEEN DATE '1996-01-01' AND {AS_OF} GROUP BY ALL)""",
    "s_rfm_totals": f"""SELECT customer_id, max(order_date) AS last_order, min(order_date) AS first_order,
        count(*) AS frequency, {R('sum(net_revenue)', 2)} AS monetary,
        CAST({AS_OF} - max(order_date) AS INTEGER) AS recency_days FROM s_fact_orders
        WHERE customer_id IS NOT NULL AND order_status = 'Delivered' GROUP BY customer_id""",
    "s_rfm_scores": """SELECT *, CAST(ntile(5) OVER (ORDER BY recency_days DESC, customer_id) AS INTEGER) AS r_score,
        CAST(ntile(5) OVER (ORDER BY frequency, customer_id) AS INTEGER) AS f_score,
        CAST(ntile(5) OVER (ORDER BY monetary, customer_id) AS INTEGER) AS m_score FROM s_rfm_totals""",
    "s_rfm": """SELECT s.*, CASE WHEN r_score >= 4 AND f_score >= 4 THEN 'Champions' WHEN r_score >= 3 AND f_score >= 3
        THEN 'Loyal' WHEN r_score >= 4 AND f_score <= 2 THEN 'New / Promising' WHEN r_score <= 2 AND f_score >= 3
        THEN 'At Risk' WHEN r_score <= 2 AND f_score <= 2 THEN 'Hibernating' ELSE 'Needs Attention' END AS rfm_segment,
        c.zone, c.city, c.loyalty_tier FROM s_rfm_scores s LEFT JOIN s_dim_customer c ON s.customer_id = c.customer_id""",
    "s_movements": f"""SELECT warehouse_id, sku_id, ship_date AS snapshot_date,
        {B("coalesce(sum(qty) FILTER (l_returnflag = 'A' AND l_tax <= 0.06), 0)")} AS receipts_units,
        {B("coalesce(sum(qty) FILTER (l_returnflag = 'N'), 0)")} AS demand_units,
        {B("coalesce(sum(qty) FILTER (l_returnflag = 'N' AND l_discount < 0.09), 0)")} AS shipped_units
        FROM s_line_base JOIN s_site ON l_suppkey = s_suppkey WHERE l_returnflag IN ('A', 'N')
        GROUP BY ALL""",
    "s_ledger": f"""SELECT *, closing_units - receipts_units + shipped_units AS opening_units FROM (
        SELECT *, {B('200 + sum(receipts_units - shipped_units) OVER (PARTITION BY warehouse_id, sku_id ORDER BY snapshot_date ROWS UNBOUNDED PRECEDING)')}
        AS closing_units FROM s_movements)""",
    "s_snapshots": "SELECT *, 60 AS reorder_point_units, 30 AS safety_stock_units FROM s_ledger WHERE closing_units >= 0",
    "s_inv": f"""SELECT i.*, demand_units - shipped_units AS unfulfilled_units, shipped_units < demand_units AS is_stockout,
        closing_units < safety_stock_units AS below_safety_stock, {R('closing_units / nullif(mean28, 0)', 1)} AS days_of_cover,
        closing_units * CAST(round(unit_cost * 100) AS BIGINT) / 100.0 AS stock_value FROM (
        SELECT *, avg(demand_units) OVER (PARTITION BY warehouse_id, sku_id ORDER BY snapshot_date
        ROWS BETWEEN 27 PRECEDING AND CURRENT ROW) AS mean28 FROM s_snapshots) i
        LEFT JOIN s_costs c ON c.sku_id = i.sku_id AND c.month = date_trunc('month', snapshot_date)""",
    "s_inv_weekly": f"""SELECT {week('snapshot_date')} AS week_start, i.warehouse_id, i.sku_id, p.base_product, p.category,
        {B('sum(demand_units)')} AS demand_units, {B('sum(shipped_units)')} AS shipped_units,
        {B('sum(unfulfilled_units)')} AS unfulfilled_units,
        {B('sum(CASE WHEN is_stockout THEN 1 ELSE 0 END)')} AS stockout_days,
        {R(ratio('sum(shipped_units)', 'sum(demand_units)'), 4)} AS fill_rate,
        {R(M('days_of_cover', 1), 1)} AS avg_days_of_cover, arg_max(closing_units, snapshot_date) AS closing_units,
        {R('arg_max(stock_value, snapshot_date)', 2)} AS closing_stock_value
        FROM s_inv i JOIN s_products p ON i.sku_id = p.sku_id GROUP BY ALL""",
    "s_pos": f"""SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS po_id,
        order_date AS po_date, l_suppkey AS supplier_id, warehouse_id, l.sku_id, qty AS ordered_units,
        {B('(qty * (100 - disc_c)) // 100')} AS received_units, l_extendedprice AS po_value,
        order_date + 30 AS expected_date, received_date,
        CASE WHEN l_linestatus = 'F' THEN 'A' ELSE 'B' END AS quality_grade, s.supplier_name, s.supplier_tier,
        p.base_product, p.category,
        CAST(received_date - order_date AS INTEGER) AS actual_lead_days,
        CAST(received_date - (order_date + 30) AS INTEGER) AS delay_days,
        {R('(qty * (100 - disc_c)) // 100 / qty', 3)} AS fill_rate
        FROM (SELECT *, CASE WHEN l_tax < 0.07 THEN order_date + CAST((ship_date - order_date) % 60 AS INTEGER) END
        AS received_date FROM s_line_base WHERE l_returnflag = 'A' AND ship_date >= order_date AND qty > 0) l
        JOIN s_site ON l_suppkey = s_suppkey LEFT JOIN s_suppliers s ON l_suppkey = s.supplier_id
        LEFT JOIN s_products p ON l.sku_id = p.sku_id""",
    "s_dq": """SELECT 'sales_lines' AS source_table, dq_reason, count(*) AS rows FROM s_rejected GROUP BY ALL
        UNION ALL SELECT 'orders', dq_reason, count(*) FROM s_rejected_orders GROUP BY ALL
        UNION ALL SELECT 'sales_lines', 'late-arriving (accepted)', count(*) FROM s_lines WHERE arrived_late
        UNION ALL SELECT 'stores', 'state name corrected (accepted)', count(*) FROM s_stores WHERE state_was_corrected""",
    "s_grid": f"""SELECT g.sku_id, g.zone, g.week_start, CAST(coalesce(w.units, 0) AS DOUBLE) AS units,
        coalesce(w.promo_share, 0) AS promo_share, split_part(g.sku_id, '|', 1) AS base_product FROM (
        SELECT sku_id, zone, CAST(unnest(generate_series(CAST(min(week_start) AS TIMESTAMP), CAST({LAST_WEEK} AS TIMESTAMP),
        INTERVAL 7 DAY)) AS DATE) AS week_start FROM s_weekly WHERE week_start <= {LAST_WEEK} GROUP BY sku_id, zone) g
        LEFT JOIN s_weekly w USING (sku_id, zone, week_start)""",
    "s_both": """SELECT 'sku' AS level, sku_id AS series_key, zone, week_start, units, promo_share FROM s_grid
        UNION ALL SELECT 'base', base_product, zone, week_start, sum(units), avg(promo_share) FROM s_grid
        GROUP BY base_product, zone, week_start""",
    "s_rows": f"""SELECT *, row_number() OVER (PARTITION BY {SERIES} ORDER BY week_start) AS rn,
        count(*) OVER (PARTITION BY {SERIES}) AS n FROM s_both""",
    "s_origins": f"""SELECT {SERIES}, n, k, CASE WHEN k = 0 THEN 'forecast' ELSE 'backtest' END AS kind, n - 12 * k AS cut,
        CASE WHEN k = 0 THEN 13 ELSE 12 END AS steps, CAST(first_week + CAST(7 * (n - 12 * k - 1) AS INTEGER) AS DATE) AS cutoff
        FROM (SELECT {SERIES}, min(week_start) AS first_week, count(*) AS n FROM s_both GROUP BY {SERIES}),
        (VALUES (0), (1), (2), (3)) f(k) WHERE k = 0 OR n - 12 * k >= 20""",
    "s_origin_stats": """SELECT o.level, o.series_key, o.zone, o.k,
        avg(units) FILTER (rn > cut - 4) AS m4, avg(units) FILTER (rn > cut - 8) AS recent_mean, sum(units) AS total
        FROM s_origins o JOIN s_rows r ON r.level = o.level AND r.series_key = o.series_key AND r.zone = o.zone
        AND r.rn <= o.cut GROUP BY ALL""",
    "s_steps": """SELECT o.*, CAST(unnest(generate_series(1, o.steps)) AS INTEGER) AS step FROM s_origins o""",
    "s_raw_fc": """SELECT t.level, t.series_key, t.zone, t.kind, t.cutoff, CAST(t.cutoff + 7 * t.step AS DATE) AS week_start,
        a.units AS actual, coalesce(p.units, s.m4) AS snaive, s.recent_mean, (t.cut < 26 OR s.total = 0) AS is_short,
        coalesce(p.promo_share, 0) AS promo_future
        FROM s_steps t JOIN s_origin_stats s ON s.level = t.level AND s.series_key = t.series_key AND s.zone = t.zone AND s.k = t.k
        LEFT JOIN s_rows a ON t.kind = 'backtest' AND a.level = t.level AND a.series_key = t.series_key AND a.zone = t.zone
             AND a.rn = t.cut + t.step
        LEFT JOIN s_rows p ON p.level = t.level AND p.series_key = t.series_key AND p.zone = t.zone
             AND p.rn = t.cut + t.step - 52""",
    "s_share_units": """SELECT c.cutoff, g.sku_id, g.zone, g.base_product, sum(g.units) AS units
        FROM (SELECT DISTINCT cutoff FROM s_raw_fc WHERE level = 'sku') c
        JOIN s_grid g ON g.week_start > c.cutoff - 84 AND g.week_start <= c.cutoff GROUP BY ALL""",
    "s_share": """SELECT cutoff, sku_id, zone, base_product, coalesce(units / nullif(sum(units) OVER
        (PARTITION BY cutoff, base_product, zone), 0), 0) AS share FROM s_share_units""",
    "s_cand": """SELECT s.series_key AS sku_id, s.zone, p.category, p.base_product, s.kind, s.cutoff, s.week_start, s.actual,
        s.recent_mean AS direct, coalesce(b.recent_mean * h.share, s.recent_mean) AS topdown, s.snaive AS seasonal_naive
        FROM s_raw_fc s JOIN s_products p ON s.series_key = p.sku_id
        LEFT JOIN s_share h ON h.sku_id = s.series_key AND h.zone = s.zone AND h.cutoff = s.cutoff
        LEFT JOIN s_raw_fc b ON b.level = 'base' AND b.series_key = p.base_product AND b.zone = s.zone
             AND b.cutoff = s.cutoff AND b.week_start = s.week_start WHERE s.level = 'sku'""",
    "s_blend": """SELECT *, direct AS c_direct, topdown AS c_topdown, (direct + topdown) / 2 AS c_combined,
        0.7::DOUBLE * direct + 0.3::DOUBLE * seasonal_naive AS c_direct_snaive,
        0.7::DOUBLE * topdown + 0.3::DOUBLE * seasonal_naive AS c_topdown_snaive,
        0.7::DOUBLE * (direct + topdown) / 2 + 0.3::DOUBLE * seasonal_naive AS c_combined_snaive,
        seasonal_naive AS c_seasonal_naive FROM s_cand""",
    "s_long": """SELECT sku_id, zone, category, base_product, kind, cutoff, week_start, actual, direct, topdown, seasonal_naive,
        unnest(['direct', 'topdown', 'combined', 'direct+snaive', 'topdown+snaive', 'combined+snaive', 'seasonal_naive']) AS candidate,
        unnest([c_direct, c_topdown, c_combined, c_direct_snaive, c_topdown_snaive, c_combined_snaive, c_seasonal_naive]) AS fc
        FROM s_blend""",
    "s_wape_child": f"""SELECT candidate, {W('fc')} AS wape FROM s_long
        WHERE kind = 'backtest' GROUP BY candidate""",
    "s_wape_parent": f"""SELECT candidate, {W('fc')} AS wape FROM (
        SELECT base_product, zone, cutoff, week_start, candidate, sum(actual) AS actual, sum(fc) AS fc FROM s_long
        WHERE kind = 'backtest' GROUP BY ALL) GROUP BY candidate""",
    "s_champion": """SELECT candidate FROM s_wape_child WHERE candidate <> 'seasonal_naive' ORDER BY wape, candidate LIMIT 1""",
    "s_board": """SELECT 'sku x zone x week' AS level, candidate, wape, candidate IN (SELECT candidate FROM s_champion) AS is_champion
        FROM s_wape_child UNION ALL SELECT 'base product x zone x week', candidate, wape,
        candidate IN (SELECT candidate FROM s_champion) FROM s_wape_parent""",
    "s_scored": "SELECT * FROM s_long WHERE candidate = (SELECT candidate FROM s_champion)",
    "s_bands": """SELECT category, zone, quantile_disc(actual / fc, 0.1) AS q_lo, quantile_disc(actual / fc, 0.9) AS q_hi
        FROM s_scored WHERE kind = 'backtest' AND fc > 0.5 GROUP BY ALL""",
    "s_final": """SELECT s.*, fc * coalesce(b.q_lo, 0.6) AS lower, fc * coalesce(b.q_hi, 1.4) AS upper
        FROM s_scored s LEFT JOIN s_bands b ON b.category = s.category AND b.zone = s.zone""",
    "s_forecast": f"""SELECT sku_id, zone, week_start, {R('fc', 1)} AS forecast_units, {R('lower', 1)} AS forecast_lower,
        {R('upper', 1)} AS forecast_upper, {R('seasonal_naive', 1)} AS seasonal_naive_units, {R('direct', 1)} AS direct_units,
        {R('topdown', 1)} AS topdown_units, candidate AS model, cutoff AS trained_through_week FROM s_final
        WHERE kind = 'forecast'""",
    "s_backtest": f"""SELECT sku_id, zone, cutoff, week_start, actual, {R('fc', 1)} AS forecast_units,
        {R('lower', 1)} AS forecast_lower, {R('upper', 1)} AS forecast_upper, {R('seasonal_naive', 1)} AS seasonal_naive_units,
        {R('direct', 1)} AS direct_units, {R('topdown', 1)} AS topdown_units, candidate AS model FROM s_final
        WHERE kind = 'backtest'""",
    "s_accuracy": f"""SELECT b.sku_id, b.zone, p.category, p.base_product, max(b.model) AS model, count(*) AS backtest_weeks,
        {R('sum(actual)', 2)} AS actual_units,
        {R(W('forecast_units'), 4)} AS wape_model,
        {R(W('direct_units'), 4)} AS wape_direct,
        {R(W('seasonal_naive_units'), 4)} AS wape_seasonal_naive,
        {R(W('forecast_units', '{} - actual'), 4)} AS bias_model,
        {R('avg(CASE WHEN actual BETWEEN forecast_lower AND forecast_upper THEN 1 ELSE 0 END)', 3)} AS interval_coverage
        FROM s_backtest b JOIN s_products p ON b.sku_id = p.sku_id GROUP BY b.sku_id, b.zone, p.category, p.base_product""",
    "s_baseline": f"""SELECT series_key AS sku_id, zone, week_start, {R('recent_mean', 1)} AS forecast_units FROM s_raw_fc
        WHERE kind = 'forecast' AND level = 'sku'""",
    "s_wh_units": f"""SELECT zone, warehouse_id, sku_id, {B('sum(quantity)')} AS units FROM s_fact
        WHERE order_status = 'Delivered' AND order_date > {AS_OF} - 84 GROUP BY ALL""",
    "s_wh_share": """SELECT *, units / CAST(sum(units) OVER (PARTITION BY zone, sku_id) AS DOUBLE) AS share FROM s_wh_units""",
    "s_alloc": f"""SELECT s.warehouse_id, f.sku_id, f.week_start, {R('sum(f.forecast_units * s.share)', 6)} AS fc_units,
        {R('sum(f.forecast_upper * s.share)', 6)} AS fc_upper FROM s_forecast f JOIN s_wh_share s ON s.zone = f.zone AND s.sku_id = f.sku_id
        WHERE f.week_start >= {FIRST_FC} GROUP BY ALL""",
    "s_horizon": f"""SELECT warehouse_id, sku_id, {R(f'sum(fc_units) FILTER (week_start < {FIRST_FC} + 28)', 6)} AS fc_next_4w,
        {R(f'sum(fc_units) FILTER (week_start < {FIRST_FC} + 84)', 6)} AS fc_next_12w, {M('fc_units')} AS fc_avg_week
        FROM s_alloc GROUP BY ALL""",
    "s_stock": f"""SELECT warehouse_id, sku_id, arg_max(closing_units, snapshot_date) AS on_hand_units,
        arg_max(stock_value, snapshot_date) AS stock_value FROM s_inv WHERE snapshot_date <= {AS_OF} GROUP BY ALL""",
    "s_open_po": f"""SELECT warehouse_id, sku_id, {B('sum(ordered_units)')} AS open_po_units, min(expected_date) AS next_po_eta
        FROM s_pos WHERE received_date IS NULL OR received_date > {AS_OF} GROUP BY ALL""",
    "s_lead": f"""SELECT warehouse_id, sku_id, greatest(1.0::DOUBLE, {R('avg(coalesce(actual_lead_days, 14)) / 7', 1)}) AS lead_time_weeks
        FROM s_pos WHERE po_date > {AS_OF} - 365 GROUP BY ALL""",
    "s_variability": f"""SELECT warehouse_id, sku_id, stddev_samp(demand) AS sd_week, avg(demand) AS avg_week FROM (
        SELECT warehouse_id, sku_id, {week('snapshot_date')} AS wk, {B('sum(demand_units)')} AS demand FROM s_inv
        WHERE snapshot_date > {AS_OF} - 84 GROUP BY ALL) GROUP BY ALL""",
    "s_reorder_base": """SELECT h.*, w.warehouse_name, p.product_name, p.base_product, p.category, p.mrp, p.tax,
        CAST(coalesce(s.on_hand_units, 0) AS BIGINT) AS on_hand, CAST(coalesce(o.open_po_units, 0) AS BIGINT) AS pending,
        o.next_po_eta, coalesce(l.lead_time_weeks, 2.0::DOUBLE) AS lead, coalesce(v.sd_week, 0) AS sd
        FROM s_horizon h JOIN s_products p ON h.sku_id = p.sku_id JOIN s_warehouses w ON h.warehouse_id = w.warehouse_id
        LEFT JOIN s_stock s ON s.warehouse_id = h.warehouse_id AND s.sku_id = h.sku_id
        LEFT JOIN s_open_po o ON o.warehouse_id = h.warehouse_id AND o.sku_id = h.sku_id
        LEFT JOIN s_variability v ON v.warehouse_id = h.warehouse_id AND v.sku_id = h.sku_id
        LEFT JOIN s_lead l ON l.warehouse_id = h.warehouse_id AND l.sku_id = h.sku_id""",
    "s_reorder": f"""SELECT warehouse_id, sku_id, warehouse_name, product_name, base_product, category, on_hand AS on_hand_units,
        pending AS open_po_units, next_po_eta, {R('fc_next_4w', 0)} AS forecast_next_4w_units,
        {R('fc_next_12w', 0)} AS forecast_next_12w_units, lead AS lead_time_weeks,
        {R('1.65::DOUBLE * sd * sqrt(lead)', 0)} AS safety_stock_units,
        {R('on_hand / nullif(fc_avg_week, 0)', 1)} AS weeks_of_cover,
        greatest(0.0::DOUBLE, {R('fc_avg_week * (lead + 4) + 1.65::DOUBLE * sd * sqrt(lead) - on_hand - pending', 0)})
        AS recommended_order_units,
        CASE WHEN on_hand / nullif(fc_avg_week, 0) < lead THEN 'High' WHEN on_hand / nullif(fc_avg_week, 0) < lead + 2
             THEN 'Medium' ELSE 'Low' END AS stockout_risk,
        {AS_OF} + CAST(trunc(7 * (on_hand / nullif(fc_avg_week, 0))) AS INTEGER) AS projected_stockout_date,
        {R('fc_next_4w * mrp * 0.7::DOUBLE / (1 + tax / 100.0::DOUBLE)', 0)} AS forecast_revenue_4w, {AS_OF} AS as_of_date
        FROM s_reorder_base""",
    "s_decisions": "SELECT warehouse_id, sku_id, decision, override_units, CAST(decided_at AS TIMESTAMP) AS decided_at FROM "
                   "(SELECT DISTINCT warehouse_id, sku_id FROM s_pos WHERE received_date IS NULL), ("
                   + values(DECISIONS, "decision, override_units, decided_at") + ")",
    "s_latest": """SELECT * FROM s_decisions QUALIFY row_number() OVER (PARTITION BY warehouse_id, sku_id
        ORDER BY decided_at DESC, decision, override_units) = 1""",
}

NAMES = re.compile(r"\bs_[a-z_]+\b")


def uses(text: str) -> set[str]:
    return {n for n in NAMES.findall(text) if n in CTES}


def with_layers(final: str, extra: dict[str, str] | None = None) -> str:
    """Prefix a query with exactly the layers it needs, in definition order."""
    needed, todo = set(), uses(final) | set().union(*[uses(t) for t in (extra or {}).values()], set())
    while todo:
        name = todo.pop()
        if name not in needed:
            needed.add(name)
            todo |= uses(CTES[name])
    blocks = [f"{n} AS MATERIALIZED ({CTES[n]})" for n in CTES if n in needed]
    blocks += [f"{n} AS ({t})" for n, t in (extra or {}).items()]
    return f"WITH {', '.join(blocks)} {final}" if blocks else final
