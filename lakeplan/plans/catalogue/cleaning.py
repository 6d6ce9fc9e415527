"""Projection, filters, expectations and de-duplication (PRJ, FLT, EXP, DED)."""

import datetime as dt

from pyspark.sql import functions as F

from lakeplan.functions.calendar import season
from lakeplan.functions.columns import band, in_band
from lakeplan.operators import expectations as ex
from lakeplan.operators.clean import conform
from lakeplan.operators.decisions import latest_decisions
from lakeplan.operators.dedupe import argmax_per, dedupe, latest_per_key
from lakeplan.operators.facts import dim_store
from lakeplan.operators.filters import Range, apply_filters
from lakeplan.plans import silver
from lakeplan.plans.catalogue import query
from lakeplan.plans.oracle import AS_OF
from lakeplan.session import scratch_path


@query("prj1_conform_lines", """SELECT l_orderkey AS order_id, l_linenumber AS line_no, CAST(l_shipdate AS DATE) AS ship_date,
    CASE WHEN l_quantity = 50 THEN 0 ELSE CAST(l_quantity AS INTEGER) END AS quantity, l_quantity = 50 AS bad_quantity,
    l_extendedprice AS line_amount
    FROM lineitem""")
def prj1_lines(s):
    text = s.lineitem.selectExpr(
        "CAST(l_orderkey AS string) AS order_id", "CAST(l_linenumber AS string) AS line_no",
        "date_format(l_shipdate, 'yyyy-MM-dd') AS ship_date",
        "CASE WHEN l_quantity = 50 THEN 'fifty' ELSE CAST(CAST(l_quantity AS int) AS string) END AS quantity",
        "CAST(l_extendedprice AS string) AS line_amount")
    typed = conform(text, {"order_id": "long", "line_no": "int", "ship_date": "date", "quantity": "int",
                           "line_amount": "double"})
    return typed.withColumn("bad_quantity", F.col("quantity").isNull()).fillna({"quantity": 0})


@query("prj1_conform_orders", """SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_orderdate AS DATE) AS order_date,
    CASE WHEN o_totalprice >= 2500 THEN CAST(o_custkey AS VARCHAR) END AS store_id, o_orderpriority AS channel_code,
    order_status FROM orders JOIN s_raw_orders ON o_orderkey = order_id""")
def prj1_orders(s):
    types = silver.SCHEMAS["orders"]
    wide = s.raw_orders.withColumn("delivery_city", F.lit(None).cast("string"))
    return conform(wide, types).select("order_id", F.to_date("order_ts").alias("order_date"), "store_id",
                                       "channel_code", "order_status")


@query("prj1_conform_customers", "SELECT customer_id, full_name, city, state FROM s_customers")
def prj1_customers(s):
    types = {k: silver.SCHEMAS["customers"][k] for k in ("customer_id", "full_name", "city", "state")}
    return conform(s.customers, types)


@query("prj2_standardise", "SELECT store_id, state, state_was_corrected FROM s_stores")
def prj2(s):
    return s.stores.select("store_id", "state", "state_was_corrected")


@query("prj3_banding", """SELECT d.season, CASE WHEN o_totalprice < 100000 THEN 'small' WHEN o_totalprice < 300000 THEN 'medium'
    ELSE 'large' END AS basket, count(*) AS orders FROM orders JOIN s_dim_date d ON CAST(o_orderdate AS DATE) = d.date
    GROUP BY ALL""")
def prj3(s):
    p = F.col("o_totalprice")
    return s.orders_tbl.groupBy(
        season(F.to_date("o_orderdate")).alias("season"),
        band([(p < 100000, "small"), (p < 300000, "medium")], "large").alias("basket")).agg(
        F.count(F.lit(1)).alias("orders"))


@query("prj4_flags", """SELECT s.store_id, s.zone, s.closed_date IS NULL AS is_active, s.state_was_corrected,
    s.closed_date FROM s_stores s""")
def prj4(s):
    named = dim_store(s.stores.withColumn("channel_code", F.lit("1-URGENT")), s.channels)
    return named.select("store_id", "zone", "is_active", "state_was_corrected", "closed_date")


@query("prj5_money", """SELECT line_id, volume_kg, gross_amount, net_revenue, tax_amount, discount_amount, cogs, gross_margin
    FROM s_fact""")
def prj5(s):
    return s.fact.select("line_id", "volume_kg", "gross_amount", "net_revenue", "tax_amount", "discount_amount",
                         "cogs", "gross_margin")


@query("prj6_passthrough", """SELECT *, CASE WHEN p_size <= 10 THEN 'small' WHEN p_size <= 30 THEN 'medium' ELSE 'large' END
    AS size_band FROM part""")
def prj6(s):
    return s.part.withColumn("size_band", in_band("p_size", [(10, "small"), (30, "medium")], "large"))


@query("flt1_predicates", """SELECT order_id, channel_code, payment_mode FROM s_raw_orders
    WHERE order_status IN ('Delivered', 'Cancelled') AND order_date BETWEEN DATE '1996-01-01' AND DATE '1999-12-31'
    AND channel_code LIKE '%O%' AND channel_code NOT LIKE '%SPEC%' AND customer_id IS NULL AND payment_mode = 'Cash'""")
def flt1(s):
    c = F.col
    return s.raw_orders.where(
        c("order_status").isin("Delivered", "Cancelled")
        & c("order_date").between(F.lit("1996-01-01").cast("date"), F.lit("1999-12-31").cast("date"))
        & c("channel_code").like("%O%") & ~c("channel_code").like("%SPEC%")
        & c("customer_id").isNull() & (c("payment_mode") == "Cash")).select("order_id", "channel_code", "payment_mode")


@query("flt2_scalar_filter", """SELECT order_id, order_date FROM s_raw_orders
    WHERE order_date > (SELECT max(order_date) FROM s_raw_orders) - 84 AND order_date <= """ + AS_OF)
def flt2(s):
    last = s.raw_orders.select(F.max("order_date")).scalar()
    return s.raw_orders.where((F.col("order_date") > F.date_sub(last, 84))
                              & (F.col("order_date") <= F.lit("2001-07-31").cast("date"))).select("order_id", "order_date")


@query("flt3_optional_filters", """SELECT zone, channel_code, count(*) AS lines FROM s_fact
    WHERE zone IN ('ASIA', 'EUROPE') AND payment_mode = 'Cash' GROUP BY ALL""")
def flt3(s):
    picked = apply_filters(s.fact, {"zone": ["ASIA", "EUROPE"], "payment_mode": "Cash", "state": None})
    return picked.groupBy("zone", "channel_code").agg(F.count(F.lit(1)).alias("lines"))


@query("flt3_date_range", """SELECT zone, count(*) AS lines FROM s_fact WHERE order_date BETWEEN DATE '1996-01-01' AND DATE '1996-06-30'
    AND quantity >= 10 GROUP BY ALL""")
def flt3_range(s):
    picked = apply_filters(s.fact, {"order_date": Range(dt.date(1996, 1, 1), dt.date(1996, 6, 30)), "quantity": Range(low=10)})
    return picked.groupBy("zone").agg(F.count(F.lit(1)).alias("lines"))


LINE_COLUMNS = ["line_id", "order_id", "line_no", "order_date", "sku_id", "quantity", "unit_price", "line_amount",
                "batch", "arrived_late"]


@query("exp1_drop_lines", f"SELECT {', '.join(LINE_COLUMNS)} FROM s_lines")
def exp1_lines(s):
    return s.lines.select(*LINE_COLUMNS)


@query("exp1_drop_orders", "SELECT order_id, store_id, order_status FROM s_orders")
def exp1_orders(s):
    return s.orders.select("order_id", "store_id", "order_status")


@query("exp1_drop_returns", "SELECT return_id, return_qty FROM s_returns")
def exp1_returns(s):
    return s.returns.select("return_id", "return_qty")


@query("exp1_drop_inventory", "SELECT warehouse_id, sku_id, snapshot_date, closing_units FROM s_snapshots")
def exp1_inventory(s):
    return s.snapshots.select("warehouse_id", "sku_id", "snapshot_date", "closing_units")


@query("exp1_drop_geography", "SELECT customer_id, city, state, zone FROM s_dim_customer WHERE zone IN ('ASIA', 'EUROPE', 'AFRICA')")
def exp1_geography(s):
    """The zone rule on placed customers, three of the five zones being valid."""
    return ex.keep_valid(s.dim_customer, [silver.zone_rule(["ASIA", "EUROPE", "AFRICA"])]).select(
        "customer_id", "city", "state", "zone")


@query("exp1_drop_products", "SELECT sku_id, mrp FROM s_products WHERE mrp > 0")
def exp1_products(s):
    return ex.keep_valid(s.products, silver.RULES["products"]).select("sku_id", "mrp")


@query("exp2_warn_only", "SELECT store_id, zone FROM s_stores")
def exp2(s):
    """Rows that only warn stay."""
    return ex.keep_valid(s.stores, silver.RULES["stores"]).select("store_id", "zone")


@query("exp2_observed_counts", """SELECT 'stores' AS feed, rule, action, CAST(passed AS BIGINT) AS passed_rows, CAST(n - passed AS BIGINT) AS failed_rows
    FROM (SELECT count(*) AS n, count(store_id) AS a, count(zone) AS b FROM s_stores), LATERAL (VALUES
    ('store_id_present', 'drop', a), ('state_resolved', 'warn', b)) v(rule, action, passed)
    UNION ALL SELECT 'orders', rule, 'drop', passed, n - passed FROM (SELECT count(*) AS n, count(store_id) AS a,
    count(*) FILTER (order_status IN ('Delivered', 'Cancelled')) AS b FROM s_raw_orders), LATERAL (VALUES
    ('store_id_present', a), ('valid_status', b)) v(rule, passed)""")
def exp2_counts(s):
    """Counts observed by the jobs that write the two sides of each feed."""
    found = []
    for feed, df in (("stores", s.stores), ("orders", s.raw_orders)):
        counted = ex.Counted(silver.RULES[feed])
        path = scratch_path(s.spark, feed)
        ex.write_split(ex.tag(counted.watch(df), silver.RULES[feed]), f"{path}/good", f"{path}/bad", "overwrite")
        found += [(feed, *r) for r in counted.rows()]
    return s.spark.createDataFrame(found, f"feed string, {ex.METRICS}")


@query("exp3_rule_metrics", """SELECT rule, 'drop' AS action, CAST(passed AS BIGINT) AS passed_rows,
    CAST(n - passed AS BIGINT) AS failed_rows FROM (SELECT count(*) AS n, count(*) FILTER (quantity > 0) AS a,
    count(*) FILTER (sku_known) AS b, count(*) FILTER (unit_price IS NOT NULL) AS c FROM s_ranked),
    LATERAL (VALUES ('positive_quantity', a), ('known_sku', b), ('price_present', c)) v(rule, passed)""")
def exp3(s):
    from lakeplan.operators.joins import flag_known
    known = flag_known(s.raw_lines, s.products, "sku_id", "sku_known")
    return ex.rule_metrics(known, silver.RULES["sales_lines"])


@query("exp4_lines_quarantine", """SELECT line_id, l_partkey, l_suppkey, sku_id, quantity, batch, dq_reason FROM s_rejected""")
def exp4_lines(s):
    return s.lines_quarantine.select("line_id", "l_partkey", "l_suppkey", "sku_id", "quantity", "batch", "dq_reason")


@query("exp4_orders_quarantine", "SELECT order_id, order_status, dq_reason FROM s_rejected_orders")
def exp4_orders(s):
    return silver.orders_quarantine(s.raw_orders).select("order_id", "order_status", "dq_reason")


@query("exp4_balance", """SELECT 'clean' AS side, count(*) AS rows FROM s_lines UNION ALL
    SELECT 'rejected', count(*) FROM s_rejected UNION ALL SELECT 'input', count(*) FROM s_raw_lines""")
def exp4_balance(s):
    tagged = silver.tagged_lines(s.raw_lines, s.products, s.line_order)
    side = F.when(F.col(ex.REASON).isNull(), "clean").otherwise("rejected").alias("side")
    # one pass: every row counts once on its side and once as input
    return tagged.select(F.explode(F.array(side, F.lit("input"))).alias("side")).groupBy("side").agg(
        F.count(F.lit(1)).alias("rows"))


@query("ded1_latest_per_key", """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_partkey, l_suppkey, l_linenumber,
    l_extendedprice) = 1""")
def ded1(s):
    ties = [F.col(c).asc() for c in ("l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice")]
    return latest_per_key(s.lineitem, ["l_orderkey"], "l_shipdate", *ties).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@query("ded2_dedupe_kept", "SELECT line_id, l_partkey, l_suppkey FROM s_ranked WHERE rn = 1")
def ded2_kept(s):
    return dedupe(s.raw_lines, ["line_id"], s.line_order)[0].select("line_id", "l_partkey", "l_suppkey")


@query("ded2_dedupe_surplus", "SELECT line_id, l_partkey, l_suppkey FROM s_ranked WHERE rn > 1")
def ded2_surplus(s):
    return dedupe(s.raw_lines, ["line_id"], s.line_order)[1].select("line_id", "l_partkey", "l_suppkey")


@query("ded3_drop_duplicates", "SELECT DISTINCT order_id, sku_id FROM s_raw_lines")
def ded3(s):
    return s.raw_lines.select("order_id", "sku_id").dropDuplicates(["order_id", "sku_id"])


@query("ded3_keep_max_discount", """SELECT order_id, sku_id, max(discount_pct) AS discount_pct FROM s_raw_lines
    GROUP BY ALL""")
def ded3_max(s):
    return argmax_per(s.raw_lines, ["order_id", "sku_id"], "discount_pct", F.col("line_id"), F.col("l_partkey")).select(
        "order_id", "sku_id", "discount_pct")


@query("ded4_latest_decision", "SELECT warehouse_id, sku_id, decision, override_units FROM s_latest")
def ded4(s):
    return latest_decisions(s.decisions).select("warehouse_id", "sku_id", "decision", "override_units")
