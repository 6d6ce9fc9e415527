"""Landing files to gate on a small lake: two SKUs, one zone, two years of weeks."""

import shutil

import pytest
from pyspark.sql import functions as F

from lakeplan.config import PlanConfig
from lakeplan.plans import runner, silver

CFG = PlanConfig(as_of="2024-06-30", last_full_week="2024-06-17", calendar_start="2022-01-01",
                 calendar_end="2024-12-31", horizon_weeks=4, reject_limit=0.05)
FIRST_WEEK = "2024-06-24"
RAW_TYPES = {"sales_lines": {"quantity": "string"}}


def land(spark, root):
    def put(name, sql, fmt="parquet"):
        df = spark.sql(sql) if isinstance(sql, str) else sql
        w = df.write.mode("overwrite")
        (w.option("header", True) if fmt == "csv" else w).format(fmt).save(f"{root}/{name}")

    put("geography", "SELECT 'C1' city_id, 'Pune' city, 'Maharashtra' state, 'MH' state_code, 'West' zone, 1 tier, true is_metro, 18.5 lat, 73.8 lon, 7.0 population_m "
        "UNION ALL SELECT 'C2', 'Mars', 'Nowhere', 'NW', 'Space', 1, false, 0.0, 0.0, 0.0", "csv")
    put("warehouses", "SELECT 'W1' warehouse_id, 'Pune DC' warehouse_name, 'Pune' city, 'Maharashtra' state, 'West' zone, 18.5 lat, 73.8 lon, 100 capacity_tonnes", "csv")
    put("channels", "SELECT 'GT' channel_code, 'General' channel_name, 'Offline' channel_group, 0.1 partner_margin_pct", "csv")
    put("events", "SELECT 'Fair' event_name, '2023-10-10' event_date, 2023 year, 'All' region_relevance, 10 lead_days, 20.0 expected_uplift_pct, 'x' key_products", "csv")
    put("products", "SELECT * FROM VALUES ('S1', 'One', 'b1', 'Base', 'Cat', 'Sub', 100, false, 50.0, 0.05, 365, '2021-01-01'), "
        "('S2', 'Two', 'b1', 'Base', 'Cat', 'Sub', 200, true, 90.0, 0.05, 365, '2021-01-01'), ('S3', 'Bad', 'b1', 'Base', 'Cat', 'Sub', 1, true, -1.0, 0.05, 1, '2021-01-01') "
        "t(sku_id, product_name, base_code, base_product, category, sub_category, pack_size, is_organic, mrp, tax_rate, shelf_life_days, launch_date)", "csv")
    put("product_prices", "SELECT 'S1' sku_id, '2021-01-01' effective_from, CAST(NULL AS string) effective_to, 50.0 mrp", "csv")
    months = "explode(sequence(DATE'2022-01-01', DATE'2024-12-01', INTERVAL 1 MONTH))"
    put("product_costs", f"SELECT sku_id, {months} AS month, 20.0 AS unit_cost FROM VALUES ('S1'), ('S2') t(sku_id)", "csv")
    put("material_prices", f"SELECT 'b1' base_code, {months} AS month, 1.1 AS price_index, 200.0 AS price_per_kg", "csv")
    put("suppliers", "SELECT 'V1' supplier_id, 'Sup' supplier_name, 'T' origin_town, 'Kerala' origin_state, 'b1' primary_code, 0.9 reliability_score, 7 lead_time_days, 'Primary' supplier_tier", "csv")
    put("stores", "SELECT CAST(NULL AS string) store_id, 'Ghost' store_name, 'GT' store_type, 'GT' channel_code, 'Atlantis' city, 'Nowhere' state, 'W1' warehouse_id, '2021-01-01' opened_date, CAST(NULL AS string) closed_date, 'M' size_band, 'R1' sales_rep_id "
        "UNION ALL SELECT 'T1' store_id, 'Shop' store_name, 'GT' store_type, 'GT' channel_code, 'Pune' city, ' Maharastra' state, 'W1' warehouse_id, '2021-01-01' opened_date, CAST(NULL AS string) closed_date, 'M' size_band, 'R1' sales_rep_id", "json")
    put("promotions", "SELECT 'P1' promo_id, 'FAIR' promo_code, 'Fair' promo_name, 'Flat' promo_type, 0.1 discount_pct, '2023-10-01' start_date, '2023-10-10' end_date, 'GT' channel_code, 'All' category_scope, 'Brand' funded_by, 'Fair' event_name", "json")
    put("customers", "SELECT * FROM VALUES ('K1', 'Ann'), ('K1', 'Ann'), (NULL, 'Nobody') t(customer_id, full_name)".replace("SELECT *",
        "SELECT customer_id, full_name, 'F' gender, '30s' age_band, 'Pune' city, 'Maharashtra' state, DATE'2022-01-01' signup_date, 'Gold' loyalty_tier, 'en' preferred_language, 'D2C' customer_type"))
    days = spark.range(0, 130 * 7).select(
        F.expr("date_add(DATE'2022-01-03', CAST(id AS int))").alias("d"), F.col("id")).where("d <= DATE'2024-06-30'")
    orders = days.selectExpr(
        "concat('O', id) AS order_id", "CAST(d AS timestamp) AS order_ts", "CASE WHEN id = 5 THEN NULL ELSE 'T1' END AS store_id",
        "'GT' AS channel_code", "'K1' AS customer_id", "'Cash' AS payment_mode",
        "CASE WHEN id = 6 THEN 'Lost' WHEN id % 50 = 7 THEN 'Cancelled' ELSE 'Delivered' END AS order_status", "'Pune' AS delivery_city",
        "date_format(d, 'yyyy-MM') AS batch", "id AS id_")
    put("orders", orders.unionByName(orders.where("id_ = 30").withColumns({"payment_mode": F.lit("Credit"), "order_ts": F.expr("order_ts + INTERVAL 9 HOUR")})).drop("id_"))
    lines = days.withColumn("s", F.explode(F.array(F.lit(1), F.lit(2)))).selectExpr(
        "concat('L', id, '-', s) AS line_id", "concat('O', id) AS order_id", "s AS line_no", "d AS order_date",
        "concat('S', s) AS sku_id", "CAST(CAST(3 + s + id % 5 AS int) AS string) AS quantity", "50.0D AS unit_mrp", "42.0D AS unit_price",
        "CAST(NULL AS string) AS promo_code", "0.0D AS discount_pct", "42.0D * (3 + s + id % 5) AS line_amount",
        "date_format(d, 'yyyy-MM') AS batch")
    faults = lines.where("line_id IN ('L3-1', 'L4-2')").unionByName(
        lines.where("line_id = 'L9-1'").withColumns({"line_id": F.lit("LX"), "quantity": F.lit("-1")})).unionByName(
        lines.where("line_id = 'L9-1'").withColumns({"line_id": F.lit("LT"), "quantity": F.lit("many")})).unionByName(
        lines.where("line_id = 'L9-1'").withColumns({"line_id": F.lit("LU"), "sku_id": F.lit("S9")})).unionByName(
        lines.where("line_id = 'L9-1'").withColumns({"line_id": F.lit("LP"), "unit_price": F.lit(None).cast("double")}))
    put("sales_lines", lines.unionByName(faults))
    put("returns", "SELECT 'R1' return_id, 'L20-1' line_id, 'O20' order_id, 'S1' sku_id, DATE'2022-02-01' return_date, 1 return_qty, 'x' return_reason, 42.0D refund_amount "
        "UNION ALL SELECT 'R2', 'L21-1', 'O21', 'S1', DATE'2022-02-01', 0, 'x', 0.0D")
    put("inventory", days.withColumn("s", F.explode(F.array(F.lit(1), F.lit(2)))).selectExpr(
        "'W1' AS warehouse_id", "concat('S', s) AS sku_id", "d AS snapshot_date", "50L AS opening_units", "5L AS receipts_units",
        "CAST(3 + s + id % 5 AS bigint) AS demand_units", "CAST(3 + s AS bigint) AS shipped_units", "40L AS closing_units",
        "60L AS reorder_point_units", "30L AS safety_stock_units", "date_format(d, 'yyyy-MM') AS batch").withColumn(
        "closing_units", F.expr("CASE WHEN snapshot_date = DATE'2022-01-03' AND sku_id = 'S1' THEN -4L ELSE closing_units END")))
    put("purchase_orders", "SELECT 'PO1' po_id, DATE'2024-06-01' po_date, 'V1' supplier_id, 'W1' warehouse_id, 'S1' sku_id, 100L ordered_units, 90L received_units, 10.0D ordered_kg, "
        "20.0D unit_cost, 2000.0D po_value, DATE'2024-06-08' expected_date, DATE'2024-06-11' received_date, 'A' quality_grade "
        "UNION ALL SELECT 'PO2', DATE'2024-06-01', 'V1', 'W1', 'S1', 0L, 0L, 0.0D, 20.0D, 0.0D, DATE'2024-06-08', CAST(NULL AS date), 'B'")
    return lines.count()


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("lake")
    n = land(spark, f"{base}/landing")
    out = runner.run_end_to_end(spark, f"{base}/landing", f"{base}/root", CFG, FIRST_WEEK, raw_types=RAW_TYPES)
    out.lines, out.landing = n, f"{base}/landing"
    return out


def test_faults_are_explained(lake):
    got = {(r.source_table, r.dq_reason): r["rows"] for r in lake.table("gold", "dq_summary").collect()}
    assert got == {("sales_lines", "duplicate line"): 2, ("sales_lines", "non-positive quantity"): 2,
                   ("sales_lines", "unknown sku"): 1, ("sales_lines", "missing price"): 1,
                   ("orders", "missing store_id"): 1, ("orders", "invalid status"): 1,
                   ("geography", "valid_zone"): 1, ("products", "positive_mrp"): 1, ("stores", "store_id_present"): 1,
                   ("customers", "customer_id_present"): 1, ("returns", "positive_return_qty"): 1,
                   ("inventory", "non_negative_stock"): 1, ("purchase_orders", "positive_order_qty"): 1,
                   ("sales_lines", "late-arriving (accepted)"): 0, ("stores", "state name corrected (accepted)"): 1}
    assert lake.table("silver", "sales_lines").count() == lake.lines
    assert lake.table("silver", "geography").count() == 1 and lake.table("silver", "products").count() == 2
    assert lake.table("silver", "customers").count() == 1


def test_clean_and_quarantine_are_the_input(lake):
    for feed in ("products", "geography", "stores"):
        assert lake.table("silver", feed).count() + lake.table("silver", f"{feed}_quarantine").count() == lake.table("bronze", feed).count()
    for feed in runner.STREAMED_SILVER:
        sides = [runner.streamed(lake, feed, 1, side).count() for side in ("clean", "quarantine")]
        assert sum(sides) == runner.raw(lake, feed, 1).count()
    lines = [lake.table("silver", n).count() for n in ("sales_lines", "sales_lines_quarantine")]
    assert sum(lines) == runner.raw(lake, "sales_lines", 1, RAW_TYPES).count()
    bad = {r.line_id: r for r in lake.table("silver", "sales_lines_quarantine").collect()}
    assert bad["LT"].quantity == "many" and bad["LT"].dq_reason == "non-positive quantity"
    assert bad["LT"]._source_file.endswith(".parquet") and bad["LT"]._ingest_ts is not None


def test_every_rule_is_counted_by_the_run(lake):
    got = {(r.source_table, r.rule): r for r in lake.table("silver", "rule_metrics").collect()}
    rules = {f: rules for f, rules in silver.RULES.items()}
    assert set(got) == {(f, r.name) for f in rules for r in rules[f]} and len(got) == 14
    warned = got["stores", "state_resolved"]
    assert (warned.action, warned.passed_rows, warned.failed_rows) == ("warn", 1, 1)
    snapshots = {f: lake.table("bronze", f).count() for f in ("geography", "products", "stores")}
    for (feed, _), r in got.items():
        rows = snapshots.get(feed) or runner.raw(lake, feed, 1, RAW_TYPES).count()
        assert r.passed_rows + r.failed_rows == rows, feed
    failed = {k: r.failed_rows for k, r in got.items() if r.failed_rows}
    assert failed == {("geography", "valid_zone"): 1, ("products", "positive_mrp"): 1, ("stores", "store_id_present"): 1,
                      ("stores", "state_resolved"): 1, ("customers", "customer_id_present"): 1, ("orders", "store_id_present"): 1,
                      ("orders", "valid_status"): 1, ("sales_lines", "positive_quantity"): 2, ("sales_lines", "known_sku"): 1,
                      ("sales_lines", "price_present"): 1, ("returns", "positive_return_qty"): 1, ("inventory", "non_negative_stock"): 1,
                      ("purchase_orders", "positive_order_qty"): 1}


def test_one_row_per_order(lake):
    heads = lake.table("gold", "fact_orders")
    assert heads.count() == heads.select("order_id").distinct().count()
    row = heads.where("order_id = 'O30'").first()
    assert (row.payment_mode, row.order_ts.hour) == ("Credit", 9)


def test_run_record_and_alerts(lake):
    run = lake.table("ml", "runs").first()
    assert run.params["champion"] in {r.candidate for r in lake.table("ml", "forecast_model_comparison").where("is_champion").collect()}
    assert {"coverage", "points", "share_beating_naive", "bias", "series"} < set(run.metrics) and len(run.metrics) == 5 + 14
    assert {r.check_name for r in lake.table("gold", "alerts").collect()} == {"high_risk_items", "forecast_wape", "reject_rate"}


def test_gold_tables(lake):
    fact = lake.table("gold", "fact_sales_line")
    assert fact.count() == lake.lines - 4 + 2  # two orders are rejected with their lines, one has two header rows
    assert fact.where("is_returned").count() == 1
    daily = lake.table("gold", "agg_sales_daily")
    delivered = fact.where("order_status = 'Delivered'").agg(F.round(F.sum("net_revenue"), 2)).first()[0]
    assert daily.agg(F.round(F.sum("net_revenue"), 2)).first()[0] == delivered
    po = lake.table("gold", "fact_purchase_orders").first()
    assert (po.actual_lead_days, po.delay_days, po.fill_rate) == (10, 3, 0.9)
    for name in ("agg_sales_monthly", "agg_promo_effectiveness", "agg_event_uplift", "agg_customer_rfm",
                 "agg_inventory_weekly", "agg_margin_monthly", "dim_store", "dim_promotion", "dim_date"):
        assert lake.table("gold", name).count() > 0, name


def test_planning_tables(lake):
    fc = lake.table("ml", "demand_forecast")
    assert fc.count() == 2 * (CFG.horizon_weeks + 1)
    assert fc.where("forecast_lower > forecast_units OR forecast_units > forecast_upper").count() == 0
    board = lake.table("ml", "forecast_model_comparison")
    assert board.count() == 14
    assert {r.candidate for r in board.where("is_champion").collect()}.isdisjoint({"seasonal_naive"})
    assert lake.table("ml", "reorder_recommendation").count() == 2
    assert lake.table("ml", "forecast_baseline").count() == 2 * (CFG.horizon_weeks + 1)
    assert lake.table("ml", "runs").count() == 1


def test_gate_passed_and_can_fail(spark, lake):
    status = {r.check_name: r.breached for r in lake.table("gold", "gate_status").collect()}
    assert status == {"reject_rate": False, "orphans": False, "reconcile": False, "freshness": False, "horizon": False}


def counts(lake, version):
    tables = {f: runner.raw(lake, f, version, RAW_TYPES).count() for f in runner.STREAM_FEEDS}
    tables |= {(f, side): runner.streamed(lake, f, version, side).count() for f in runner.STREAMED_SILVER for side in ("clean", "quarantine")}
    return tables | {n: lake.table("gold", n).count() for n in ("fact_sales_line", "fact_orders", "agg_sales_daily", "dq_summary")}


def test_second_run_adds_nothing(spark, lake):
    before = counts(lake, 1)
    runner.run_end_to_end(spark, lake.landing, lake.root, CFG, FIRST_WEEK, raw_types=RAW_TYPES)
    assert counts(lake, 1) == before
    assert lake.table("ml", "runs").count() == 2


def test_full_refresh_rebuilds_the_same(spark, lake):
    before = counts(lake, 1)
    runner.run_end_to_end(spark, lake.landing, lake.root, CFG, FIRST_WEEK, raw_types=RAW_TYPES, full=True)
    assert counts(lake, 2) == before


def test_a_feed_that_has_not_delivered(spark, lake, tmp_path):
    shutil.copytree(lake.landing, f"{tmp_path}/landing", ignore=shutil.ignore_patterns("returns", "purchase_orders"))
    other = runner.Lake(spark, f"{tmp_path}/root")
    version = runner.bronze(other, f"{tmp_path}/landing", raw_types=RAW_TYPES)
    runner.silver_layer(other, version, raw_types=RAW_TYPES)
    runner.gold_layer(other, version, CFG)
    assert other.table("gold", "fact_returns").count() == 0 == other.table("gold", "fact_purchase_orders").count()
    assert other.table("gold", "fact_sales_line").where("NOT is_returned").count() > 0
