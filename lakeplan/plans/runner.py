"""End-to-end run: landing files -> bronze -> silver -> gold -> forecast -> reorder -> gate.

Each stage is a plain function over named tables in one root folder; every table is written
once and read by whatever comes after.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeplan.config import PlanConfig
from lakeplan.forecast.accuracy import log_run, run_board, run_summary
from lakeplan.forecast.conformal import holdout_coverage
from lakeplan.forecast.grid import weekly_grid
from lakeplan.forecast.models import ets_baseline
from lakeplan.forecast.run import run_forecast
from lakeplan.functions.calendar import date_spine, dim_date
from lakeplan.functions.columns import month_start
from lakeplan.operators import aggregates as ag
from lakeplan.operators import facts as fx
from lakeplan.operators import quality as ql
from lakeplan.operators.clean import RAW, conform, with_raw
from lakeplan.operators.expectations import METRICS, Counted, Rule, accepted, as_received, tag
from lakeplan.operators.inventory import inventory_daily, inventory_weekly
from lakeplan.operators.joins import lookup
from lakeplan.operators.lift import event_uplift, promotion_lift
from lakeplan.operators.refresh import replace_partitions, week_months, within, within_weeks
from lakeplan.operators.reorder import reorder_plan
from lakeplan.operators.rfm import customer_rfm
from lakeplan.plans import kpi, silver
from lakeplan.plans.incremental import FEED_KEYS, ChangeLog, Pending, bronze_stream
from lakeplan.session import stages
from lakeplan.sources.clustering import files_for, quantile_cuts, write_interleaved
from lakeplan.sources.rescue import read_snapshot_rescued
from lakeplan.sources.writers import folder_exists, register_table
from lakeplan.streaming.ingest import FILES_PER_BATCH, Refresh, expect_stream, ingest_rescued

STREAM_FEEDS = ["orders", "sales_lines", "returns", "inventory", "purchase_orders", "customers"]
JSON_FEEDS = ["stores", "promotions"]
CSV_FEEDS = ["products", "product_prices", "product_costs", "material_prices", "suppliers", "geography", "warehouses",
             "channels", "events"]
STREAMED_SILVER = ["orders", "returns", "inventory", "purchase_orders"]
# Columns readers filter by, used as the file clustering of the large tables.
CLUSTERING = {
    "sales_lines": ["order_date", "sku_id"], "fact_sales_line": ["order_date", "sku_id"], "fact_orders": ["order_date"],
    "fact_inventory_daily": ["snapshot_date", "warehouse_id"], "agg_sales_daily": ["order_date", "zone"],
}
# Gold tables kept by month: the partition column, and the day that it is the month of.
PARTITIONED = {
    "fact_sales_line": ("order_month", "order_date"), "fact_orders": ("order_month", "order_date"),
    "agg_sales_daily": ("order_month", "order_date"), "agg_sales_monthly": ("month", "month"), "agg_sales_weekly": ("week_month", "week_start"),
}

# What the catalog says of the tables that people query by name.
COMMENTS = {
    ("gold", "fact_sales_line"): "One row per delivered or cancelled order line, with net revenue, cost and margin; by month of the order.",
    ("gold", "fact_orders"): "One row per order, from its lines; by month of the order.",
    ("gold", "fact_returns"): "One row per return, with the line it belongs to.",
    ("gold", "fact_inventory_daily"): "Stock by warehouse, SKU and day, with demand, shipments and stockouts.",
    ("gold", "fact_purchase_orders"): "Purchase orders with the promised and the actual lead time.",
    ("gold", "agg_sales_daily"): "Delivered sales by day, SKU, zone and channel; by month.",
    ("gold", "agg_sales_weekly"): "Delivered sales by week, SKU and zone, what the forecast learns from; by month of the week's start.",
    ("gold", "agg_sales_monthly"): "Delivered sales by month, fiscal period, product and zone.",
    ("gold", "agg_promo_effectiveness"): "Lift of each promotion over its baseline.",
    ("gold", "agg_event_uplift"): "Demand around each event against ordinary days.",
    ("gold", "agg_customer_rfm"): "Recency, frequency and value quintiles of customers.",
    ("gold", "agg_inventory_weekly"): "Fill rate and stockout days by week.",
    ("gold", "agg_margin_monthly"): "Margin by month, with the material price index.",
    ("gold", "dq_summary"): "Rejected and flagged rows by feed and reason.",
    ("gold", "gate_status"): "Outcome of the checks at the end of the run.",
    ("ml", "demand_forecast"): "Weekly demand by SKU and zone with a calibrated band; one row per week of the horizon.",
    ("ml", "forecast_backtest"): "Forecast against actual demand in the backtest's folds.",
    ("ml", "forecast_accuracy"): "WAPE of champion, direct and naive forecast, bias and coverage by SKU and zone.",
    ("ml", "forecast_model_comparison"): "WAPE of every candidate by level.",
    ("ml", "reorder_recommendation"): "What to order by warehouse and SKU, with the stockout risk behind it.",
}


def ddl(feed: str, as_text: bool = False, raw_types: dict[str, dict[str, str]] | None = None) -> str:
    """Columns of a landing feed: text for CSV and JSON, else the silver types unless ``raw_types`` names others."""
    cols = {**silver.SCHEMAS[feed], **(raw_types or {}).get(feed, {})}
    if feed in ("sales_lines", "inventory", "orders"):
        cols["batch"] = "string"
    return ", ".join(f"{c} {'string' if as_text else t}" for c, t in cols.items())


LINEAGE = "_source_file string, _ingest_ts timestamp, _rescued string"


@dataclass
class Lake:
    """Tables of all layers below one root folder; with ``database`` also catalog tables <database>.<layer>_<name>."""

    spark: SparkSession
    root: str
    database: str | None = None

    def __post_init__(self) -> None:
        if self.database:
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.database}")

    def published(self, layer: str, name: str) -> DataFrame:
        """The table just written, after the catalog has learnt of it."""
        if self.database:
            register_table(self.spark, f"{self.database}.{layer}_{name}", self.path(layer, name), COMMENTS.get((layer, name)),
                           layer == "gold" and name in PARTITIONED)
        return self.table(layer, name)

    def path(self, layer: str, name: str) -> str:
        return f"{self.root}/{layer}/{name}"

    def save(self, layer: str, name: str, df: DataFrame, like: DataFrame | None = None) -> DataFrame:
        """Replace a table; one with ``like``, a stored table of its columns, is clustered on all of its CLUSTERING columns."""
        path = self.path(layer, name)
        if like is not None:
            write_interleaved(df, path, quantile_cuts(like, CLUSTERING[name]), files_for(like))
        else:
            df.write.mode("overwrite").parquet(path)
        return self.published(layer, name)

    def refresh(self, layer: str, name: str, df: DataFrame, months: list[dt.date] | None) -> DataFrame:
        """Replace the partitions of ``months``, all if None, of a table kept by month."""
        partition, day = PARTITIONED[name]
        if partition not in df.columns:
            df = df.withColumn(partition, month_start(day))
        if months is None or months:
            replace_partitions(df, self.path(layer, name), partition, months, CLUSTERING.get(name, [day]))
        return self.published(layer, name)

    def table(self, layer: str, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(layer, name))


def bronze(lake: Lake, landing: str, full: bool = False, raw_types: dict | None = None) -> int:
    """Ingest new stream files and re-read the snapshots; returns the refresh version.

    A feed that has not delivered yet has no folder and is left for a later run.
    """
    refresh = Refresh(lake.spark, lake.path("bronze", "streams"))
    version = refresh.begin(full)
    for feed in STREAM_FEEDS:
        out, ckpt = refresh.paths(feed, version)
        if folder_exists(lake.spark, f"{landing}/{feed}"):
            ingest_rescued(lake.spark, f"{landing}/{feed}", ddl(feed, raw_types=raw_types), out, ckpt)
    for fmt, feeds in (("json", JSON_FEEDS), ("csv", CSV_FEEDS)):
        for feed in feeds:
            lake.save("bronze", feed, read_snapshot_rescued(lake.spark, f"{landing}/{feed}", fmt, ddl(feed, as_text=True)))
    return version


def raw(lake: Lake, feed: str, version: int, raw_types: dict | None = None) -> DataFrame:
    out, _ = Refresh(lake.spark, lake.path("bronze", "streams")).paths(feed, version)
    schema = f"{ddl(feed, raw_types=raw_types)}, {LINEAGE}"
    if not folder_exists(lake.spark, out):
        return lake.spark.createDataFrame([], schema)
    return lake.spark.read.schema(schema).parquet(out).drop("batch_id")


def typed(feed: str, rows: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    return conform(with_raw(rows), silver.SCHEMAS[feed], [RAW, *keep])


def save_split(lake: Lake, feed: str, rows: DataFrame, rules: list[Rule], counts: dict[str, Counted]) -> DataFrame:
    """Save a snapshot feed and its quarantine, whose write counts the rules; gives the accepted rows."""
    tagged = tag(rows, rules)
    if rules:
        counts[feed] = Counted(rules)
        lake.save("silver", f"{feed}_quarantine", as_received(counts[feed].watch(tagged)))
    return lake.save("silver", feed, accepted(tagged).drop(RAW))


def silver_layer(lake: Lake, version: int, zones: list[str] | None = None, spellings: dict[str, str] | None = None,
                 raw_types: dict | None = None) -> None:
    """Typed, checked tables; whatever a rule drops goes to a quarantine with its raw values."""
    spark = lake.spark
    counts: dict[str, Counted] = {}
    for feed in [f for f in CSV_FEEDS if f != "geography"] + ["promotions"]:
        save_split(lake, feed, typed(feed, lake.table("bronze", feed)), silver.RULES.get(feed, []), counts)
    geo = save_split(lake, "geography", typed("geography", lake.table("bronze", "geography")), [silver.zone_rule(zones or silver.ZONES)], counts)
    stores = silver.located_stores(typed("stores", lake.table("bronze", "stores")), geo, spellings or silver.STATE_SPELLINGS)
    save_split(lake, "stores", stores, silver.RULES["stores"], counts)
    customers = typed("customers", raw(lake, "customers", version, raw_types), ("_ingest_ts",))
    counts["customers"] = Counted(silver.RULES["customers"])
    tagged = counts["customers"].watch(tag(customers, silver.RULES["customers"]))
    lake.save("silver", "customers_quarantine", as_received(tagged))
    newest = silver.silver_customers(accepted(tagged).drop(RAW), ties=[F.xxhash64(*silver.SCHEMAS["customers"]).asc()])
    lake.save("silver", "customers", newest.select(*silver.SCHEMAS["customers"]))
    refresh = Refresh(spark, lake.path("silver", "streams"))
    for feed in STREAMED_SILVER:
        source, _ = Refresh(spark, lake.path("bronze", "streams")).paths(feed, version)
        out, ckpt = refresh.paths(feed, version)
        if folder_exists(spark, source):
            schema = f"{ddl(feed, raw_types=raw_types)}, {LINEAGE}"
            stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", FILES_PER_BATCH).parquet(source)
            expect_stream(checked(feed, stream), silver.RULES[feed], f"{out}/clean", f"{out}/quarantine", ckpt, f"{out}/rule_counts")
        if not folder_exists(spark, f"{out}/clean"):
            nothing = tag(checked(feed, raw(lake, feed, version, raw_types).limit(0)), silver.RULES[feed])
            accepted(nothing).drop(RAW).write.parquet(f"{out}/clean/batch_id=-1")
            as_received(nothing).write.parquet(f"{out}/quarantine/batch_id=-1")
    lines = typed("sales_lines", raw(lake, "sales_lines", version, raw_types), ("_ingest_ts", "_source_file", "batch"))
    order = [F.col("_ingest_ts").asc(), F.col("_source_file").asc(), F.col("batch").asc(),
             F.xxhash64(*silver.SCHEMAS["sales_lines"]).asc()]
    counts["sales_lines"] = Counted(silver.RULES["sales_lines"])
    clean, refused = silver.clean_and_rejected(lines, lake.table("silver", "products"), order, counts["sales_lines"])
    lake.save("silver", "sales_lines", clean, like=lines)
    lake.save("silver", "sales_lines_quarantine", refused)
    lake.save("silver", "rule_metrics", rule_counts(lake, version, counts))


def rule_counts(lake: Lake, version: int, counts: dict[str, Counted]) -> DataFrame:
    """Every rule's counts: those that this run's jobs observed on whole feeds, and the sums over the batches of streamed ones."""
    found = [(feed, *row) for feed, counted in counts.items() for row in counted.rows()]
    tables = [lake.spark.createDataFrame(found, f"source_table string, {METRICS}")]
    for feed in STREAMED_SILVER:
        out, _ = Refresh(lake.spark, lake.path("silver", "streams")).paths(feed, version)
        seen = lake.spark.createDataFrame([(r.name, r.action, 0, 0) for r in silver.RULES[feed]], METRICS)
        if folder_exists(lake.spark, f"{out}/rule_counts"):
            seen = seen.unionByName(lake.spark.read.schema(METRICS).parquet(f"{out}/rule_counts").drop("batch_id"))
        sums = seen.groupBy("rule", "action").agg(F.sum("passed_rows").alias("passed_rows"), F.sum("failed_rows").alias("failed_rows"))
        tables.append(sums.select(F.lit(feed).alias("source_table"), "*"))
    return ql.union_all(tables)


def checked(feed: str, rows: DataFrame) -> DataFrame:
    """Typed rows of a streamed feed, as its rules read them."""
    if feed == "orders":
        return typed(feed, rows, ("_ingest_ts",)).withColumn("order_date", F.to_date("order_ts"))
    return typed(feed, rows)


def streamed(lake: Lake, feed: str, version: int, side: str = "clean") -> DataFrame:
    out, _ = Refresh(lake.spark, lake.path("silver", "streams")).paths(feed, version)
    return lake.spark.read.parquet(f"{out}/{side}").drop("batch_id")


def pending_months(lake: Lake, version: int, cfg: PlanConfig, raw_types: dict | None = None) -> tuple[ChangeLog, Pending]:
    """What the feeds have brought since gold was last refreshed."""
    spark, log = lake.spark, ChangeLog(lake.spark, lake.path("gold", "_changes"), version)
    lines = lake.table("silver", "sales_lines").select("line_id", "order_id", "order_date")
    for feed, key in FEED_KEYS.items():
        source, _ = Refresh(spark, lake.path("bronze", "streams")).paths(feed, version)
        if folder_exists(spark, source):
            kind = (raw_types or {}).get(feed, {}).get(key, silver.SCHEMAS[feed][key])
            log.note(feed, bronze_stream(spark, source, f"{key} {kind}"), lines)
    joined = [lake.table("silver", t) for t in ("products", "stores", "product_costs", "channels", "events")]
    settings = spark.createDataFrame([(cfg.calendar_start, cfg.calendar_end, cfg.fiscal_start_month)], "a string, b string, c int")
    return log, log.pending([*joined, settings])


def gold_layer(lake: Lake, version: int, cfg: PlanConfig, raw_types: dict | None = None) -> list[dt.date] | None:
    """All gold tables; sales facts and aggregates for the months that this run touches only. Gives these months, None for all."""
    log, pending = pending_months(lake, version, cfg, raw_types)
    months, weeks = pending.months, week_months(pending.months)
    s = lambda name: lake.table("silver", name)
    g = lambda name, df: lake.save("gold", name, df)
    by_month = lambda name, df, touched=months: lake.refresh("gold", name, df, touched)
    of_months = lambda df: df.where(within("order_date", months))
    calendar = g("dim_date", dim_date(date_spine(lake.spark, cfg.calendar_start, cfg.calendar_end), s("events"),
                                      cfg.fiscal_start_month, cfg.as_of))
    products = g("dim_product", fx.dim_product(s("products")))
    g("dim_product_price_history", fx.dim_price_history(s("product_prices")))
    g("dim_store", fx.dim_store(s("stores"), s("channels")))
    customers = g("dim_customer", fx.dim_customer(s("customers"), s("geography")))
    g("dim_promotion", fx.dim_promotion(s("promotions")))
    for name, source in (("dim_geography", "geography"), ("dim_channel", "channels"), ("dim_warehouse", "warehouses"),
                         ("dim_supplier", "suppliers"), ("dim_event", "events")):
        g(name, s(source))
    orders, returns = streamed(lake, "orders", version), streamed(lake, "returns", version)
    lines = of_months(s("sales_lines"))
    fact = by_month("fact_sales_line", fx.fact_sales_line(lines, orders, products, s("stores"), s("product_costs"), returns))
    heads = by_month("fact_orders", fx.orders_from_lines(of_months(fact)))
    g("fact_returns", fx.fact_returns(returns, fact, products))
    stock = streamed(lake, "inventory", version)
    inv = lake.save("gold", "fact_inventory_daily", inventory_daily(stock, s("product_costs")), like=stock)
    g("fact_purchase_orders", fx.fact_purchase_orders(streamed(lake, "purchase_orders", version), s("suppliers"), products))
    daily = by_month("agg_sales_daily", ag.sales_daily(of_months(fact), s("channels")))
    by_month("agg_sales_monthly", ag.sales_monthly(of_months(fact), calendar))
    by_month("agg_sales_weekly", ag.sales_weekly(daily.where(within_weeks("order_date", weeks))), weeks)
    g("agg_promo_effectiveness", promotion_lift(s("promotions"), daily, as_of=cfg.as_of))
    first_day = F.date_add(daily.agg(F.min("order_date")).scalar(), cfg.event_history_days)
    g("agg_event_uplift", event_uplift(
        s("events").where(F.col("event_date").between(first_day, F.lit(cfg.as_of).cast("date"))), daily,
        ["zone", "base_product", "category"]))
    g("agg_customer_rfm", customer_rfm(heads, customers, cfg.as_of, ["zone", "city", "loyalty_tier", "age_band", "gender"]))
    g("agg_inventory_weekly", inventory_weekly(inv, products))
    g("agg_margin_monthly", ag.margin_monthly(fact, s("material_prices")))
    rejects = [(f, s(f"{f}_quarantine")) for f in ("sales_lines", "geography", "products", "stores", "customers")]
    rejects += [(f, streamed(lake, f, version, "quarantine")) for f in STREAMED_SILVER]
    g("dq_summary", ql.dq_summary(
        rejects,
        [("sales_lines", "late-arriving (accepted)", s("sales_lines"), "arrived_late"),
         ("stores", "state name corrected (accepted)", s("stores"), "state_was_corrected")]))
    log.done(pending)
    return months


def planning(lake: Lake, cfg: PlanConfig, first_week: str) -> None:
    g = lambda name: lake.table("gold", name)
    weekly, products = g("agg_sales_weekly"), g("dim_product")
    out = run_forecast(weekly, products, g("dim_event"), cfg)
    for name, df in (("demand_forecast", out.forecast), ("forecast_backtest", out.backtest),
                     ("forecast_accuracy", out.accuracy), ("forecast_model_comparison", out.comparison)):
        stamped = df.withColumn("created_at", F.current_timestamp())
        lake.save("ml", name, stamped)
    grid = weekly_grid(weekly, ["sku_id", "zone"], cfg.last_full_week).withColumnRenamed("sku_id", "series_key")
    lake.save("ml", "forecast_baseline", ets_baseline(grid, cfg.horizon_weeks + 1).withColumnRenamed("series_key", "sku_id"))
    lake.save("ml", "reorder_recommendation", reorder_plan(
        lake.table("ml", "demand_forecast"), g("fact_sales_line"), g("fact_inventory_daily"), g("fact_purchase_orders"),
        products, g("dim_warehouse"), cfg, first_week))
    bt = lookup(lake.table("ml", "forecast_backtest").withColumn("fc", F.col("forecast_units")), products.select("sku_id", "category"), "sku_id")
    log_run(lake.spark, lake.path("ml", "runs"), "demand_forecast",
            {"horizon_weeks": cfg.horizon_weeks, "folds": cfg.folds, "naive_weight": cfg.naive_weight,
             "trained_through": cfg.last_full_week},
            run_summary(lake.table("ml", "forecast_accuracy"), lake.table("ml", "forecast_backtest")),
            run_board(lake.table("ml", "forecast_model_comparison")), holdout_coverage(bt, ["category", "zone"]))


def quality_gate(lake: Lake, version: int, cfg: PlanConfig, enforce: bool = True) -> DataFrame:
    """Write the status rows, then raise on a breach if asked to."""
    g = lambda name: lake.table("gold", name)
    view = kpi.sales_metrics(g("agg_sales_daily"), g("dim_date"), g("dim_product"))
    status = lake.save("gold", "gate_status", ql.gate(
        g("dq_summary"), raw(lake, "sales_lines", version), g("fact_sales_line"), g("dim_product"), g("dim_store"),
        g("agg_sales_daily"), view.query([], ["net_revenue"]), lake.table("ml", "demand_forecast"), cfg.as_of,
        cfg.reject_limit, cfg.reconcile_limit, cfg.horizon_weeks))
    lake.save("gold", "alerts", ql.alerts(
        lake.table("ml", "reorder_recommendation"), lake.table("ml", "forecast_backtest"), g("dq_summary"),
        raw(lake, "sales_lines", version), max_reject=cfg.reject_limit))
    if enforce:
        ql.enforce(status).write.format("noop").mode("overwrite").save()
    return status


def run_end_to_end(spark: SparkSession, landing: str, root: str, cfg: PlanConfig, first_week: str,
                   zones: list[str] | None = None, full: bool = False, enforce: bool = True,
                   spellings: dict[str, str] | None = None, raw_types: dict | None = None, database: str | None = None) -> Lake:
    """All layers; the scratch stages of the run are removed when it ends. With ``database`` its tables are also in the catalog."""
    lake = Lake(spark, root, database)
    with stages(spark):
        version = bronze(lake, landing, full, raw_types)
        silver_layer(lake, version, zones, spellings, raw_types)
        gold_layer(lake, version, cfg, raw_types)
        planning(lake, cfg, first_week)
        quality_gate(lake, version, cfg, enforce)
    return lake
