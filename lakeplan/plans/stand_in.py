"""The driver's order/line tables seen as the retail model.

The test tables have no planning domain of their own, so this module maps them: a SKU is
(brand, type), its base product the brand, a zone the customer's region, a warehouse a
region, a channel the order priority.  They hold no faults either, so faults are derived by
fixed predicates on values (quantity 50 turns negative, a price below 950 goes missing, a
part size above 45 is an unknown SKU, a small order has no store).
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeplan.config import PlanConfig
from lakeplan.forecast.grid import weekly_grid
from lakeplan.forecast.run import candidate_table, plan_from_candidates, raw_forecasts
from lakeplan.forecast.grid import rollup_series
from lakeplan.functions.calendar import date_spine, dim_date, spine_of
from lakeplan.operators.aggregates import DAILY_INPUT, DELIVERED, sales_daily, sales_monthly, sales_weekly
from lakeplan.operators.clean import arrived_late
from lakeplan.operators.dedupe import mark_later
from lakeplan.operators.expectations import accepted, keep_valid, rejected
from lakeplan.operators.facts import (
    dim_customer, dim_product, fact_purchase_orders, fact_returns, fact_sales_line, orders_from_lines,
)
from lakeplan.operators.inventory import inventory_daily, inventory_weekly, ledger
from lakeplan.operators.joins import lookup
from lakeplan.operators.quality import dq_summary
from lakeplan.operators.reorder import reorder_plan
from lakeplan.plans import silver
from lakeplan.session import checkpoint_table, is_small, measured

CFG = PlanConfig(as_of="2001-07-31", last_full_week="2001-07-23",
                 calendar_start="1995-01-01", calendar_end="2001-12-31")
FIRST_FORECAST_WEEK = "2001-07-30"
COSTS_FROM = "1995-06-01"
OPENING_STOCK = 200

# Literal dimension rows, used alike here and in the SQL checks.
CHANNELS = [
    ("1-URGENT", "Urgent", "Online"), ("2-HIGH", "High", "Online"), ("3-MEDIUM", "Medium", "Offline"),
    ("4-NOT SPECIFIED", "Not specified", "Offline"), ("5-LOW", "Low", "B2B"),
]
EVENTS = [
    ("Harvest", "1996-10-20"), ("Harvest", "1997-10-10"), ("Harvest", "1998-10-28"), ("Harvest", "1999-10-17"),
    ("Harvest", "2000-10-06"), ("Harvest", "2001-10-25"), ("Lights", "1997-11-01"), ("Lights", "1998-11-19"),
    ("Lights", "1999-11-07"), ("Lights", "2000-10-26"), ("Colour", "1998-03-13"), ("Spring", "1998-03-13"),
    ("Colour", "2000-03-20"), ("Kite", "1999-01-14"), ("Kite", "2001-01-14"),
]
PROMOS = [
    ("P01", "NEWYEAR97", "New year", "Flat", 0.10, "1997-01-01", "1997-01-10", "1-URGENT", "All", None),
    ("P02", "HARVEST97", "Harvest deal", "Festive", 0.15, "1997-10-01", "1997-10-10", "2-HIGH", "PROMO", "Harvest"),
    ("P03", "SUMMER98", "Summer sale", "Flat", 0.05, "1998-05-01", "1998-05-31", "3-MEDIUM", "All", None),
    ("P04", "HARVEST98", "Harvest deal", "Festive", 0.15, "1998-10-18", "1998-10-28", "1-URGENT", "All", "Harvest"),
    ("P05", "SLAB99", "Trade slab", "Trade", 0.08, "1999-02-01", "1999-02-28", "5-LOW", "LARGE", None),
    ("P06", "LIGHTS00", "Lights week", "Festive", 0.20, "2000-10-20", "2000-10-26", "4-NOT SPECIFIED", "All", "Lights"),
    ("P07", "NEWYEAR01", "New year", "Flat", 0.12, "2001-01-01", "2001-01-10", "1-URGENT", "All", None),
    ("P08", "LATER01", "Later", "Flat", 0.12, "2001-09-01", "2001-09-10", "2-HIGH", "All", None),
]
SEGMENT_WAREHOUSE = {
    "BUILDING": "WH-AFRICA", "AUTOMOBILE": "WH-AMERICA", "MACHINERY": "WH-ASIA", "HOUSEHOLD": "WH-EUROPE",
    "FURNITURE": "WH-MIDDLE EAST",
}
PACKS = {"ECONOMY": 50, "SMALL": 50, "MEDIUM": 100, "STANDARD": 200, "LARGE": 500, "PROMO": 1000}
GROUP_A = ["Brand#1", "Brand#2"]
DECISIONS = [
    ("Approved", None, "2001-08-01 09:00:00"), ("Modified", 40.0, "2001-08-01 10:00:00"),
]
LINE_KEY = ["order_id", "line_no"]  # what a line_id is made of; lines lie together by order already
LINE_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"]
#: What planning reads: the daily aggregate, the warehouses' shares, open orders, lead times and decisions.
PLANNING_FACT = [*DAILY_INPUT, "warehouse_id"]
PLANNING_POS = ["warehouse_id", "sku_id", "po_date", "expected_date", "received_date", "ordered_units", "actual_lead_days"]


def group_a():
    return F.col("base_code").isin(GROUP_A)


class StandIn:
    """Lazy frames of every layer over one folder of driver tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir

    def share(self, *layers: str, **narrow: list[str]) -> None:
        """Write layers once that what follows reads more than once; later uses see the written rows.

        Of a layer named with columns only these are written, and what follows must need no others.
        """
        for name in (*layers, *narrow):
            layer = getattr(self, name)
            self.__dict__[name] = checkpoint_table(layer.select(*narrow[name]) if name in narrow else layer, name)

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    lineitem = cached_property(lambda self: self.read("lineitem"))
    orders_tbl = cached_property(lambda self: self.read("orders"))
    customer = cached_property(lambda self: self.read("customer"))
    part = cached_property(lambda self: self.read("part"))
    supplier = cached_property(lambda self: self.read("supplier"))
    nation = cached_property(lambda self: self.read("nation"))
    region = cached_property(lambda self: self.read("region"))
    events_tbl = cached_property(lambda self: self.read("events"))

    # ---- reference data
    @cached_property
    def channels(self) -> DataFrame:
        return self.spark.createDataFrame(CHANNELS, "channel_code string, channel_name string, channel_group string")

    @cached_property
    def events(self) -> DataFrame:
        df = self.spark.createDataFrame(EVENTS, "event_name string, d string")
        return df.select("event_name", F.to_date("d").alias("event_date"), F.year(F.to_date("d")).alias("year"),
                         F.lit("All").alias("region_relevance"))

    @cached_property
    def promotions(self) -> DataFrame:
        df = self.spark.createDataFrame(
            PROMOS, "promo_id string, promo_code string, promo_name string, promo_type string, discount_pct double, "
                    "start_date string, end_date string, channel_code string, category_scope string, event_name string")
        return df.withColumns({c: F.to_date(c) for c in ("start_date", "end_date")})

    @cached_property
    def geography(self) -> DataFrame:
        n = lookup(self.nation, self.region, F.col("n_regionkey") == F.col("r_regionkey"))
        return n.select(
            F.concat(F.lit("CITY_"), F.col("n_nationkey").cast("string")).alias("city"),
            F.col("n_name").alias("state"), F.col("r_name").alias("zone"),
            F.expr("CASE WHEN n_nationkey < 8 THEN 1 WHEN n_nationkey < 16 THEN 2 ELSE 3 END").alias("tier"),
            (F.lit(8.0) + F.col("n_nationkey")).alias("lat"), (F.lit(68.0) + 2.0 * F.col("n_nationkey")).alias("lon"),
            F.col("n_nationkey").alias("city_id"))

    @cached_property
    def warehouses(self) -> DataFrame:
        return self.region.select(
            F.concat(F.lit("WH-"), F.col("r_name")).alias("warehouse_id"),
            F.concat(F.col("r_name"), F.lit(" DC")).alias("warehouse_name"), F.col("r_name").alias("zone"))

    @cached_property
    def products(self) -> DataFrame:
        """Written once: an aggregate is planned as large as all the parts behind it, and every join of lines with SKUs asks its size."""
        pack = F.create_map(*[F.lit(x) for kv in PACKS.items() for x in kv])
        return checkpoint_table(
            self.part.groupBy("p_brand", "p_type").agg(F.max("p_retailprice").alias("mrp"))
            .select(
                F.concat_ws("|", "p_brand", "p_type").alias("sku_id"),
                F.concat_ws(" ", "p_brand", "p_type").alias("product_name"),
                F.col("p_brand").alias("base_code"), F.col("p_brand").alias("base_product"),
                F.col("p_type").alias("category"), pack[F.col("p_type")].alias("pack_size"), "mrp",
                F.when(F.col("p_type") == "PROMO", 0.15).otherwise(0.05).alias("tax_rate"),
                (F.col("p_type") == "PROMO").alias("is_organic"), F.lit("1994-01-01").cast("date").alias("launch_date")),
            "products")

    @cached_property
    def dim_product(self) -> DataFrame:
        return dim_product(self.products)

    def months(self, df: DataFrame, first: str) -> DataFrame:
        span = df.withColumns({"_a": F.lit(first).cast("date"), "_b": F.lit("2001-12-01").cast("date")})
        return spine_of(span, "_a", "_b", "1 MONTH", "month").drop("_a", "_b")

    @cached_property
    def costs(self) -> DataFrame:
        part = F.expr("CAST(0.5 + month(month) / 100D AS decimal(6,4))")
        return self.months(self.products.select("sku_id", "mrp"), COSTS_FROM).select(
            "sku_id", "month", F.round(F.col("mrp").cast("decimal(12,4)") * part, 2).cast("double").alias("unit_cost"))

    @cached_property
    def materials(self) -> DataFrame:
        brands = self.part.select(F.col("p_brand").alias("base_code")).distinct()
        return self.months(brands, "1995-01-01").select(
            "base_code", "month", F.round(1 + F.month("month") / 100, 2).alias("price_index"),
            (100.0 + F.month("month")).alias("price_per_kg"))

    @cached_property
    def suppliers(self) -> DataFrame:
        return self.supplier.select(
            F.col("s_suppkey").alias("supplier_id"), F.col("s_name").alias("supplier_name"),
            F.when(F.col("s_acctbal") >= 0, "Primary").otherwise("Alternate").alias("supplier_tier"))

    @cached_property
    def supplier_site(self) -> DataFrame:
        at = lookup(lookup(self.supplier, self.nation, F.col("s_nationkey") == F.col("n_nationkey")),
                    self.region, F.col("n_regionkey") == F.col("r_regionkey"))
        return measured(at.select("s_suppkey", F.concat(F.lit("WH-"), F.col("r_name")).alias("warehouse_id")), "supplier_site")

    @cached_property
    def dim_date(self) -> DataFrame:
        return dim_date(date_spine(self.spark, CFG.calendar_start, CFG.calendar_end), self.events, actuals_to=CFG.as_of)

    # ---- raw feeds
    @cached_property
    def raw_stores(self) -> DataFrame:
        n = lookup(self.customer, self.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        site = F.create_map(*[F.lit(x) for kv in SEGMENT_WAREHOUSE.items() for x in kv])
        return n.select(
            F.col("c_custkey").alias("store_id"), F.col("c_name").alias("store_name"),
            F.col("c_mktsegment").alias("store_type"),
            F.concat(F.lit("CITY_"), F.col("c_nationkey").cast("string")).alias("city"),
            F.expr("CASE WHEN c_acctbal < 0 THEN concat('Nation ', CAST(c_nationkey AS string)) "
                   "WHEN c_acctbal > 9000 THEN concat(' ', n_name) ELSE n_name END").alias("state"),
            site[F.col("c_mktsegment")].alias("warehouse_id"),
            F.lit("1994-06-01").cast("date").alias("opened_date"),
            F.expr("CASE WHEN c_acctbal > 9500 THEN DATE'2001-01-01' END").alias("closed_date"))

    spellings = {f"Nation {i}": f"NATION_{i}" for i in range(25)}

    @cached_property
    def stores(self) -> DataFrame:
        return silver.silver_stores(self.raw_stores, self.geography, self.spellings)

    @cached_property
    def customers(self) -> DataFrame:
        n = lookup(self.customer, self.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        return n.select(
            F.col("c_custkey").cast("string").alias("customer_id"), F.col("c_name").alias("full_name"),
            F.concat(F.lit("CITY_"), F.col("c_nationkey").cast("string")).alias("city"),
            F.col("n_name").alias("state"), F.col("c_mktsegment").alias("loyalty_tier"), "c_acctbal")

    @cached_property
    def dim_customer(self) -> DataFrame:
        return dim_customer(self.customers, self.geography)

    @cached_property
    def raw_orders(self) -> DataFrame:
        return self.orders_tbl.selectExpr(
            "o_orderkey AS order_id", "CAST(o_orderdate AS timestamp) AS order_ts",
            "CAST(o_orderdate AS date) AS order_date",
            "CASE WHEN o_totalprice >= 2500 THEN o_custkey END AS store_id",
            "o_orderpriority AS channel_code",
            "CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(o_custkey AS string) END AS customer_id",
            "CASE WHEN o_totalprice >= 250000 THEN 'Credit' ELSE 'Cash' END AS payment_mode",
            "CASE WHEN o_totalprice > 499000 THEN 'Lost' WHEN o_orderstatus = 'P' THEN 'Cancelled' "
            "ELSE 'Delivered' END AS order_status")

    @cached_property
    def orders(self) -> DataFrame:
        return silver.silver_orders(self.raw_orders)

    @cached_property
    def line_base(self) -> DataFrame:
        """Lines with their order date, SKU and list price, shared by the sales, return and purchase feeds.

        Parts too many to send around meet the lines first: the join with the orders then leaves these by order in either case.
        """
        o = self.orders_tbl.selectExpr("o_orderkey AS l_orderkey", "CAST(o_orderdate AS date) AS order_date")
        p = self.part.selectExpr(
            "p_partkey AS l_partkey", "p_retailprice",
            "CASE WHEN p_size > 45 THEN concat('X-', p_brand) ELSE concat_ws('|', p_brand, p_type) END AS sku_id")
        joined = (lookup(self.lineitem.join(o, "l_orderkey"), p, "l_partkey") if is_small(p)
                  else self.lineitem.join(p.hint("shuffle_hash"), "l_partkey").join(o, "l_orderkey"))
        return joined.withColumns({
            "ship_date": F.to_date("l_shipdate"), "line_id": F.concat_ws("-", "l_orderkey", "l_linenumber")})

    @cached_property
    def raw_lines(self) -> DataFrame:
        return self.line_base.selectExpr(
            "line_id", "l_orderkey AS order_id", "l_linenumber AS line_no", "order_date", "sku_id",
            "CASE WHEN l_quantity = 50 THEN -50 ELSE CAST(l_quantity AS int) END AS quantity",
            "p_retailprice AS unit_mrp",
            "CASE WHEN l_extendedprice >= 950 THEN CAST(round(CAST(l_extendedprice AS decimal(12,2)) / "
            "CAST(l_quantity AS decimal(4,0)), 2) AS double) END AS unit_price",
            "CASE WHEN l_discount >= 0.08 THEN 'PROMO-8' WHEN l_discount >= 0.05 THEN 'PROMO-5' END AS promo_code",
            "l_discount AS discount_pct",
            "CAST(round(CAST(l_extendedprice AS decimal(12,2)) * (1 - CAST(l_discount AS decimal(5,4))), 2) AS double)"
            " AS line_amount",
            "date_format(l_shipdate, 'yyyy-MM') AS batch", *LINE_ORDER)

    @property
    def line_order(self):
        return [F.col(c).asc() for c in LINE_ORDER]

    @cached_property
    def lines(self) -> DataFrame:
        """Shuffled by order at most once: the join with the orders may have done so, and what follows needs no other place."""
        return silver.silver_lines(self.raw_lines.repartition("order_id"), self.products, self.line_order, LINE_KEY)

    def split_lines(self) -> None:
        """Write the lines with their reasons once, ranked where the join with the orders left them.

        Clean, rejected and raw lines are read from that, without the columns that only order copies.
        """
        tagged = checkpoint_table(silver.tagged_lines(
            self.raw_lines.repartition("order_id"), self.products, self.line_order, LINE_KEY, mark_later).drop(*LINE_ORDER), "tagged_lines")
        self.__dict__["lines"] = accepted(tagged).drop("is_duplicate").withColumn("arrived_late", arrived_late())
        self.__dict__["lines_quarantine"] = rejected(tagged)
        self.__dict__["raw_lines"] = tagged.drop("sku_known", "is_duplicate", "dq_reason")

    @cached_property
    def lines_quarantine(self) -> DataFrame:
        return silver.lines_quarantine(self.raw_lines, self.products, self.line_order)

    @cached_property
    def raw_returns(self) -> DataFrame:
        return self.line_base.where("l_returnflag = 'R'").selectExpr(
            "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS return_id", "line_id",
            "l_orderkey AS order_id", "sku_id", "ship_date AS return_date",
            "CASE WHEN l_discount >= 0.1 THEN 0 ELSE CAST(l_quantity AS int) END AS return_qty",
            "CASE WHEN l_linestatus = 'F' THEN 'Damaged' ELSE 'Wrong item' END AS return_reason",
            "l_extendedprice AS refund_amount")

    @cached_property
    def returns(self) -> DataFrame:
        return keep_valid(self.raw_returns, silver.RULES["returns"])

    @cached_property
    def movements(self) -> DataFrame:
        """Daily receipts, demand and shipments per warehouse and SKU, unknown SKUs included."""
        moved = lookup(self.line_base, self.supplier_site.withColumnRenamed("s_suppkey", "l_suppkey"),
                       "l_suppkey")
        qty = F.col("l_quantity").cast("long")
        part = lambda c: F.coalesce(F.sum(F.when(F.expr(c), qty)), F.lit(0))
        return moved.where("l_returnflag IN ('A', 'N')").groupBy(
            "warehouse_id", "sku_id", F.col("ship_date").alias("snapshot_date")).agg(
            part("l_returnflag = 'A' AND l_tax <= 0.06").alias("receipts_units"),
            part("l_returnflag = 'N'").alias("demand_units"),
            part("l_returnflag = 'N' AND l_discount < 0.09").alias("shipped_units"))

    @cached_property
    def raw_inventory(self) -> DataFrame:
        return ledger(self.movements, OPENING_STOCK).withColumns(
            {"reorder_point_units": F.lit(60), "safety_stock_units": F.lit(30)})

    @cached_property
    def snapshots(self) -> DataFrame:
        return keep_valid(self.raw_inventory, silver.RULES["inventory"])

    @cached_property
    def inventory(self) -> DataFrame:
        return inventory_daily(self.snapshots, self.costs)

    @cached_property
    def inventory_weekly(self) -> DataFrame:
        return inventory_weekly(self.inventory, self.products)

    @cached_property
    def raw_pos(self) -> DataFrame:
        """Lines with flag 'A' shipped on or after their order date; lead times are folded into 60 days."""
        bought = self.line_base.where("l_returnflag = 'A' AND ship_date >= order_date")
        sited = lookup(bought, self.supplier_site.withColumnRenamed("s_suppkey", "l_suppkey"), "l_suppkey")
        return sited.selectExpr(
            "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS po_id", "order_date AS po_date",
            "l_suppkey AS supplier_id", "warehouse_id", "sku_id", "CAST(l_quantity AS bigint) AS ordered_units",
            "CAST(floor(CAST(l_quantity AS decimal(4,0)) * (1 - CAST(l_discount AS decimal(5,4)))) AS bigint) AS received_units",
            "l_extendedprice AS po_value", "date_add(order_date, 30) AS expected_date",
            "CASE WHEN l_tax < 0.07 THEN date_add(order_date, pmod(datediff(ship_date, order_date), 60)) END AS received_date",
            "CASE WHEN l_linestatus = 'F' THEN 'A' ELSE 'B' END AS quality_grade")

    @cached_property
    def pos(self) -> DataFrame:
        return fact_purchase_orders(keep_valid(self.raw_pos, silver.RULES["purchase_orders"]),
                                    self.suppliers, self.products)

    # ---- gold
    @cached_property
    def fact(self) -> DataFrame:
        return fact_sales_line(self.lines, self.orders, self.products, self.stores, self.costs, self.returns, by_order=True)

    @cached_property
    def fact_orders(self) -> DataFrame:
        return orders_from_lines(self.fact)

    @cached_property
    def fact_returns(self) -> DataFrame:
        return fact_returns(self.returns, self.fact, self.products)

    @cached_property
    def daily(self) -> DataFrame:
        return sales_daily(self.fact, self.channels)

    @cached_property
    def monthly(self) -> DataFrame:
        return sales_monthly(self.fact, self.dim_date)

    @cached_property
    def weekly(self) -> DataFrame:
        return sales_weekly(self.daily)

    @cached_property
    def dq_summary(self) -> DataFrame:
        return dq_summary(
            [("sales_lines", self.lines_quarantine), ("orders", silver.orders_quarantine(self.raw_orders))],
            [("sales_lines", "late-arriving (accepted)", self.lines, "arrived_late"),
             ("stores", "state name corrected (accepted)", self.stores, "state_was_corrected")])

    # ---- planning, on the relational base models.  The weekly table, the raw forecasts and the
    # candidates are read several times downstream, so each is written once.
    @cached_property
    def saved_weekly(self) -> DataFrame:
        return checkpoint_table(self.weekly, "weekly")

    @cached_property
    def grid(self) -> DataFrame:
        grid = weekly_grid(self.saved_weekly, ["sku_id", "zone"], CFG.last_full_week)
        return lookup(grid, self.products.select("sku_id", "base_product"), "sku_id")

    @cached_property
    def both_levels(self) -> DataFrame:
        return rollup_series(self.grid, "base_product")

    @cached_property
    def raw_forecasts(self) -> DataFrame:
        return checkpoint_table(raw_forecasts(self.both_levels, CFG), "raw_forecasts")

    @cached_property
    def candidates(self) -> DataFrame:
        return checkpoint_table(candidate_table(self.raw_forecasts, self.grid, self.products, CFG), "candidates")

    @cached_property
    def plan(self):
        return plan_from_candidates(self.candidates, self.products, CFG)

    @cached_property
    def baseline(self) -> DataFrame:
        """Second baseline of the relational checks: the recent mean of every series."""
        return self.raw_forecasts.where("kind = 'forecast' AND level = 'sku'").select(
            F.col("series_key").alias("sku_id"), "zone", "week_start", F.round("recent_mean", 1).alias("forecast_units"))

    def share_sold(self) -> None:
        """Write the fact as planning reads it, delivered lines only: the weekly series and the shares both start from it."""
        self.__dict__["fact"] = self.fact.where(DELIVERED)
        self.share(fact=PLANNING_FACT)

    @cached_property
    def reorder(self) -> DataFrame:
        self.share_sold()
        self.share("inventory", pos=PLANNING_POS)
        return reorder_plan(self.plan.forecast, self.fact, self.inventory, self.pos, self.products, self.warehouses,
                            CFG, FIRST_FORECAST_WEEK, latest_stock=True)

    @cached_property
    def decisions(self) -> DataFrame:
        """Two decisions for every item with an open purchase order, so the later one must win."""
        items = self.pos.where("received_date IS NULL").select("warehouse_id", "sku_id").distinct()
        rows = F.array(*[F.struct(F.lit(a).alias("decision"), F.lit(b).cast("double").alias("override_units"),
                                  F.lit(c).cast("timestamp").alias("decided_at")) for a, b, c in DECISIONS])
        return items.select("*", F.inline(rows))
