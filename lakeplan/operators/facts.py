"""Dimension and fact builders of the star schema (natural keys throughout)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeplan.functions.columns import date_key, in_band, money
from lakeplan.operators.joins import exists_flag, lookup, monthly_lookup

# The pack bands of the retail model.
PACK_BANDS = [(50, "Small (<=50g)"), (200, "Medium (100-200g)")]
PACK_BAND_REST = "Bulk (500g-1kg)"


def dec(c: str, precision: int, scale: int) -> Column:
    return F.col(c).cast(f"decimal({precision},{scale})")


def dim_product(products: DataFrame) -> DataFrame:
    return products.withColumn("pack_band", in_band("pack_size", PACK_BANDS, PACK_BAND_REST))


def dim_price_history(prices: DataFrame) -> DataFrame:
    return prices.select("sku_id", F.col("effective_from").alias("valid_from"),
                         F.col("effective_to").alias("valid_to"), "mrp",
                         F.col("effective_to").isNull().alias("is_current"))


def dim_store(stores: DataFrame, channels: DataFrame) -> DataFrame:
    return lookup(stores, channels.select("channel_code", "channel_name"), "channel_code", "left").withColumn(
        "is_active", F.col("closed_date").isNull())


def dim_customer(customers: DataFrame, geography: DataFrame) -> DataFrame:
    return lookup(customers, geography.select("city", "state", "zone", "tier"), ["city", "state"], "left")


def dim_promotion(promotions: DataFrame) -> DataFrame:
    return promotions.withColumn("duration_days", F.date_diff("end_date", "start_date") + 1)


def price_columns(df: DataFrame) -> DataFrame:
    """Money of a line whose price includes tax.

    net = amount / (1 + tax); tax = amount - net; discount = qty x price x discount / (1 + tax);
    cost = qty x unit cost; margin = unrounded net - unrounded cost.  All from exact
    DECIMAL inputs, each rounded once.
    """
    one_plus = F.lit(1).cast("decimal(2,0)") + dec("tax_rate", 5, 4)
    amount, qty = dec("line_amount", 14, 2), dec("quantity", 9, 0)
    price, disc, cost = dec("unit_price", 12, 2), dec("discount_pct", 5, 4), dec("unit_cost", 12, 2)
    net = amount / one_plus
    return df.withColumns({
        "volume_kg": money(qty * dec("pack_size", 9, 0) / F.lit(1000), 3),
        "gross_amount": money(qty * price),
        "net_revenue": money(net),
        "tax_amount": money(amount - net),
        "discount_amount": money(qty * price * disc / one_plus),
        "cogs": money(qty * cost),
        "gross_margin": money(net - qty * cost),
    })


FACT_COLUMNS = [
    "line_id", "order_id", "line_no", "order_date", "order_ts", "date_key", "sku_id", "category", "base_product", "base_code",
    "store_id", "channel_code", "customer_id", "warehouse_id", "zone", "state", "city", "promo_code",
    "order_status", "payment_mode", "quantity", "volume_kg", "unit_mrp", "unit_price", "discount_pct",
    "gross_amount", "line_amount", "net_revenue", "tax_amount", "discount_amount", "cogs", "gross_margin",
    "is_returned",
]


def fact_sales_line(lines: DataFrame, orders: DataFrame, products: DataFrame, stores: DataFrame,
                    costs: DataFrame, returns: DataFrame, by_order: bool = False) -> DataFrame:
    """One row per sold line; cancelled orders stay, lines without a store or product do not.

    The two large joins (order, returned lines) are plain equi-joins for adaptive
    execution to place and split; reference tables are broadcast only when small.
    Stores meet the orders, which are fewer than the lines. ``by_order`` says that returns name the order of their
    line: both joins then go by the order, and the lines are shuffled once at most.
    """
    heads = orders.select("order_id", "order_ts", "store_id", "channel_code", "customer_id", "order_status", "payment_mode")
    items = products.select("sku_id", "category", "base_product", "base_code", "pack_size", "tax_rate")
    places = stores.select("store_id", "warehouse_id", "zone", "state", "city")
    sold = lookup(lines.join(lookup(heads, places, "store_id"), "order_id"), items, "sku_id")
    sold = monthly_lookup(sold, costs.select("sku_id", "month", "unit_cost"), ["sku_id"], "order_date")
    sold = exists_flag(sold, returns, "line_id", "is_returned", "order_id" if by_order else None)
    return price_columns(sold).withColumn("date_key", date_key("order_date")).select(*FACT_COLUMNS)


def orders_from_lines(fact: DataFrame) -> DataFrame:
    """One row per order with basket measures; where its header rows differ, the largest value of each column."""
    header = ["order_ts", "store_id", "channel_code", "customer_id", "zone", "state", "city", "order_status", "payment_mode"]
    return (
        fact.groupBy("order_id", "order_date")
        .agg(
            *[F.max(c).alias(c) for c in header],
            F.count(F.lit(1)).alias("line_count"),
            F.sum("quantity").alias("units"),
            F.round(F.sum("volume_kg"), 3).alias("volume_kg"),
            F.round(F.sum("net_revenue"), 2).alias("net_revenue"),
            F.round(F.sum("gross_margin"), 2).alias("gross_margin"),
            F.max(F.col("promo_code").isNotNull()).alias("used_promo"),
        )
    )


def fact_returns(returns: DataFrame, fact: DataFrame, products: DataFrame) -> DataFrame:
    sold = fact.select("line_id", "order_date", "channel_code", "zone", "warehouse_id")
    joined = returns.join(sold, "line_id")
    joined = lookup(joined, products.select("sku_id", "category", "base_product"), "sku_id")
    return joined.withColumn("days_to_return", F.date_diff("return_date", "order_date"))


def fact_purchase_orders(pos: DataFrame, suppliers: DataFrame, products: DataFrame) -> DataFrame:
    named = lookup(pos, suppliers.select("supplier_id", "supplier_name", "supplier_tier"), "supplier_id", "left")
    named = lookup(named, products.select("sku_id", "base_product", "category"), "sku_id", "left")
    return named.withColumns({
        "actual_lead_days": F.date_diff("received_date", "po_date"),
        "delay_days": F.date_diff("received_date", "expected_date"),
        "fill_rate": money(dec("received_units", 12, 0) / F.nullif(dec("ordered_units", 12, 0), F.lit(0)), 3),
    })
