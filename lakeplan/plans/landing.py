"""The driver tables as landing files, so that the end-to-end run can be measured on them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeplan.plans import runner, silver
from lakeplan.plans.stand_in import StandIn


def feeds(s: StandIn) -> dict[str, DataFrame]:
    """A frame for every landing feed; columns that the tables do not have are NULL."""
    prices = s.products.select("sku_id", F.lit("1995-01-01").cast("date").alias("effective_from"), "mrp")
    return {
        "geography": s.geography, "warehouses": s.warehouses, "channels": s.channels.withColumn("partner_margin_pct", F.lit(0.1)),
        "events": s.events.withColumn("lead_days", F.lit(10)), "products": s.products, "product_prices": prices,
        "product_costs": s.costs, "material_prices": s.materials, "suppliers": s.suppliers, "stores": s.raw_stores,
        "promotions": s.promotions, "customers": s.customers,
        "orders": s.raw_orders.withColumn("batch", F.date_format("order_date", "yyyy-MM")), "sales_lines": s.raw_lines,
        "returns": s.raw_returns, "inventory": s.raw_inventory.withColumn("batch", F.date_format("snapshot_date", "yyyy-MM")),
        "purchase_orders": s.raw_pos,
    }


def land(s: StandIn, root: str) -> None:
    """Write all feeds below ``root`` in the formats the runner reads."""
    for name, df in feeds(s).items():
        types = dict(silver.SCHEMAS[name]) | ({"batch": "string"} if "batch" in df.columns else {})
        out = df.select(*[(F.col(c) if c in df.columns else F.lit(None)).cast(t).alias(c) for c, t in types.items()])
        fmt = "csv" if name in runner.CSV_FEEDS else "json" if name in runner.JSON_FEEDS else "parquet"
        writer = out.write.mode("overwrite")
        (writer.option("header", True) if fmt == "csv" else writer).format(fmt).save(f"{root}/{name}")
