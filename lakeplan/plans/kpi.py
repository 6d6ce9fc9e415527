"""The three governed KPI views."""

from __future__ import annotations

from pyspark.sql import DataFrame

from lakeplan.operators.metrics import Field, MetricView, ViewJoin


# Fixed values in the three views below: the names and synonyms that users of the KPI views ask by.
def sales_metrics(daily: DataFrame, dim_date: DataFrame, dim_product: DataFrame) -> MetricView:
    return MetricView(
        comment="Sales: net revenue excludes tax, delivered orders only; day x SKU x zone x channel.",
        source=daily,
        joins={
            "dim_date": ViewJoin(dim_date, "source.order_date = dim_date.date"),
            "dim_product": ViewJoin(dim_product, "source.sku_id = dim_product.sku_id"),
        },
        dims=[
            Field("order_date", "source.order_date"),
            Field("week_start", "dim_date.week_start"),
            Field("month", "dim_date.month_start"),
            Field("fiscal_year", "dim_date.fiscal_year", "April to March, e.g. FY25-26", ("fy", "financial_year")),
            Field("fiscal_quarter", "dim_date.fiscal_quarter"),
            Field("season", "dim_date.season"),
            Field("event", "dim_date.event_name"),
            Field("zone", "source.zone", synonyms=("region",)),
            Field("channel", "source.channel_name"),
            Field("channel_group", "source.channel_group", "Offline, Online or B2B"),
            Field("category", "source.category"),
            Field("base_product", "source.base_product", synonyms=("product_family",)),
            Field("sku", "source.sku_id"),
            Field("product_name", "dim_product.product_name"),
            Field("pack_band", "dim_product.pack_band"),
            Field("is_organic", "dim_product.is_organic"),
        ],
        measures=[
            Field("net_revenue", "sum(source.net_revenue)", "after channel margin and discount",
                  ("revenue", "sales", "turnover")),
            Field("net_revenue_cr", "sum(source.net_revenue) / 1e7", "in units of ten million"),
            Field("gross_margin", "sum(source.gross_margin)", synonyms=("gross_profit", "gm")),
            Field("gross_margin_pct", "sum(source.gross_margin) / nullif(sum(source.net_revenue), 0)",
                  "as a fraction of net revenue"),
            Field("cogs", "sum(source.cogs)"),
            Field("units", "sum(source.units)", synonyms=("packs", "quantity")),
            Field("volume_kg", "sum(source.volume_kg)", synonyms=("tonnage", "kg")),
            Field("discount", "sum(source.discount_amount)"),
            Field("discount_rate", "sum(source.discount_amount) / "
                                   "nullif(sum(source.net_revenue) + sum(source.discount_amount), 0)"),
            Field("promo_revenue_share", "sum(source.promo_revenue) / nullif(sum(source.net_revenue), 0)"),
            Field("return_rate", "sum(source.returned_lines) / nullif(sum(source.lines), 0)",
                  "share of lines that were returned"),
            Field("order_lines", "sum(source.lines)"),
        ],
    )


def order_metrics(orders: DataFrame, dim_date: DataFrame, dim_channel: DataFrame) -> MetricView:
    return MetricView(
        comment="Orders: basket size, order value, active customers; delivered orders only.",
        source=orders,
        where="order_status = 'Delivered'",
        joins={
            "dim_date": ViewJoin(dim_date, "source.order_date = dim_date.date"),
            "dim_channel": ViewJoin(dim_channel, "source.channel_code = dim_channel.channel_code"),
        },
        dims=[
            Field("order_date", "source.order_date"),
            Field("month", "dim_date.month_start"),
            Field("fiscal_year", "dim_date.fiscal_year"),
            Field("zone", "source.zone"),
            Field("state", "source.state"),
            Field("city", "source.city"),
            Field("channel", "dim_channel.channel_name"),
            Field("channel_group", "dim_channel.channel_group"),
            Field("payment_mode", "source.payment_mode"),
            Field("used_promo", "source.used_promo"),
        ],
        measures=[
            Field("orders", "count(1)"),
            Field("net_revenue", "sum(source.net_revenue)"),
            Field("average_order_value", "round(sum(source.net_revenue), 2) / count(1)", synonyms=("aov", "basket_value")),
            Field("lines_per_order", "avg(source.line_count)"),
            Field("active_customers", "count(DISTINCT source.customer_id)", "distinct identified consumers"),
        ],
    )


def inventory_metrics(inv: DataFrame, dim_product: DataFrame, dim_warehouse: DataFrame) -> MetricView:
    return MetricView(
        comment="Warehouse service level: fill rate and stockouts.",
        source=inv,
        joins={
            "dim_product": ViewJoin(dim_product, "source.sku_id = dim_product.sku_id"),
            "dim_warehouse": ViewJoin(dim_warehouse, "source.warehouse_id = dim_warehouse.warehouse_id"),
        },
        dims=[
            Field("snapshot_date", "source.snapshot_date"),
            Field("month", "cast(trunc(source.snapshot_date, 'month') AS date)"),
            Field("warehouse", "dim_warehouse.warehouse_name"),
            Field("warehouse_zone", "dim_warehouse.zone"),
            Field("base_product", "dim_product.base_product"),
            Field("category", "dim_product.category"),
            Field("sku", "source.sku_id"),
        ],
        measures=[
            Field("demand_units", "sum(source.demand_units)"),
            Field("shipped_units", "sum(source.shipped_units)"),
            Field("fill_rate", "sum(source.shipped_units) / nullif(sum(source.demand_units), 0)",
                  synonyms=("service_level",)),
            Field("stockout_days", "count(1) FILTER (WHERE source.is_stockout)"),
            Field("stockout_rate", "count(1) FILTER (WHERE source.is_stockout) / count(1)"),
            Field("unfulfilled_units", "sum(source.unfulfilled_units)"),
        ],
    )
