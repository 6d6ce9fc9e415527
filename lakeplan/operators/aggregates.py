"""Gold aggregates.  All exclude cancelled orders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeplan.functions.columns import mean, month_start, ratio, week_start
from lakeplan.operators.joins import lookup

DELIVERED = "order_status = 'Delivered'"
#: Columns of the fact that the daily aggregate reads.
DAILY_INPUT = ["order_id", "order_date", "order_status", "sku_id", "category", "base_product", "zone", "channel_code", "promo_code",
               "quantity", "volume_kg", "gross_amount", "net_revenue", "discount_amount", "cogs", "gross_margin", "tax_amount", "is_returned"]


def total(c: str, digits: int = 2):
    return F.round(F.sum(c), digits).alias(c)


def sales_daily(fact: DataFrame, channels: DataFrame) -> DataFrame:
    """Day x SKU x zone x channel.  ``orders`` is a distinct count and must not be summed further."""
    keys = ["order_date", "sku_id", "category", "base_product", "zone", "channel_code"]
    cube = (
        fact.where(DELIVERED).groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("lines"),
            F.countDistinct("order_id").alias("orders"),
            F.sum("quantity").alias("units"),
            total("volume_kg"), total("gross_amount"), total("net_revenue"), total("discount_amount"),
            total("cogs"), total("gross_margin"), total("tax_amount"),
            F.round(F.sum(F.when(F.col("promo_code").isNotNull(), F.col("net_revenue")).otherwise(0.0)), 2)
            .alias("promo_revenue"),
            F.sum(F.col("is_returned").cast("long")).alias("returned_lines"),
        )
    )
    return lookup(cube, channels.select("channel_code", "channel_name", "channel_group"), "channel_code")


def sales_monthly(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    dated = lookup(fact.where(DELIVERED), dim_date.select(F.col("date").alias("order_date"), "fiscal_year"),
                   "order_date")
    return (
        dated.groupBy(month_start("order_date").alias("month"), "fiscal_year", "category", "zone", "state",
                      "channel_code")
        .agg(F.countDistinct("order_id").alias("orders"), F.sum("quantity").alias("units"), total("volume_kg"),
             total("net_revenue"), total("gross_margin"), total("discount_amount"))
    )


def sales_weekly(daily: DataFrame) -> DataFrame:
    """Monday week x SKU x zone: the training input of the forecast."""
    return (
        daily.groupBy(week_start("order_date").alias("week_start"), "sku_id", "zone")
        .agg(F.sum("units").alias("units"), total("net_revenue"),
             F.round(F.sum("promo_revenue"), 2).alias("_promo"))
        .withColumn("promo_share", F.round(ratio("_promo", "net_revenue"), 4))
        .drop("_promo")
    )


def margin_monthly(fact: DataFrame, materials: DataFrame) -> DataFrame:
    """Margin by month and base product beside the raw-material index of that month.

    Lines are summed first; the index joins the few month x product rows.
    """
    sums = (
        fact.where(DELIVERED)
        .groupBy(month_start("order_date").alias("month"), "base_code", "base_product", "category")
        .agg(total("net_revenue"), total("gross_margin"))
    )
    index = materials.select("base_code", "month", F.col("price_index").alias("raw_material_index"),
                             F.col("price_per_kg").alias("raw_material_price_per_kg"))
    return (
        sums.join(index, ["base_code", "month"], "left")
        .withColumn("gross_margin_pct", F.round(100 * ratio("gross_margin", "net_revenue"), 2))
    )


def pivot(df: DataFrame, rows: list[str], column: str, values: list, measure) -> DataFrame:
    """Crosstab with a declared column list, so no extra pass collects the values."""
    return df.groupBy(*rows).pivot(column, values).agg(measure)


def by_period(df: DataFrame, day: str, period: str, keys: list[str], **measures) -> DataFrame:
    """Re-bucket dated measures to ``month`` or ``week``."""
    bucket = {"month": month_start, "week": week_start}[period](day).alias("period")
    return df.groupBy(bucket, *keys).agg(*[m.alias(n) for n, m in measures.items()])


def weighted_mean(value: str, weight: str):
    return F.sum(F.col(value) * F.col(weight)) / F.nullif(F.sum(weight).cast("double"), F.lit(0.0))


def layer_counts(layers: list[tuple[str, DataFrame]]) -> DataFrame:
    """Row counts per named layer, one aggregate each."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("layer"), F.lit(i).alias("ord"), "rows")
        for i, (name, df) in enumerate(layers, 1)
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def supplier_score(pos: DataFrame, keys: list[str]) -> DataFrame:
    return pos.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("pos"), total("po_value"),
        F.round(mean("fill_rate", 3), 6).alias("avg_fill_rate"),
        F.round(F.avg("delay_days"), 6).alias("avg_delay_days"))
