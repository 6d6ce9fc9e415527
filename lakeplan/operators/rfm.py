"""Recency, frequency and monetary scores."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeplan.functions.columns import band
from lakeplan.operators.windows import global_ntile
from lakeplan.session import checkpoint_table


def rfm_totals(orders: DataFrame, as_of: str) -> DataFrame:
    """Per identified customer, delivered orders only."""
    return (
        orders.where("customer_id IS NOT NULL AND order_status = 'Delivered'")
        .groupBy("customer_id")
        .agg(F.max("order_date").alias("last_order"), F.min("order_date").alias("first_order"),
             F.count(F.lit(1)).alias("frequency"), F.round(F.sum("net_revenue"), 2).alias("monetary"))
        .withColumn("recency_days", F.date_diff(F.lit(as_of).cast("date"), F.col("last_order")))
    )


def rfm_segment():
    # The segments and their bounds.
    r, f = F.col("r_score"), F.col("f_score")
    return band([
        ((r >= 4) & (f >= 4), "Champions"),
        ((r >= 3) & (f >= 3), "Loyal"),
        ((r >= 4) & (f <= 2), "New / Promising"),
        ((r <= 2) & (f >= 3), "At Risk"),
        ((r <= 2) & (f <= 2), "Hibernating"),
    ], "Needs Attention")


def rfm_scores(totals: DataFrame, key: str = "customer_id", tiles: int = 5) -> DataFrame:
    """Quintiles over the whole table (5 is best); ties are broken by the customer key."""
    tie = F.col(key)
    totals = checkpoint_table(totals, "rfm_totals")  # read once per score and once for the rows
    scored = global_ntile(totals, tiles, [-F.col("recency_days"), tie], "r_score")
    scored = global_ntile(scored, tiles, [F.col("frequency"), tie], "f_score")
    scored = global_ntile(scored, tiles, [F.col("monetary"), tie], "m_score")
    return scored.withColumn("rfm_segment", rfm_segment())


def customer_rfm(orders: DataFrame, customers: DataFrame, as_of: str, attributes: list[str]) -> DataFrame:
    return rfm_scores(rfm_totals(orders, as_of)).join(
        customers.select("customer_id", *attributes), "customer_id", "left")
