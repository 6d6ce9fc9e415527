"""Quality summary, gate and alerts.  Checks are rows of a status table; only ``enforce`` raises."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeplan.functions.columns import ratio
from lakeplan.operators.joins import orphans

ACCEPTED = "%accepted%"
CHECK_COLUMNS = ["check_name", "value", "limit_value", "breached"]


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def reason_counts(source: str, rejected: DataFrame) -> DataFrame:
    return rejected.groupBy("dq_reason").agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit(source).alias("source_table"), "dq_reason", "rows")


def flag_count(source: str, reason: str, df: DataFrame, flag: Column | str) -> DataFrame:
    """Rows accepted with a flag; present in the summary also when there are none."""
    return df.where(flag).agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit(source).alias("source_table"), F.lit(reason).alias("dq_reason"), "rows")


def dq_summary(rejects: list[tuple[str, DataFrame]], flagged: list[tuple[str, str, DataFrame, Column | str]]) -> DataFrame:
    return union_all([reason_counts(s, df) for s, df in rejects] + [flag_count(*f) for f in flagged])


def outcome(reason: str = "dq_reason") -> Column:
    return F.when(F.col(reason).like(ACCEPTED), "Accepted (flagged)").otherwise("Rejected (quarantined)")


def check_row(name: str, measured: DataFrame, value: Column, limit: float, above: bool = True) -> DataFrame:
    """One status row from a one-row frame."""
    v = value.cast("double")
    bad = v > limit if above else v < limit
    return measured.select(F.lit(name).alias("check_name"), F.round(v, 6).alias("value"),
                           F.lit(float(limit)).alias("limit_value"), F.coalesce(bad, F.lit(True)).alias("breached"))


def reject_rate(summary: DataFrame, raw: DataFrame, source: str = "sales_lines") -> DataFrame:
    """One row: rejected and raw row counts and their ratio."""
    bad = summary.where(F.col("source_table") == source).where(~F.col("dq_reason").like(ACCEPTED))
    tagged = (
        bad.agg(F.sum("rows").alias("rejected")).withColumn("raw", F.lit(None).cast("long"))
        .unionByName(raw.agg(F.count(F.lit(1)).alias("raw")).withColumn("rejected", F.lit(None).cast("long")))
    )
    return tagged.agg(F.coalesce(F.sum("rejected"), F.lit(0)).alias("rejected"), F.sum("raw").alias("raw")).withColumn(
        "reject_rate", ratio("rejected", "raw"))


def orphan_count(fact: DataFrame, dims: list[tuple[DataFrame, str]]) -> DataFrame:
    """One row: fact rows whose key is missing, summed over the given dimensions."""
    parts = [orphans(fact, dim, key).select("rows") for dim, key in dims]
    return union_all(parts).agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("orphans"))


def reconcile(gold: DataFrame, kpi: DataFrame, column: str = "net_revenue", kpi_column: str = "net_revenue") -> DataFrame:
    """One row: gold total, KPI total and their relative gap."""
    both = gold.agg(F.sum(column).alias("gold"), F.lit(None).cast("double").alias("kpi")).unionByName(
        kpi.agg(F.lit(None).cast("double").alias("gold"), F.sum(kpi_column).alias("kpi")))
    return both.agg(F.round(F.sum("gold"), 2).alias("gold"), F.round(F.sum("kpi"), 2).alias("kpi")).withColumn(
        "gap", ratio(F.abs(F.col("gold") - F.col("kpi")), "gold"))


def days_behind(df: DataFrame, day: str, target: str) -> DataFrame:
    """One row: latest date and how many days it lies before the target."""
    return df.agg(F.max(day).alias("latest")).withColumn(
        "days_behind", F.greatest(F.lit(0), F.date_diff(F.lit(target).cast("date"), F.col("latest"))))


def horizon_weeks(forecast: DataFrame, week: str = "week_start") -> DataFrame:
    return forecast.agg(F.countDistinct(week).alias("weeks"))


def gate(summary: DataFrame, raw: DataFrame, fact: DataFrame, products: DataFrame, stores: DataFrame,
         gold: DataFrame, kpi: DataFrame, forecast: DataFrame, as_of: str, reject_limit: float = 0.01,
         reconcile_limit: float = 0.0001, weeks: int = 12) -> DataFrame:
    """The five end-of-run checks."""
    return union_all([
        check_row("reject_rate", reject_rate(summary, raw), F.col("reject_rate"), reject_limit),
        check_row("orphans", orphan_count(fact, [(products, "sku_id"), (stores, "store_id")]), F.col("orphans"), 0),
        check_row("reconcile", reconcile(gold, kpi), F.col("gap"), reconcile_limit),
        check_row("freshness", days_behind(gold, "order_date", as_of), F.col("days_behind"), 0),
        check_row("horizon", horizon_weeks(forecast), F.col("weeks"), weeks, above=False),
    ])


def enforce(status: DataFrame) -> DataFrame:
    """Pass the status table through; the first breached row ends the job when it is read."""
    message = F.concat(F.lit("quality gate: "), F.col("check_name"), F.lit(" = "), F.col("value").cast("string"))
    verdict = F.when(F.col("breached"), F.raise_error(message).cast("string")).otherwise(F.lit("ok"))
    return status.withColumn("verdict", verdict)


def alerts(recommendations: DataFrame, backtest: DataFrame, summary: DataFrame, raw: DataFrame,
           max_high: int = 100, max_wape: float = 0.30, max_reject: float = 0.01) -> DataFrame:
    """The three threshold alerts as status rows."""
    high = recommendations.agg(F.sum((F.col("stockout_risk") == "High").cast("long")).alias("n"))
    wape = backtest.agg(
        ratio(F.round(F.sum(F.abs(F.col("actual") - F.col("forecast_units"))), 6), F.sum("actual")).alias("wape"))
    return union_all([
        check_row("high_risk_items", high, F.coalesce(F.col("n"), F.lit(0)), max_high),
        check_row("forecast_wape", wape, F.col("wape"), max_wape),
        check_row("reject_rate", reject_rate(summary, raw), F.col("reject_rate"), max_reject),
    ])
