"""Date spines and the calendar dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeplan.functions.columns import (
    band, date_key, fiscal_quarter_label, fiscal_year_label, in_season, month_start, week_start,
)

# Month groups of the four seasons and the wedding windows (MM-dd, inclusive).
SEASONS = [("Summer", [3, 4, 5]), ("Monsoon", [6, 7, 8, 9]), ("Post-Monsoon", [10, 11])]
OTHER_SEASON = "Winter"
WEDDING_WINDOWS = [("11-15", "02-28"), ("04-15", "05-31")]


def date_spine(spark: SparkSession, start: str, end: str, step_days: int = 1, name: str = "date") -> DataFrame:
    """One row per step from ``start`` to ``end`` inclusive."""
    steps = F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"), F.expr(f"INTERVAL {step_days} DAY"))
    return spark.range(1).select(F.explode(steps).alias(name))


def spine_of(df: DataFrame, first: str, last: str, step: str = "1 DAY", name: str = "date") -> DataFrame:
    """Explode each row's own date range; no join with a calendar is needed."""
    return df.withColumn(name, F.explode(F.sequence(F.col(first), F.col(last), F.expr(f"INTERVAL {step}"))))


def names_per_day(events: DataFrame, name: str = "event_name", day: str = "event_date", sep: str = " / ") -> DataFrame:
    """Distinct event names of a day in one string, in alphabetical order."""
    return (
        events.select(F.col(day).alias("date"), F.col(name).alias("event_name")).distinct()
        .groupBy("date")
        .agg(F.array_join(F.array_sort(F.collect_set("event_name")), sep).alias("event_name"))
    )


def season(d: Column) -> Column:
    return band([(F.month(d).isin(months), label) for label, months in SEASONS], OTHER_SEASON)


def dim_date(spine: DataFrame, events: DataFrame | None = None, fy_start: int = 4,
             actuals_to: str | None = None) -> DataFrame:
    """Calendar dimension over a frame with a ``date`` column."""
    d = F.col("date")
    out = spine.select(
        date_key(d).alias("date_key"),
        d,
        F.date_format(d, "EEEE").alias("day_name"),
        F.dayofweek(d).alias("day_of_week"),
        F.dayofweek(d).isin(1, 7).alias("is_weekend"),
        week_start(d).alias("week_start"),
        F.weekofyear(d).alias("iso_week"),
        F.month(d).alias("month"),
        F.date_format(d, "MMM").alias("month_name"),
        month_start(d).alias("month_start"),
        F.quarter(d).alias("calendar_quarter"),
        F.year(d).alias("calendar_year"),
        fiscal_year_label(d, fy_start).alias("fiscal_year"),
        fiscal_quarter_label(d, fy_start).alias("fiscal_quarter"),
        season(d).alias("season"),
        in_season(d, WEDDING_WINDOWS).alias("is_wedding_season"),
        (F.dayofmonth(d) <= 7).alias("is_salary_week"),
        (d <= F.lit(actuals_to).cast("date") if actuals_to else F.lit(True)).alias("is_actuals_period"),
    )
    if events is None:
        return out.withColumns({"is_event_day": F.lit(False), "event_name": F.lit(None).cast("string")})
    return (
        out.join(names_per_day(events), "date", "left")
        .withColumn("is_event_day", F.col("event_name").isNotNull())
    )
