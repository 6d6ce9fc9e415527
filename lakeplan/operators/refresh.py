"""Refresh of a partitioned table by the partitions that a batch touches.

Only the touched partitions are computed and replaced, by dynamic partition overwrite: every task writes its files aside and the
commit moves whole partitions, so a failed refresh leaves the table as it was and a repeated one gives the same rows.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from lakeplan.functions.columns import month_start, week_start
from lakeplan.sources.writers import remove_folder


def next_month(month: dt.date) -> dt.date:
    return (month.replace(day=1) + dt.timedelta(days=32)).replace(day=1)


def touched_months(changed: DataFrame, day: str) -> list[dt.date]:
    """Months of the changed rows; as many as the calendar has at most."""
    found = changed.where(F.col(day).isNotNull()).select(month_start(day).alias("m")).distinct().collect()
    return sorted(r.m for r in found)


def within(day: str, months: list[dt.date] | None) -> Column:
    """Rows of these months as day ranges, one for each run of months, so that file statistics prune; None is all rows."""
    if months is None:
        return F.lit(True)
    spans: list[list[dt.date]] = []
    for m in sorted(set(months)):
        if spans and spans[-1][1] == m:
            spans[-1][1] = next_month(m)
        else:
            spans.append([m, next_month(m)])
    return reduce(lambda a, b: a | b, [(F.col(day) >= F.lit(a)) & (F.col(day) < F.lit(b)) for a, b in spans], F.lit(False))


def week_months(months: list[dt.date] | None) -> list[dt.date] | None:
    """Months of the Mondays of all weeks that have a day in ``months``."""
    if months is None:
        return None
    mondays = [m - dt.timedelta(days=m.weekday()) for m in months]
    return sorted({d.replace(day=1) for d in [*mondays, *months]})


def within_weeks(day: str, months: list[dt.date] | None) -> Column:
    """Rows whose week begins in these months, as day ranges a week longer than the months, then by the week itself."""
    if months is None:
        return F.lit(True)
    longer = sorted({m for month in months for m in (month, next_month(month))})
    return within(day, longer) & month_start(week_start(day)).isin(months)


def replace_partitions(df: DataFrame, path: str, partition: str, touched: list[dt.date] | None, order: list[str]) -> None:
    """Write ``df``, which holds all rows of the touched months and no others, over these partitions of the table.

    None replaces the whole table. A touched month that has no row left keeps no folder: the months written are observed
    while they are written.
    """
    spark = df.sparkSession
    mode = "static" if touched is None else "dynamic"
    if touched:
        seen = Observation()
        df = df.observe(seen, *[F.count(F.when(F.col(partition) == F.lit(m), 1)).alias(m.isoformat()) for m in touched])
    (df.hint("rebalance", partition).sortWithinPartitions(partition, *order).write.mode("overwrite")
     .option("partitionOverwriteMode", mode).partitionBy(partition).parquet(path))
    for month in touched or []:
        if not seen.get[month.isoformat()]:
            remove_folder(spark, f"{path}/{partition}={month.isoformat()}")
