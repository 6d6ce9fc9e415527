"""Typed projection and reference-data cleaning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeplan.functions.columns import standardise


def conform(df: DataFrame, types: dict[str, str], keep: list[str] | None = None) -> DataFrame:
    """Project to the named columns, each cast to its type.

    ``try_cast`` turns a bad value into NULL, which the expectations then catch,
    instead of ending the job.
    """
    cols: list[Column] = [F.col(c).try_cast(t).alias(c) for c, t in types.items()]
    return df.select(*cols, *(keep or []))


RAW = "_raw"


def with_raw(df: DataFrame) -> DataFrame:
    """Carry each row as it came, for the quarantine."""
    return df.withColumn(RAW, F.struct(*df.columns))


def standardise_column(df: DataFrame, column: str, mapping: dict[str, str], flag: str) -> DataFrame:
    """Replace known misspellings and flag every value that changed, whitespace included."""
    clean = standardise(column, mapping)
    return df.withColumns({flag: F.col(column) != clean, column: clean})


def arrived_late(batch: str = "batch", day: str = "order_date") -> Column:
    """A row is late when its landing batch is not the month of its own date."""
    return F.col(batch) != F.date_format(F.col(day), "yyyy-MM")
