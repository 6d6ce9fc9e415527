"""The smoothing baseline as a table-valued function that SQL can call.

    SELECT * FROM smooth_forecast(TABLE(weekly) PARTITION BY (series_key, zone) ORDER BY week_start, horizon => 12, width => 0.9)

Partitions of the call are the series. Columns of the table other than the week and the value name a series; they are passed on.
Arguments are checked while the query is analysed, so a wrong call fails before any data is read.
"""

from __future__ import annotations

import datetime as dt
from statistics import NormalDist

from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.functions import udtf
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult

from lakeplan.forecast.models import band_rows, smoothing_forecast

WEEK, VALUE = "week_start", "units"
OUTPUT = T.StructType([T.StructField("week_start", T.DateType()), *(
    T.StructField(c, T.DoubleType()) for c in ("forecast_units", "forecast_lower", "forecast_upper"))])
WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
NUMBER = (*WHOLE, T.FloatType, T.DoubleType, T.DecimalType)


def keys_of(schema: T.StructType) -> list[T.StructField]:
    return [f for f in schema.fields if f.name not in (WEEK, VALUE)]


def check_table(series: AnalyzeArgument) -> None:
    if not series.isTable:
        raise ValueError("smooth_forecast: the first argument must be TABLE(...)")
    kinds = {f.name: f.dataType for f in series.dataType.fields}
    if not isinstance(kinds.get(WEEK), T.DateType):
        raise ValueError(f"smooth_forecast: the table needs a DATE column {WEEK}")
    if not isinstance(kinds.get(VALUE), NUMBER):
        raise ValueError(f"smooth_forecast: the table needs a numeric column {VALUE}")
    if taken := {f.name for f in keys_of(series.dataType)} & {f.name for f in OUTPUT.fields}:
        raise ValueError(f"smooth_forecast: columns {sorted(taken)} of the table are names of the result")


def check_constant(name: str, argument: AnalyzeArgument, kinds: tuple, good) -> None:
    if argument.isTable or not isinstance(argument.dataType, kinds) or not argument.isConstantExpression or argument.value is None:
        raise ValueError(f"smooth_forecast: {name} must be a constant number")
    if not good(argument.value):
        raise ValueError(f"smooth_forecast: {name} = {argument.value} is out of range")


class SmoothForecast:
    """One instance per partition: weeks come in, the horizon goes out at the end."""

    @staticmethod
    def analyze(series: AnalyzeArgument, horizon: AnalyzeArgument, width: AnalyzeArgument) -> AnalyzeResult:
        check_table(series)
        check_constant("horizon", horizon, WHOLE, lambda h: 1 <= h <= 520)
        check_constant("width", width, NUMBER, lambda w: 0 < w < 1)
        return AnalyzeResult(schema=T.StructType([*keys_of(series.dataType), *OUTPUT.fields]))

    def __init__(self):
        self.key, self.weeks, self.horizon, self.width = None, {}, 0, 0.0

    def eval(self, series, horizon, width):
        """A week that comes twice counts by its sum; rows without a week or value say nothing."""
        row = series.asDict()
        if self.key is None:
            self.key = tuple(v for c, v in row.items() if c not in (WEEK, VALUE))
            self.horizon, self.width = horizon, float(width)
        if row[WEEK] is not None and row[VALUE] is not None:
            self.weeks[row[WEEK]] = self.weeks.get(row[WEEK], 0.0) + float(row[VALUE])

    def terminate(self):
        if self.weeks:
            import numpy as np

            days = sorted(self.weeks)
            z = NormalDist().inv_cdf(0.5 + self.width / 2)
            bands = smoothing_forecast(np.array([self.weeks[d] for d in days]), self.horizon, z)
            for i, values in enumerate(zip(*band_rows(*bands), strict=True), 1):
                yield (*self.key, days[-1] + dt.timedelta(weeks=i), *map(float, values))


def register(spark: SparkSession, name: str = "smooth_forecast") -> str:
    """Make the function known to SQL under ``name``."""
    spark.udtf.register(name, udtf(SmoothForecast))
    return name
