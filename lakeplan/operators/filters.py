"""Optional report filters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Range:
    """Values from ``low`` to ``high``, both included; ``None`` leaves a side open."""

    low: object = None
    high: object = None


def matches(value: Column, wanted: object) -> Column:
    """A column against one value, any of a list, or a range."""
    if isinstance(wanted, Range):
        bounds = [value >= F.lit(wanted.low)] * (wanted.low is not None) + [value <= F.lit(wanted.high)] * (wanted.high is not None)
        return reduce(and_, bounds, F.lit(True))
    if isinstance(wanted, Sequence) and not isinstance(wanted, str):
        return value.isin(list(wanted))
    return value == wanted


def apply_filters(df: DataFrame, selection: Mapping[str, object]) -> DataFrame:
    """Filter by every given column; ``None`` means no filter, a list any of, a :class:`Range` its bounds."""
    for column, wanted in selection.items():
        if wanted is None:
            continue
        df = df.where(matches(F.col(column), wanted))
    return df
