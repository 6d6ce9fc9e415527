"""Registered queries: one Spark function and, where SQL can say the same, one DuckDB check each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lakeplan.plans.oracle import with_layers
from lakeplan.plans.stand_in import StandIn

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, extra: dict[str, str] | None = None):
    """Register ``fn(stand_in)`` under an inventory key together with its SQL."""
    def register(fn: Callable[[StandIn], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")
        QUERIES[name] = lambda spark, sf_dir: fn(StandIn(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = with_layers(sql, extra)
        return fn
    return register


def load() -> None:
    from lakeplan.plans.catalogue import (  # noqa: F401
        aggregates, calendars, cleaning, forecasts, functions, joins, kpis, planning, reports, sources, windows,
    )
