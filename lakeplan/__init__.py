"""Retail lakehouse and demand-planning operators on plain Apache Spark."""

__version__ = "0.1.0"
