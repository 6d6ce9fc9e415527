"""Batch sources: snapshots, tables, literal rows, and lineage columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def with_lineage(df: DataFrame) -> DataFrame:
    """Add the source file path and the ingest time; works on batch and stream file sources."""
    return df.select(
        "*",
        F.col("_metadata.file_path").alias("_source_file"),
        F.current_timestamp().alias("_ingest_ts"),
    )


def read_snapshot(spark: SparkSession, path: str, fmt: str, schema: StructType | str,
                  lineage: bool = True) -> DataFrame:
    """Read a whole snapshot folder (``csv`` with header, ``json`` lines or ``parquet``)."""
    reader = spark.read.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True).option("enforceSchema", False)
    df = reader.format(fmt).load(path)
    return with_lineage(df) if lineage else df


def read_table(spark: SparkSession, name: str, root: str | None = None) -> DataFrame:
    """A table by name: a Parquet folder below ``root``, or the session catalogue."""
    return spark.read.parquet(f"{root.rstrip('/')}/{name}") if root else spark.table(name)


def inline_table(spark: SparkSession, rows: Sequence[tuple], ddl: str) -> DataFrame:
    """Literal rows as a table.  The rows live in the plan, so this is for short fixed lists."""
    return spark.createDataFrame(list(rows), ddl)
