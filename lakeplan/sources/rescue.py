"""Reads that lose nothing: what a declared schema has no place for is kept beside the row as JSON.

A column that is not declared, and a value that cannot be cast to its declared type, go to ``_rescued``; the other columns are as
declared. Files may differ in their columns and types: they are grouped by what they hold and read group by group.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeplan.sources.readers import with_lineage
from lakeplan.sources.writers import hadoop_path

RESCUED = "_rescued"


def declared_type(schema: T.StructType | str) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def rescued(df: DataFrame, schema: T.StructType | str, kept: Sequence[str] = ()) -> DataFrame:
    """The declared columns, ``kept`` as they are, and the rest as JSON (NULL if there is none)."""
    declared, have = declared_type(schema), {f.name: f.dataType for f in df.schema.fields}
    columns, over = [], []
    for f in declared.fields:
        if f.name not in have:
            columns.append(F.lit(None).cast(f.dataType).alias(f.name))
        elif have[f.name] == f.dataType:
            columns.append(F.col(f"`{f.name}`"))
        else:
            value, cast = F.col(f"`{f.name}`"), F.col(f"`{f.name}`").try_cast(f.dataType)
            columns.append(cast.alias(f.name))
            over.append(F.when(cast.isNull(), value).alias(f.name))
    over += [F.col(f"`{c}`") for c in have if c not in declared.names and c not in kept]
    rest = F.nullif(F.to_json(F.struct(*over)), F.lit("{}")) if over else F.lit(None).cast("string")
    return df.select(*columns, *[F.col(f"`{c}`") for c in kept], rest.alias(RESCUED))


def parquet_groups(spark: SparkSession, paths: Sequence[str]) -> list[tuple[T.StructType, list[str]]]:
    """Files whose columns can be read by one schema; a group that cannot is halved."""
    try:
        return [(spark.read.option("mergeSchema", True).parquet(*paths).schema, list(paths))]
    except (PySparkException, Py4JJavaError) as e:  # inside a micro-batch errors come unconverted
        if len(paths) == 1 or "CANNOT_MERGE" not in str(e):
            raise
        half = len(paths) // 2
        return parquet_groups(spark, paths[:half]) + parquet_groups(spark, paths[half:])


def read_parquet_files(spark: SparkSession, paths: Sequence[str], schema: T.StructType | str) -> DataFrame:
    """Parquet files with lineage, the declared columns and the rest."""
    frames = [rescued(with_lineage(spark.read.schema(found).parquet(*group)), schema, ("_source_file", "_ingest_ts"))
              for found, group in parquet_groups(spark, paths)]
    return reduce(DataFrame.unionByName, frames)


def csv_groups(spark: SparkSession, path: str) -> dict[tuple[str, ...], list[str]]:
    """Files of a snapshot folder by their header."""
    fs, where = hadoop_path(spark, path)
    files = [str(s.getPath()) for s in fs.listStatus(where) if not s.isDirectory() and not s.getPath().getName().startswith(("_", "."))] if fs.exists(where) else []
    groups: dict[tuple[str, ...], list[str]] = {}
    for file in files:
        groups.setdefault(tuple(spark.read.option("header", True).csv(file).columns), []).append(file)
    return groups


def read_snapshot_rescued(spark: SparkSession, path: str, fmt: str, schema: T.StructType | str) -> DataFrame:
    """A CSV (with header) or JSON-lines snapshot with lineage, the declared columns and the rest; all fields are read as text."""
    kept = ("_source_file", "_ingest_ts")
    if fmt == "json":
        raw = spark.read.option("primitivesAsString", True).json(path)
        return rescued(with_lineage(raw), schema, kept)
    frames = []
    for header, files in csv_groups(spark, path).items():
        text = T.StructType([T.StructField(c, T.StringType()) for c in header])
        frames.append(rescued(with_lineage(spark.read.schema(text).option("header", True).option("enforceSchema", False).csv(files)), schema, kept))
    if not frames:
        nothing = spark.createDataFrame([], declared_type(schema)).withColumns({"_source_file": F.lit(""), "_ingest_ts": F.current_timestamp()})
        return rescued(nothing, schema, kept)
    return reduce(DataFrame.unionByName, frames)
