"""Sinks.  Every write is distributed; nothing passes through the driver."""

from __future__ import annotations

import re
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def write_partitioned(df: DataFrame, path: str, partition: str, mode: str = "overwrite") -> None:
    """Parquet partitioned by one column.

    The rebalance hint brings a value's rows together but lets adaptive execution split a
    heavy value over several tasks and merge light ones, by size.
    """
    df.hint("rebalance", partition).write.mode(mode).partitionBy(partition).parquet(path)


def write_files(df: DataFrame, path: str, n: int, mode: str = "overwrite") -> None:
    """Parquet in exactly ``n`` files (given at least ``n`` rows)."""
    df.repartition(n).write.mode(mode).parquet(path)


def export(df: DataFrame, path: str, fmt: str, mode: str = "overwrite") -> None:
    """CSV with header or JSON lines."""
    writer = df.write.mode(mode)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)


def write_clustered(df: DataFrame, path: str, cols: list[str], n: int | None = None, mode: str = "overwrite") -> None:
    """Range-cluster on the columns readers filter by, so row-group statistics skip files."""
    ranged = df.repartitionByRange(n, *cols) if n else df.repartitionByRange(*cols)
    ranged.sortWithinPartitions(*cols).write.mode(mode).parquet(path)


def save_table(df: DataFrame, name: str, comment: str | None = None) -> None:
    """Replace a managed table including its schema."""
    writer = df.write.mode("overwrite").option("overwriteSchema", True)
    writer.saveAsTable(name)
    if comment:
        df.sparkSession.sql(f"COMMENT ON TABLE {name} IS {quoted(comment)}")


def quoted(text: str) -> str:
    """A string literal of SQL."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def table_location(spark: SparkSession, name: str) -> str | None:
    """Folder of a catalog table, None if there is no such table."""
    if not spark.catalog.tableExists(name):
        return None
    return spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").first().data_type


def register_table(spark: SparkSession, name: str, path: str, comment: str | None = None, partitioned: bool = False) -> None:
    """Make the files of a folder, just written, a catalog table; the folder stays their owner.

    A table of that name over another folder or with other columns gives way; otherwise only its file list, and the list
    of partitions where it has any, is brought up to date. No row is read or moved.
    """
    fs, where = hadoop_path(spark, path)
    at, columns = fs.makeQualified(where).toString(), spark.read.parquet(path).schema
    known = table_location(spark, name)
    if known is not None and (known != at or described(spark.table(name).schema) != described(columns)):
        spark.sql(f"DROP TABLE {name}")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING parquet LOCATION {quoted(at)}")
    if partitioned:
        spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")
    spark.catalog.refreshTable(name)
    if comment:
        spark.sql(f"COMMENT ON TABLE {name} IS {quoted(comment)}")


def described(schema: StructType) -> dict[str, str]:
    return {f.name: f.dataType.simpleString() for f in schema}


def append_rows(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


APPEND_ID = "append_id"


def append_once(df: DataFrame, path: str, key: str) -> bool:
    """Append rows under an idempotency key; a key that is there already adds nothing. Says whether rows were added.

    The rows are written aside and published by a single rename that fails if its target exists, so of several writers with one
    key one wins, and readers see all of its rows or none. On a store without atomic rename writers of one key must take turns.
    """
    if not re.fullmatch(r"[A-Za-z0-9_.-]{1,200}", key) or key.startswith((".", "_")):
        raise ValueError(f"not a key: {key!r}")
    spark = df.sparkSession
    fs, target = hadoop_path(spark, f"{path}/{APPEND_ID}={key}")
    if fs.exists(target):
        return False
    aside = f"{path}/_appends/{uuid.uuid4().hex}"
    df.write.parquet(aside)
    hadoop = spark._jvm.org.apache.hadoop.fs
    options = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
    source = fs.makeQualified(hadoop.Path(aside))
    try:
        hadoop.FileContext.getFileContext(source.toUri(), spark._jsc.hadoopConfiguration()).rename(source, fs.makeQualified(target), options)
        return True
    except Py4JJavaError as e:
        if "FileAlreadyExists" not in str(e.java_exception):
            raise
        fs.delete(source, True)
        return False


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) as Hadoop knows them."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def folder_exists(spark: SparkSession, path: str) -> bool:
    """Whether a folder has anything in it besides markers and checkpoints; asks the file system only."""
    fs, where = hadoop_path(spark, path)
    if not fs.exists(where):
        return False
    names = fs.listStatusIterator(where)
    while names.hasNext():
        if not names.next().getPath().getName().startswith(("_", ".")):
            return True
    return False


def remove_folder(spark: SparkSession, path: str) -> None:
    fs, where = hadoop_path(spark, path)
    fs.delete(where, True)
