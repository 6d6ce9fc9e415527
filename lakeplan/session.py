"""Session helpers: shared scratch folder, lineage cuts and size-checked broadcasts."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Of compressed files. Rows take about ten times as much in memory, and the driver holds them more than once while it builds a broadcast.
BROADCAST_LIMIT_BYTES = 8 * 1024 * 1024
BROADCAST_LIMIT_ROWS = 1_000_000

_written: list[str] = []


@cache
def local_dir(application: str) -> str:
    """One private folder per application, for local sessions that name no shared one; gone when Python ends."""
    path = tempfile.mkdtemp(prefix="lakeplan-")
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    return path


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, taken from ``spark.checkpoint.dir``.

    Only a local session may do without one: elsewhere executors would write to disks of their own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError(f"set spark.checkpoint.dir to a folder that all executors of {master} share")
    return local_dir(spark.sparkContext.applicationId)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path under the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/lakeplan/{label}-{uuid.uuid4().hex}"


def checkpoint_table(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write a frame to the shared folder and read it back, cutting its lineage.

    Used where two passes must see the very same rows and where a stage is read
    several times; the files outlive any executor.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    _written.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def stages(spark: SparkSession) -> Iterator[None]:
    """Remove the stages written inside the block when it ends; their frames must not be read afterwards."""
    before = len(_written)
    try:
        yield
    finally:
        conf = spark._jsc.hadoopConfiguration()
        for path in _written[before:]:
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(conf).delete(where, True)
        del _written[before:]


def planned_bytes(df: DataFrame) -> int:
    """Size estimate of the optimised plan: compressed bytes of files, and no allowance for exploded rows."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def multiplies_rows(df: DataFrame) -> bool:
    """Whether the plan makes several rows of one, which its size estimate does not see."""
    return any(word in df._jdf.queryExecution().analyzed().toString() for word in ("Generate ", "Expand "))


def is_small(df: DataFrame, limit: int = BROADCAST_LIMIT_BYTES) -> bool:
    """Whether the planner's own size estimate holds and is below ``limit``."""
    return not multiplies_rows(df) and planned_bytes(df) <= limit


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """Hint a broadcast only when the planner's own size estimate holds and is below ``limit``.

    Otherwise the frame is returned unhinted: the join then shuffles, adaptive
    execution splits skewed partitions, and it may still broadcast by measured size.
    """
    return F.broadcast(df) if is_small(df, limit) else df


def measured(df: DataFrame, label: str, limit: int = BROADCAST_LIMIT_ROWS) -> DataFrame:
    """Write a side that should be tiny, count it, and hint a broadcast only if it is.

    For aggregates and exploded windows: their planned size is that of their input, and a join on
    their few keys would shuffle the other side to a few tasks.
    """
    table = checkpoint_table(df, label)
    return F.broadcast(table) if table.count() <= limit else table


def null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on equal keys where NULL equals NULL; the right side's keys are dropped."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    condition = F.lit(True)
    for k in keys:
        condition = condition & F.col(k).eqNullSafe(F.col(f"_r_{k}"))
    return left.join(renamed, condition, how).drop(*[f"_r_{k}" for k in keys])
