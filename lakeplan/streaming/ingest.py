"""Incremental file ingestion with Structured Streaming.

Feeds are triggered (``availableNow``): each run picks up the files that are new since the
last one and stops.  Outputs and checkpoints live in shared storage.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from lakeplan.operators.clean import RAW
from lakeplan.operators.expectations import METRICS, Counted, Rule, accepted, as_received, rejected, tag
from lakeplan.sources.readers import with_lineage
from lakeplan.sources.rescue import read_parquet_files
from lakeplan.sources.writers import append_rows, folder_exists

FILES_PER_BATCH = 10000


def file_stream(spark: SparkSession, path: str, schema: StructType | str, fmt: str = "parquet",
                pattern: str | None = None, files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    """File stream with lineage columns; ``pattern`` narrows the file names.

    A backlog is drained in several micro-batches of at most ``files_per_batch`` files, so a
    first load does not become one batch and a lost driver repeats only the last one.
    """
    reader = spark.readStream.schema(schema).format(fmt).option("maxFilesPerTrigger", files_per_batch)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if fmt == "csv":
        reader = reader.option("header", True)
    return with_lineage(reader.load(path))


def drain(query: StreamingQuery) -> StreamingQuery:
    query.awaitTermination()
    return query


def append_stream(df: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Append a stateless stream to a Parquet folder, each input file exactly once."""
    return drain(
        df.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(availableNow=True).start())


def ingest_stream(spark: SparkSession, path: str, schema: StructType | str, out: str, checkpoint: str,
                  fmt: str = "parquet", pattern: str | None = None) -> StreamingQuery:
    return append_stream(file_stream(spark, path, schema, fmt, pattern), out, checkpoint)


FILE_NAMES = "path string, modificationTime timestamp, length long, content binary"


def ingest_rescued(spark: SparkSession, path: str, schema: StructType | str, out: str, checkpoint: str,
                   files_per_batch: int = FILES_PER_BATCH) -> StreamingQuery:
    """Like :func:`ingest_stream` for Parquet files that need not agree: what ``schema`` has no place for is kept as JSON.

    The stream carries the names of new files only; each micro-batch reads its files by what they hold and overwrites its own
    ``batch_id`` folder, so a replayed batch replaces its rows.
    """
    names = (spark.readStream.format("binaryFile").schema(FILE_NAMES).option("maxFilesPerTrigger", files_per_batch)
             .option("pathGlobFilter", "*.parquet").load(path).select("path"))

    def write(batch: DataFrame, batch_id: int) -> None:
        files = sorted(r.path for r in batch.collect())
        if files:
            read_parquet_files(batch.sparkSession, files, schema).write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    return drain(names.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def expect_stream(df: DataFrame, rules: list[Rule], good: str, bad: str, checkpoint: str, metrics: str | None = None) -> StreamingQuery:
    """Split a stream into accepted and quarantined rows.

    A frame that carries its raw rows (``with_raw``) is quarantined with them.  Each micro-batch overwrites its own ``batch_id`` folder, so a batch that is replayed
    after a lost driver replaces its rows instead of adding them again. With ``metrics`` the rule counts of each batch, observed
    while it is split, are kept the same way.
    """
    def split(batch: DataFrame, batch_id: int) -> None:
        counted = Counted(rules)
        tagged = counted.watch(tag(batch, rules)).persist()
        try:
            accepted(tagged).drop(RAW).write.mode("overwrite").parquet(f"{good}/batch_id={batch_id}")
            refused = as_received(tagged) if RAW in tagged.columns else rejected(tagged)
            refused.write.mode("overwrite").parquet(f"{bad}/batch_id={batch_id}")
            if metrics:
                rows = batch.sparkSession.createDataFrame(counted.rows(), METRICS)
                rows.coalesce(1).write.mode("overwrite").parquet(f"{metrics}/batch_id={batch_id}")
        finally:
            tagged.unpersist()

    return drain(
        df.writeStream.foreachBatch(split).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start())


@dataclass
class Refresh:
    """Where a feed's current output and checkpoint live.

    A full refresh moves to a new version (new output, new checkpoint); an incremental one
    goes on with the current version.  The version log is append-only.
    """

    spark: SparkSession
    root: str

    def version(self) -> int:
        log = f"{self.root}/_versions"
        if not folder_exists(self.spark, log):
            return 0
        return self.spark.read.parquet(log).agg(F.max("version")).first()[0]

    def begin(self, full: bool) -> int:
        now = self.version()
        if full or now == 0:
            now += 1
            append_rows(self.spark.createDataFrame([(now,)], "version int"), f"{self.root}/_versions")
        return now

    def paths(self, feed: str, version: int) -> tuple[str, str]:
        base = f"{self.root}/v{version}"
        return f"{base}/{feed}", f"{base}/_checkpoints/{feed}"
