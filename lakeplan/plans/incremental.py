"""Which months of gold a run must compute anew.

A triggered stream of its own reads what bronze has received since the last look and notes the months that it touches: those of new
sales lines, and those of the lines whose order or return is new. Every micro-batch overwrites its own folder. A gold refresh
that has gone through writes the last batch of each feed to a log; batches after it are pending, so a run that fails leaves
its months to the next one. A new refresh version, and any change of the snapshot tables that the fact is joined to, makes
everything anew.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lakeplan.functions.columns import month_start
from lakeplan.operators.refresh import touched_months
from lakeplan.sources.writers import append_rows, folder_exists
from lakeplan.streaming.ingest import FILES_PER_BATCH, drain

LOG_SCHEMA = "version int, fingerprint string, batches map<string,bigint>, refreshed_at timestamp"
#: What says which lines a new row of a feed touches: their day, or their key.
FEED_KEYS = {"sales_lines": "order_date", "orders": "order_id", "returns": "line_id"}


@dataclass(frozen=True)
class Pending:
    """``months`` to compute, None for all; what to log once they are."""

    months: list[dt.date] | None
    fingerprint: str
    batches: dict[str, int]


def fingerprint(tables: list[DataFrame]) -> str:
    """Row counts and order-free hashes of small tables."""
    parts = []
    for t in tables:
        h = F.xxhash64(*sorted(t.columns))
        n, x, s = t.agg(F.count(F.lit(1)), F.bit_xor(h), F.sum(F.pmod(h, F.lit(1_000_000_007)))).first()
        parts.append(f"{n}:{x}:{s}")
    return "|".join(parts)


class ChangeLog:
    """Months touched by what arrived, per feed and refresh version, below one folder."""

    def __init__(self, spark: SparkSession, root: str, version: int):
        self.spark, self.root, self.version = spark, root, version

    def notes(self, feed: str) -> str:
        return f"{self.root}/v{self.version}/{feed}"

    def note(self, feed: str, stream: DataFrame, lines: DataFrame) -> StreamingQuery:
        """Months of the order dates behind the new rows of a feed; ``lines`` has line_id, order_id and order_date."""
        key, out = FEED_KEYS[feed], self.notes(feed)

        def months(batch: DataFrame, batch_id: int) -> None:
            if feed == "sales_lines":
                days = batch.select(F.to_date(key).alias("order_date"))
            else:
                days = lines.join(batch.select(F.col(key).cast("string").alias(key)).distinct(), key, "left_semi").select("order_date")
            found = days.where("order_date IS NOT NULL").select(month_start("order_date").alias("month")).distinct()
            found.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

        return drain(stream.writeStream.foreachBatch(months).option("checkpointLocation", f"{self.root}/_checkpoints/v{self.version}/{feed}")
                     .trigger(availableNow=True).start())

    def log(self) -> DataFrame:
        path = f"{self.root}/refreshes"
        if not folder_exists(self.spark, path):
            return self.spark.createDataFrame([], LOG_SCHEMA)
        return self.spark.read.schema(LOG_SCHEMA).parquet(path)

    def pending(self, snapshots: list[DataFrame]) -> Pending:
        seen = [f for f in FEED_KEYS if folder_exists(self.spark, self.notes(f))]
        noted = [self.spark.read.schema("month date, batch_id long").parquet(self.notes(f)).select(F.lit(f).alias("feed"), "month", "batch_id") for f in seen]
        now = fingerprint(snapshots)
        last = self.log().where(F.col("version") == self.version).orderBy(F.desc("refreshed_at")).first()
        if not noted:
            return Pending(None if last is None or last.fingerprint != now else [], now, {})
        notes = reduce(DataFrame.unionByName, noted)
        batches = {r.feed: r.last for r in notes.groupBy("feed").agg(F.max("batch_id").alias("last")).collect()}
        if last is None or last.fingerprint != now:
            return Pending(None, now, batches)
        done = F.coalesce(*[F.when(F.col("feed") == f, F.lit(n)) for f, n in last.batches.items()], F.lit(-1)) if last.batches else F.lit(-1)
        return Pending(touched_months(notes.where(F.col("batch_id") > done), "month"), now, last.batches | batches)

    def done(self, what: Pending) -> None:
        row = self.spark.createDataFrame([(self.version, what.fingerprint, what.batches)], "version int, fingerprint string, batches map<string,bigint>")
        append_rows(row.withColumn("refreshed_at", F.current_timestamp()), f"{self.root}/refreshes")


def bronze_stream(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", FILES_PER_BATCH).parquet(path)
