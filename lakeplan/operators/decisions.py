"""Append-only planner decision log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeplan.operators.dedupe import first_per_key
from lakeplan.sources.writers import APPEND_ID, append_once, folder_exists

DECISION_SCHEMA = (
    "warehouse_id string, sku_id string, recommended_order_units double, override_units double, "
    "decision string, comment string, decided_by string, decided_at timestamp"
)


def latest_decisions(log: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """The last decision per item; equal times fall back to the decision text and units."""
    order = [F.col("decided_at").desc(), F.col("decision").asc(), F.col("override_units").asc()]
    return first_per_key(log, keys or ["warehouse_id", "sku_id"], order)


def content_key(df: DataFrame) -> str:
    """A key of the rows whatever their order: their number, and sums of two hashes."""
    first, second = F.xxhash64(*df.columns), F.xxhash64(F.lit(1), *df.columns)
    n, a, b = df.agg(F.count(F.lit(1)), *[F.sum(h.cast("decimal(38,0)")) for h in (first, second)]).first()
    return f"rows-{n}-{int(a or 0) % (1 << 64):016x}{int(b or 0) % (1 << 64):016x}"


class DecisionLog:
    """Typed log in a Parquet folder; rows are only ever appended, and a batch of rows once.

    A batch is known by its key, else by what it holds: a call that is repeated after a lost answer adds nothing.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def append(self, rows: list[tuple] | DataFrame, key: str | None = None) -> bool:
        """Whether the rows were added."""
        df = rows if isinstance(rows, DataFrame) else self.spark.createDataFrame(rows, DECISION_SCHEMA)
        df = df.select(*[c.split()[0] for c in DECISION_SCHEMA.split(", ")])
        return append_once(df, self.path, key or content_key(df))

    def read(self) -> DataFrame:
        if not folder_exists(self.spark, self.path):
            return self.spark.createDataFrame([], DECISION_SCHEMA)
        return self.spark.read.schema(DECISION_SCHEMA).parquet(self.path).drop(APPEND_ID)

    def latest(self) -> DataFrame:
        return latest_decisions(self.read())


def planner_view(recommendations: DataFrame, log: DataFrame, warehouses: list[str] | None = None,
                 risks: list[str] | None = None) -> DataFrame:
    """Recommendations with the latest decision, narrowed by the planner's selection."""
    from lakeplan.operators.filters import apply_filters

    chosen = apply_filters(recommendations, {"warehouse_name": warehouses, "stockout_risk": risks})
    last = latest_decisions(log).select(
        "warehouse_id", "sku_id", F.col("decision").alias("last_decision"),
        F.col("override_units").alias("last_override"))
    return chosen.join(last, ["warehouse_id", "sku_id"], "left")
