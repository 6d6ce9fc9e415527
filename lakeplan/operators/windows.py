"""Window operators.

Windows are used only over groups whose size is bounded by the calendar (one row per
day or week); rankings over whole tables or hot groups go through a range sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeplan.session import checkpoint_table, measured, null_safe


def rolling(keys: list[str], order: str, rows: int) -> Window:
    """Frame of the last ``rows`` rows including the current one."""
    return Window.partitionBy(*keys).orderBy(order).rowsBetween(-(rows - 1), 0)


def rolling_mean(value: str, keys: list[str], order: str, rows: int) -> Column:
    return F.avg(value).over(rolling(keys, order, rows))


def running_sum(value: str, keys: list[str], order: str) -> Column:
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return F.sum(value).over(w)


def share_of(df: DataFrame, value: str, keys: list[str], out: str = "share") -> DataFrame:
    """Each row's part of its group total.

    The total is aggregated map-side and its measured, small table is joined back, so a hot group
    is not gathered into one task as a window would.  Both read the rows as written once, since a row is often an aggregate
    over much.  A NULL key is a group like any other.
    """
    df = checkpoint_table(df, "parts")
    total = measured(df.groupBy(*keys).agg(F.sum(value).alias("_total")), "totals")
    part = F.coalesce(F.col(value) / F.nullif(F.col("_total").cast("double"), F.lit(0.0)), F.lit(0.0))
    return null_safe(df, total, keys).withColumn(out, part).drop("_total")


def cumulative_intervals(df: DataFrame, share: str, keys: list[str], order: list[Column | str]) -> DataFrame:
    """``[cum_lo, cum_hi)`` of each category inside its group (groups are short category lists)."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    hi = F.sum(share).over(w)
    return df.withColumn("cum_hi", hi).withColumn("cum_lo", F.col("cum_hi") - F.col(share))


def global_index(df: DataFrame, order: list[Column], out: str = "row_index", label: str = "index") -> DataFrame:
    """1-based position of every row in a total order, without a single-task sort.

    Rows are range-partitioned and sorted; each remembers its partition and its place
    there.  That frame is written once, so both later passes see the same partitions;
    a running sum of the partition sizes (one row each) turns places into positions.
    """
    local = F.monotonically_increasing_id()
    placed = checkpoint_table(
        df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_mid", local)
        .withColumns({
            "_pid": F.shiftright("_mid", 33).cast("int"),
            "_pos": F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1)),
        }).drop("_mid"),
        label,
    )
    sizes = placed.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_pid", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_start"))
    return (
        placed.join(F.broadcast(starts), "_pid")  # one row per partition
        .withColumn(out, F.col("_start") + F.col("_pos") + 1)
        .drop("_pid", "_pos", "_start")
    )


def tile_ends(n: int, k: int) -> list[int]:
    """Positions of the last row of every tile of ``ntile(k)`` among ``n`` rows, but for the last tile."""
    small, extra = divmod(n, k)
    ends = [(i + 1) * small + min(i + 1, extra) for i in range(k)]
    return sorted({e for e in ends if 0 < e < n})


def global_ntile(df: DataFrame, k: int, order: list[Column], out: str) -> DataFrame:
    """``ntile(k)`` over the whole table, for an ascending order that tells all rows apart.

    Only the ordering keys are sorted and written; the k - 1 keys that end a tile become literals,
    against which every row is compared in one pass.  A descending number is given as its negative.
    """
    key = F.struct(*[c.alias(f"k{i}") for i, c in enumerate(order)])
    indexed = global_index(df.select(key.alias("_key")), [F.col("_key")], "_idx", f"ntile_{out}")
    ends = tile_ends(indexed.count(), k)
    bounds = sorted((r["_idx"], r["_key"]) for r in indexed.where(F.col("_idx").isin(ends)).collect())
    kinds = [f.dataType for f in indexed.schema["_key"].dataType.fields]
    tile = F.lit(1)
    for _, bound in bounds:
        literal = F.struct(*[F.lit(v).cast(t).alias(f"k{i}") for i, (v, t) in enumerate(zip(bound, kinds, strict=True))])
        tile = tile + (key > literal).cast("int")
    return df.withColumn(out, tile)


def dense_index(df: DataFrame, keys: list[str], order: list[Column], out: str = "idx") -> DataFrame:
    """0-based position inside each group, for groups of any size.

    The keys lead the global order, so a group's rows are contiguous and its first
    position is a map-side minimum; that table is broadcast if it is measured to be small.
    """
    indexed = global_index(df, [F.col(k) for k in keys] + order, "_idx", "dense_index")
    first = measured(indexed.groupBy(*keys).agg(F.min("_idx").alias("_first")), "firsts")
    return (
        null_safe(indexed, first, keys)
        .withColumn(out, F.col("_idx") - F.col("_first"))
        .drop("_idx", "_first")
    )


def scd2(df: DataFrame, key: str, valid_from: str = "valid_from") -> DataFrame:
    """Close each version where the next begins; NULL marks the current one.

    Versions of one key are few, so the window group is short.
    """
    nxt = F.lead(valid_from).over(Window.partitionBy(key).orderBy(valid_from))
    return df.withColumn("valid_to", nxt).withColumn("is_current", F.col("valid_to").isNull())


def seasonal_lag(value: str, keys: list[str], week: str, weeks: int = 52) -> Column:
    """Value ``weeks`` rows earlier; exact on a complete weekly grid."""
    return F.lag(value, weeks).over(Window.partitionBy(*keys).orderBy(week))
