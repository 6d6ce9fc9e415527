"""De-duplication and latest-row selection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeplan.session import null_safe

DUPLICATE = "is_duplicate"
SALTS = 64


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Keep the first row of every key under a total order.

    The rank filter is a top-1 limit that Spark also applies before the shuffle, so a
    hot key arrives as one row per map task.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def latest_per_key(df: DataFrame, keys: list[str], newest: str, *ties: Column) -> DataFrame:
    """Keep the newest row per key; ``ties`` complete the order."""
    return first_per_key(df, keys, [F.col(newest).desc(), *ties])


def mark_duplicates(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Flag every row but the first of its key, keeping all rows.

    Keys are counted map-side; only rows of keys that occur more than once are ranked, the others
    (nearly all) pass by.  Ranking takes two rounds, so that a hot key is not one task: round one
    ranks inside (key, salt), the salt being the row's place in its input task, which spreads exact
    copies and copies that a join has already brought together.  Round two ranks only the round-one
    winners of a key (at most SALTS); the losers stay in their salted group.
    """
    repeated = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(*keys, F.lit(True).alias("_repeated"))
    tagged = null_safe(df.withColumn("_salt", F.monotonically_increasing_id() % SALTS), repeated, keys, "left")
    local = Window.partitionBy(*keys, "_salt").orderBy(*order)
    final = Window.partitionBy(*keys, "_grp").orderBy(F.col("_rn"), *order)
    ranked = (
        tagged.where("_repeated").withColumn("_rn", F.row_number().over(local))
        .withColumn("_grp", F.when(F.col("_rn") == 1, F.lit(-1)).otherwise(F.col("_salt")))
        .withColumn(DUPLICATE, (F.col("_rn") > 1) | (F.row_number().over(final) > 1))
    )
    single = tagged.where("_repeated IS NULL").withColumn(DUPLICATE, F.lit(False))
    return single.drop("_salt", "_repeated").unionByName(ranked.drop("_salt", "_repeated", "_rn", "_grp"))


def mark_later(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """:func:`mark_duplicates` by one rank, for rows that already lie together by a key column: nothing is shuffled then."""
    return df.withColumn(DUPLICATE, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) > 1)


def dedupe(df: DataFrame, keys: list[str], order: list[Column]) -> tuple[DataFrame, DataFrame]:
    """(kept rows, surplus rows)."""
    surplus = mark_duplicates(df, keys, order).where(DUPLICATE).drop(DUPLICATE)
    return first_per_key(df, keys, order), surplus


def argmax_per(df: DataFrame, keys: list[str], score: str, *ties: Column) -> DataFrame:
    """The row with the largest score of each key."""
    return first_per_key(df, keys, [F.col(score).desc(), *ties])
