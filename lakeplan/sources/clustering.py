"""File clustering on several columns by an interleaved key of quantile ranks.

A column's rank is the number of stored cut points that are not above its value. The bits of all ranks are interleaved (Morton
order) and the key's range is cut into as many parts as there are files, so a filter on any of the columns meets few files.
Cut points come from a table that is stored already; the frame that is written is not read for them. Part numbers are turned into
numbers whose hash is that part, so the rows of a part, and no others, meet in one task without sampling.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeplan.operators.joins import count_up_to
from lakeplan.session import planned_bytes

RANK_BITS = 8
FILE_BYTES = 128 * 1024 * 1024
TEXT_BYTES = 6


def order_number(column: str, kind: T.DataType) -> Column:
    """A number in the order of the column: days, microseconds, the value itself, or the first bytes of a text."""
    c = F.col(column)
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("double")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(c.cast("timestamp")).cast("double")
    if isinstance(kind, T.StringType):
        head = F.rpad(F.hex(F.substring(c.cast("binary"), 1, TEXT_BYTES)), 2 * TEXT_BYTES, "0")
        return F.conv(head, 16, 10).cast("double")
    return c.cast("double")


def quantile_cuts(stored: DataFrame, columns: list[str]) -> dict[str, list[float]]:
    """Up to 2 ** RANK_BITS - 1 cut points of each column, from one pass over a stored table; a column without values has none."""
    share = [i / (1 << RANK_BITS) for i in range(1, 1 << RANK_BITS)]
    found = stored.agg(*[F.percentile_approx(order_number(c, stored.schema[c].dataType), share, 10_000).alias(c) for c in columns]).first()
    return {c: sorted(set(found[c] or [])) for c in columns}


def interleaved(ranks: list[Column]) -> Column:
    """One bit of every rank after the other, the first column's first."""
    k = len(ranks)
    bits = [F.shiftleft(F.shiftright(r, b).bitwiseAND(F.lit(1)).cast("long"), b * k + k - 1 - i) for i, r in enumerate(ranks) for b in range(RANK_BITS)]
    return reduce(lambda a, b: a.bitwiseOR(b), bits)


def cluster_key(df: DataFrame, cuts: dict[str, list[float]]) -> Column:
    """NULL ranks first."""
    ranks = []
    for c, at in cuts.items():
        number = order_number(c, df.schema[c].dataType)
        ranks.append(F.coalesce(count_up_to(F.lit(at).cast("array<double>"), number), F.lit(0)) if at else F.lit(0))
    return interleaved(ranks)


def numbers_by_part(spark: SparkSession, n: int) -> list[int]:
    """For each part the least number that a shuffle by hash to n tasks sends to that task."""
    found, upto = {}, 4 * n + 64
    while len(found) < n:
        hit = spark.range(upto).select(F.col("id").cast("int").alias("id")).withColumn("part", F.pmod(F.hash("id"), F.lit(n)))
        found = {r.part: r.id for r in hit.groupBy("part").agg(F.min("id").alias("id")).collect()}
        upto *= 2
    return [found[i] for i in range(n)]


def files_for(stored: DataFrame) -> int:
    return max(1, -(-planned_bytes(stored) // FILE_BYTES))


def write_interleaved(df: DataFrame, path: str, cuts: dict[str, list[float]], files: int, mode: str = "overwrite") -> None:
    """At most ``files`` Parquet files; rows inside are in the order of the key as well, for row-group statistics."""
    whole = 1 << (RANK_BITS * len(cuts))
    keyed = df.withColumn("_z", cluster_key(df, cuts))
    part = F.floor(F.col("_z") * F.lit(files) / F.lit(whole)).cast("int")
    dealt = keyed.repartition(files, F.get(F.lit(numbers_by_part(df.sparkSession, files)), part))
    dealt.sortWithinPartitions("_z", *cuts).drop("_z").write.mode(mode).parquet(path)
