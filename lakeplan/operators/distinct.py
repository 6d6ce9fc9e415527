"""Exact distinct counts that can be added up: bitmaps over dense ids.

A member has a dense number from 1. An aggregate keeps, for every group, one word of 64 numbers per bucket of numbers that
occurs in it; words of several groups are merged by OR, so a coarser grain needs the stored aggregate only, and a new day is
added without touching old ones. A group of few among many members, as a day's, has a word per member and not more; longer
bitmaps would be kept, sorted and merged nearly empty, at a size that grows with the members of other days.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeplan.operators.joins import lookup
from lakeplan.operators.windows import global_index

BUCKET, MEMBERS = "member_bucket", "members"
WORD_BITS = 6


def dense_ids(df: DataFrame, member: str) -> DataFrame:
    """(member, member_no): numbers from 1 without gaps, in the order of the members; NULL is no member."""
    known = df.select(member).where(F.col(member).isNotNull()).distinct()
    return global_index(known, [F.col(member)], "member_no", "members")


def more_ids(ids: DataFrame, df: DataFrame, member: str) -> DataFrame:
    """``ids`` and the numbers of new members behind them; no number changes, so stored bitmaps stay good."""
    last = ids.agg(F.coalesce(F.max("member_no"), F.lit(0))).first()[0]
    new = dense_ids(df.select(member).join(ids, member, "left_anti"), member)
    return ids.unionByName(new.withColumn("member_no", F.col("member_no") + F.lit(last)))


def member_bitmaps(df: DataFrame, ids: DataFrame, member: str, keys: list[str]) -> DataFrame:
    """(keys, member_bucket, members) of the rows with a member; a bitmap is a long whatever its rows."""
    numbered = lookup(df.select(*keys, member), ids, member)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("member_no").bitwiseAND(F.lit((1 << WORD_BITS) - 1)).cast("int"))
    return numbered.groupBy(*keys, F.shiftright("member_no", WORD_BITS).alias(BUCKET)).agg(F.bit_or(bit).alias(MEMBERS))


def distinct_members(bitmaps: DataFrame, keys: list[str], out: str) -> DataFrame:
    """Exact distinct members by any keys of the aggregate."""
    merged = bitmaps.groupBy(*keys, BUCKET).agg(F.bit_or(MEMBERS).alias(MEMBERS))
    return merged.groupBy(*keys).agg(F.sum(F.bit_count(MEMBERS)).alias(out))
