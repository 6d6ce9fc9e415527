"""Join shapes that plain ``DataFrame.join`` does not name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeplan.functions.columns import great_circle_km, month_start
from lakeplan.session import broadcast_if_small, measured


def lookup(fact: DataFrame, dim: DataFrame, on, how: str = "inner") -> DataFrame:
    """Fact to dimension; the dimension is broadcast only if its estimated size allows."""
    return fact.join(broadcast_if_small(dim), on, how)


def monthly_lookup(df: DataFrame, rates: DataFrame, keys: list[str], day: str,
                   month: str = "month", how: str = "left") -> DataFrame:
    """Match a monthly table on its keys and the calendar month of ``day``."""
    tagged = df.withColumn(month, month_start(day))
    return tagged.join(broadcast_if_small(rates), [*keys, month], how).drop(month)


def flag_known(df: DataFrame, dim: DataFrame, key: str, flag: str) -> DataFrame:
    """True where the key exists in the dimension; the row count never changes."""
    known = dim.select(key).where(F.col(key).isNotNull()).distinct().withColumn(flag, F.lit(True))
    return df.join(broadcast_if_small(known), key, "left").withColumn(flag, F.coalesce(flag, F.lit(False)))


def exists_flag(df: DataFrame, other: DataFrame, key: str, flag: str, within: str | None = None) -> DataFrame:
    """Like :func:`flag_known` for a large many-rows side: one row per key, then a left join.

    ``within`` names a column of both sides that the key determines (the order of a line), of few keys a value. The keys then
    meet as one list per value, so rows that already lie together by it are not shuffled again.
    """
    if within is None:
        present = other.groupBy(key).agg(F.lit(True).alias(flag))
        return df.join(present, key, "left").withColumn(flag, F.coalesce(flag, F.lit(False)))
    present = other.groupBy(within).agg(F.collect_set(key).alias("_keys"))
    found = df.join(present, within, "left").withColumn(flag, F.coalesce(F.array_contains("_keys", F.col(key)), F.lit(False)))
    return found.drop("_keys")


def orphans(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """(key, rows) of fact keys the dimension lacks.

    The fact is counted per key first, so the join moves one row per distinct key.
    """
    counted = fact.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    return counted.join(dim.select(key).distinct(), key, "left_anti")


#: Windows up to 2 ** 22 days; a day number fits well below it.
MOST_LEVELS = 22


def dyadic_pieces(first: Column, last: Column) -> Column:
    """Array of (level, at): the days from ``first`` to ``last`` as at most two aligned blocks of 2 ** level days a level.

    On each level the blocks that still fit run from ``lo`` to ``hi``; an odd end has no sibling inside and is a piece of its own.
    """
    def pieces(level):
        width = F.pow(F.lit(2), level).cast("long")
        lo = F.floor((F.unix_date(first).cast("long") + width - 1) / width).cast("long")
        hi = F.floor((F.unix_date(last).cast("long") + 1) / width).cast("long")
        odd = lambda x: x.bitwiseAND(F.lit(1).cast("long")) == 1
        piece = lambda at: F.struct(level.cast("int").alias("level"), at.alias("at"))
        return F.array(F.when((lo < hi) & odd(lo), piece(lo)), F.when((lo < hi) & odd(hi), piece(hi - 1)))

    return F.array_compact(F.flatten(F.transform(F.sequence(F.lit(0), F.lit(MOST_LEVELS)), pieces)))


def event_window_join(events: DataFrame, daily: DataFrame, event_day_start: str, event_day_end: str,
                      before: int, on: list[str], daily_date: str = "order_date") -> DataFrame:
    """Join daily rows lying between ``before`` days ahead of the start and the end, per key.

    A window of any length becomes a few dyadic pieces, at most two a level; a day has one block on every level that some
    piece has. Both meet by equality on the keys, the level and the block, and exactly once. A NULL end makes no window.
    """
    windows = events.withColumn("_piece", F.explode(dyadic_pieces(F.date_sub(F.col(event_day_start), before), F.col(event_day_end))))
    pieces = measured(windows.withColumns({"_level": F.col("_piece.level"), "_at": F.col("_piece.at")}).drop("_piece"), "windows")
    levels = sorted(r[0] for r in pieces.select("_level").distinct().collect()) or [0]
    blocks = F.explode(F.array(*[F.struct(F.lit(n).alias("_level"), F.floor(F.unix_date(daily_date) / F.lit(1 << n)).cast("long").alias("_at")) for n in levels]))
    keyed = daily.withColumn("_block", blocks).withColumns({"_level": F.col("_block._level"), "_at": F.col("_block._at")}).drop("_block")
    return keyed.join(pieces, [*on, "_level", "_at"]).drop("_level", "_at")


def trailing_join(cutoffs: DataFrame, grid: DataFrame, weeks: int, cutoff: str = "cutoff",
                  week: str = "week_start") -> DataFrame:
    """Grid rows of the ``weeks`` weeks up to and including each cutoff Monday.

    The weeks are few: they are written and measured, so that the grid is not shuffled on them.
    """
    back = F.sequence(F.date_sub(F.col(cutoff), 7 * (weeks - 1)), F.col(cutoff), F.expr("INTERVAL 7 DAY"))
    spans = cutoffs.select(cutoff).distinct().withColumn(week, F.explode(back))
    return grid.join(measured(spans, "weeks"), week)


def grid_with(df: DataFrame, values: list, column: str) -> DataFrame:
    """Every row paired with every value of a short literal list."""
    return df.withColumn(column, F.explode(F.array(*[F.lit(v) for v in values])))


def active_days(entities: DataFrame, opened: str, closed: str, last_day: str, first_day: str,
                name: str = "date") -> DataFrame:
    """One row per entity and day it is open; the closing day itself is excluded."""
    lo = F.greatest(F.col(opened), F.lit(first_day).cast("date"))
    hi = F.least(F.coalesce(F.date_sub(F.col(closed), 1), F.lit(last_day).cast("date")),
                 F.lit(last_day).cast("date"))
    return (
        entities.withColumns({"_lo": lo, "_hi": hi}).where("_lo <= _hi")
        .withColumn(name, F.explode(F.sequence("_lo", "_hi", F.expr("INTERVAL 1 DAY"))))
        .drop("_lo", "_hi")
    )


def shifted_join(df: DataFrame, calendar: DataFrame, day: str, offset: int, keys: list[str],
                 value: str, calendar_day: str, default) -> DataFrame:
    """Value of a day ``offset`` days ahead, with a default where the calendar has none."""
    ahead = calendar.select(*keys, F.date_sub(F.col(calendar_day), offset).alias(day), value)
    return df.join(ahead, [*keys, day], "left").fillna({value: default})


def count_up_to(starts: Column, day: Column) -> Column:
    """How many of a sorted array's dates are not after ``day``: a binary search, one step for each halving."""
    steps = F.sequence(F.lit(0), F.ceil(F.log2(F.size(starts) + F.lit(1))).cast("int"))
    bounds = F.struct(F.lit(0).alias("lo"), F.size(starts).alias("hi"))

    def halve(s, _):
        middle = F.floor((s["lo"] + s["hi"]) / 2).cast("int")
        after, is_open = F.get(starts, middle) > day, s["lo"] < s["hi"]
        return F.struct(F.when(is_open & ~after, middle + 1).otherwise(s["lo"]).alias("lo"), F.when(is_open & after, middle).otherwise(s["hi"]).alias("hi"))

    return F.aggregate(steps, bounds, halve)["lo"]


def asof_price(days: DataFrame, history: DataFrame, key: str, day: str) -> DataFrame:
    """The version in force on each day: the last with ``valid_from <= day``, if ``day < valid_to`` (NULL is open at either end).

    A key's versions, at most one a day, are one row of sorted arrays, so the join gives a row for each row and the version
    is searched inside it. Of versions that begin on one day the one that ends last counts. A NULL key or day finds nothing.
    """
    values = [c for c in history.columns if c not in (key, "valid_from", "valid_to")]
    since, until = F.coalesce("valid_from", F.lit("0001-01-01").cast("date")), F.coalesce("valid_to", F.lit("9999-12-31").cast("date"))
    version = F.struct(since.alias("since"), until.alias("until"), F.struct("valid_from", "valid_to", *values).alias("v"))
    held = history.where(F.col(key).isNotNull()).groupBy(F.col(key)).agg(F.array_sort(F.collect_list(version)).alias("_versions"))
    joined = days.join(broadcast_if_small(held), key, "left")
    at = F.get(F.col("_versions"), count_up_to(F.col("_versions.since"), F.col(day)) - 1)
    found = joined.withColumn("_at", at).drop("_versions")
    live = F.col(day) < F.col("_at.until")
    picked = [F.when(live, F.col(f"_at.v.{c}")).alias(c) for c in history.columns if c != key]
    return found.select(*days.columns, *picked)


def nearest(points: DataFrame, sites: list[tuple[str, float, float]], lat: str = "lat", lon: str = "lon",
            override: dict[str, str] | None = None, zone: str = "zone") -> DataFrame:
    """Nearest site of a short fixed list by great-circle distance; some zones are pinned.

    The sites are literals in the plan: each row picks its own minimum, no join is made.
    """
    def km(site):
        return great_circle_km(F.col(lat), F.col(lon), F.lit(site[1]), F.lit(site[2]))

    best = F.array_min(F.array(*[
        F.struct(F.round(km(s), 6).alias("km"), F.lit(s[0]).alias("site")) for s in sites
    ]))
    site, km_out = best["site"], best["km"]
    for z, pinned in (override or {}).items():
        at = next(s for s in sites if s[0] == pinned)
        site = F.when(F.col(zone) == z, F.lit(pinned)).otherwise(site)
        km_out = F.when(F.col(zone) == z, F.round(km(at), 6)).otherwise(km_out)
    return points.withColumns({"site": site, "distance_km": km_out})
