"""Column expressions shared by the operators.  All stay inside the JVM."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_DIAMETER_KM = 12742.0


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c: str | Column, digits: int = 2) -> Column:
    """Round an exact DECIMAL amount half up and hand it on as DOUBLE."""
    return F.round(col(c), digits).cast("double")


def rounded(c: str | Column, digits: int) -> Column:
    return F.round(col(c), digits)


def ratio(num: str | Column, den: str | Column) -> Column:
    """Quotient that is NULL, not an error, for a zero denominator."""
    return col(num).cast("double") / F.nullif(col(den).cast("double"), F.lit(0.0))


def mean(c: str | Column, digits: int = 6) -> Column:
    """Average from a sum rounded to ``digits``: the order of additions leaves no trace."""
    return F.round(F.sum(col(c)), digits) / F.nullif(F.count(col(c)), F.lit(0))


def sum_if(cond: Column, value: str | Column) -> Column:
    return F.sum(F.when(cond, col(value)))


def avg_if(cond: Column, value: str | Column, digits: int = 2) -> Column:
    return mean(F.when(cond, col(value)), digits)


def count_if(cond: Column) -> Column:
    return F.count(F.when(cond, F.lit(1)))


def band(choices: list[tuple[Column, str]], otherwise: str | None = None) -> Column:
    """First matching (condition, label) pair."""
    head, *rest = choices
    expr = reduce(lambda acc, p: acc.when(p[0], p[1]), rest, F.when(head[0], head[1]))
    return expr.otherwise(F.lit(otherwise))


def in_band(value: str | Column, cuts: list[tuple[float, str]], otherwise: str) -> Column:
    """Label by upper bound: the first ``value <= bound`` wins."""
    return band([(col(value) <= b, label) for b, label in cuts], otherwise)


def standardise(value: str | Column, mapping: dict[str, str]) -> Column:
    """Trimmed value, replaced by its standard spelling where one is known."""
    trimmed = F.trim(col(value))
    if not mapping:
        return trimmed
    pairs = [F.lit(x) for kv in mapping.items() for x in kv]
    return F.coalesce(F.element_at(F.create_map(*pairs), trimmed), trimmed)


def month_start(d: str | Column) -> Column:
    return F.trunc(col(d), "month").cast("date")


def week_start(d: str | Column) -> Column:
    """Monday of the week."""
    return F.date_trunc("week", col(d)).cast("date")


def date_key(d: str | Column) -> Column:
    d = col(d)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def fiscal_year_label(d: str | Column, start_month: int = 4) -> Column:
    """``FY25-26`` for a fiscal year that starts in ``start_month``."""
    d = col(d)
    first = F.when(F.month(d) >= start_month, F.year(d)).otherwise(F.year(d) - 1)
    two = lambda y: F.lpad((y % 100).cast("string"), 2, "0")
    return F.concat(F.lit("FY"), two(first), F.lit("-"), two(first + 1))


def fiscal_quarter_label(d: str | Column, start_month: int = 4) -> Column:
    shifted = (F.month(col(d)) - start_month + 12) % 12
    return F.concat(F.lit("Q"), (F.floor(shifted / 3) + 1).cast("string"))


def in_season(d: str | Column, windows: list[tuple[str, str]]) -> Column:
    """True when ``MM-dd`` lies in a window; a window may wrap the year end."""
    md = F.date_format(col(d), "MM-dd")
    tests = [
        (md >= a) & (md <= b) if a <= b else (md >= a) | (md <= b)
        for a, b in windows
    ]
    return reduce(lambda x, y: x | y, tests)


def great_circle_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Haversine distance in kilometres."""
    half = lambda x: F.pow(F.sin(F.radians(x) / 2), F.lit(2.0))
    a = half(lat2 - lat1) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half(lon2 - lon1)
    return F.lit(EARTH_DIAMETER_KM) * F.asin(F.sqrt(F.least(a, F.lit(1.0))))


def md5_bucket(buckets: int, *key: str) -> Column:
    """Bucket of a key by a hash that other engines have too, so that they can check it."""
    head = F.substring(F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in key])), 1, 8)
    return F.pmod(F.conv(head, 16, 10).cast("long"), F.lit(buckets)).cast("int")
