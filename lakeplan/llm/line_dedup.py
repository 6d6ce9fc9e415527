"""Removal of lines that many sites share.

The spread of a line is the number of distinct sites it occurs on. One HyperLogLog sketch of sites per line hash is built
map-side and merged by aggregation, so a very common line costs one row per task. Lines whose estimate is well above the
threshold are boilerplate, those well below are not, and lines near it get an exact distinct count. Boilerplate lines are
taken out of every document; only documents that may hold one meet the list of removals.

Lines are compared without surrounding blanks; blank lines, and those shorter than least_chars, are left alone. Defined results: NULL text
counts as empty (one empty line); a NULL site counts for no spread; repeated rows are cleaned alike; extra columns pass
through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeplan.llm import common

SITES = 5
LEAST_CHARS = 1
SKETCH_BITS = 8
MARGIN = 0.3


def line_key(line: Column, least_chars: int) -> Column:
    """128-bit hash of a line without surrounding blanks; NULL for short lines."""
    bare = F.btrim(line, F.lit(" \t\r"))
    return F.when(F.length(bare) >= least_chars, F.unhex(F.md5(bare.cast("binary"))))


def row_key(doc_id: str, text: Column) -> Column:
    """MD5 of the text and a hash of the id, which differs for NULL and any text of an id."""
    own = F.col(doc_id).cast("string")
    return F.concat(F.unhex(F.md5(text.cast("binary"))), F.unhex(F.lpad(F.hex(F.xxhash64(own.isNull(), own)), 16, "0")))


def lines_of(docs: DataFrame, doc_id: str, text: str, site: str, least_chars: int) -> DataFrame:
    """(row, position, line, site) of the lines that count."""
    whole = common.whole_text(text)
    rows = docs.select(row_key(doc_id, whole).alias("row"), F.col(site).cast("string").alias("site"), F.posexplode(F.split(whole, "\n")).alias("position", "text"))
    return rows.select("row", "position", line_key(F.col("text"), least_chars).alias("line"), "site").filter("line IS NOT NULL")


def boilerplate(lines: DataFrame, sites: int = SITES, margin: float = MARGIN) -> DataFrame:
    """(line,) hashes of lines on at least ``sites`` distinct sites."""
    sketched = lines.groupBy("line").agg(F.hll_sketch_agg("site", SKETCH_BITS).alias("sketch"))
    estimated = common.written(sketched.select("line", F.hll_sketch_estimate("sketch").alias("spread"))
                               .filter(F.col("spread") > sites * (1 - margin)), "spread")
    far = estimated.filter(F.col("spread") > sites * (1 + margin)).select("line")
    near = estimated.filter(F.col("spread") <= sites * (1 + margin)).select("line")
    candidates = common.flagged(lines.select("line", "site").filter("site IS NOT NULL"), near, "line").filter("__maybe")
    exact = (candidates.select("line", "site").distinct().join(near, "line", "left_semi")
             .groupBy("line").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= sites).select("line"))
    return far.unionByName(exact)


def without_boilerplate(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", site: str = "source",
                        sites: int = SITES, least_chars: int = LEAST_CHARS) -> DataFrame:
    """``docs`` with its text cleaned, and n_lines and n_removed; columns of these names are replaced."""
    docs = docs.drop("n_lines", "n_removed")
    lines = lines_of(docs, doc_id, text, site, least_chars)
    common_lines = common.written(boilerplate(lines, sites), "boilerplate")
    hits = common.flagged(lines.select("row", "position", "line"), common_lines, "line").filter("__maybe").join(common_lines, "line", "left_semi")
    removals = common.written(hits.groupBy("row").agg(F.collect_set("position").alias("__removed")), "removals").withColumnRenamed("row", "__row")
    keyed = common.flagged(docs.withColumn("__row", row_key(doc_id, common.whole_text(text))), removals, "__row")
    clear = keyed.filter("NOT __maybe").withColumn("__removed", F.lit(None).cast("array<int>"))
    tagged = clear.unionByName(keyed.filter("__maybe").join(removals, "__row", "left").select(*[f"`{c}`" for c in clear.columns]))
    split = F.split(common.whole_text(text), "\n")
    kept = F.filter(split, lambda line, i: ~F.array_contains("__removed", i))
    cleaned = F.when(F.col("__removed").isNull(), F.col(text)).otherwise(F.array_join(kept, "\n"))
    others = [F.col(f"`{c}`") if c != text else cleaned.alias(text) for c in docs.columns]
    return tagged.select(*others, F.size(split).cast("long").alias("n_lines"), F.coalesce(F.size("__removed"), F.lit(0)).cast("long").alias("n_removed"))
