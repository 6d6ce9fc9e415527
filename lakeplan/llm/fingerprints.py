"""One-permutation MinHash fingerprints of documents, in DataFrame functions only.

Every shingle (five words, lower case) is hashed once. The leading eight bits of a hash name its bin, and each bin keeps its
smallest hash: in a sorted array these are the first elements of the bins. An empty bin takes the value of the first
non-empty bin on a walk of its own through all bins (optimal densification), so bins stay independent. The lowest four bits
of the 256 bins, each value mixed with its bin's number so that chance hits of borrowed values stay independent, are packed into 16 longs and shown as hexadecimal text. Two fingerprints agree in a share m of their bins;
as unequal values agree in four bits by chance once in 16, the likeness is (m - 1/16) / (15/16), at least 0.

Defined results: NULL text counts as empty; texts without words have the fingerprint '' and a likeness of 1 to each other
and 0 to any other; texts of fewer than five words are one shingle. Of rows that repeat an id the order is that of the
hashes of their texts, descending; NULL ids come after all others. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeplan.llm import common

SHINGLE_WORDS = 5
BIN_BITS = 8
LOW_BITS = 4
ROWS_PER_BLOCK = 256
MOST_BLOCKS = 100_000
SEGMENTS = 64
NO_ID = -(1 << 63)


def let(value: str, name: str, body: str) -> str:
    """SQL that evaluates ``value`` once and uses it as ``name`` in ``body``."""
    return f"transform(array({value}), {name} -> {body})[0]"


def packed_minhash(text: str, words: int = SHINGLE_WORDS, bin_bits: int = BIN_BITS, low_bits: int = LOW_BITS) -> Column:
    """The packed bins of a text column as an array of longs; NULL for a text without words."""
    bins, shift, per_long = 1 << bin_bits, 64 - bin_bits, 64 // low_bits
    shingle = ", ".join(f"h[i + {k}]" for k in range(words))
    shingles = (f"if(size(h) >= {words}, transform(sequence(0, size(h) - {words}), i -> xxhash64({shingle})), array(xxhash64(h)))")
    smallest = f"filter(s, (x, i) -> i = 0 OR shiftright(x, {shift}) != shiftright(s[i - 1], {shift}))"
    spread = (f"if(size(f) = {bins}, f, " + let(f"transform(f, x -> shiftright(x, {shift}))", "b",
              f"transform(sequence({-bins // 2}, {bins // 2 - 1}), j -> get(f, CAST(array_position(b, CAST(j AS BIGINT)) AS INT) - 1))") + ")")

    def walk(first: int, last: int) -> str:
        step = f"CAST((((xxhash64(j) & {bins // 2 - 1}) * 2 + 1) * t + (xxhash64(j, 1) & {bins - 1})) & {bins - 1} AS INT)"
        return f"get(filter(transform(sequence({first}, {last}), t -> get(d, {step})), x -> x IS NOT NULL), 0)"

    filled = f"transform(sequence(0, {bins - 1}), j -> coalesce(get(d, j), {walk(0, 7)}, {walk(8, 63)}, {walk(64, bins - 1)}))"
    low = (1 << low_bits) - 1
    packed = (f"transform(sequence(0, {bins // per_long - 1}), q -> aggregate(slice(e, q * {per_long} + 1, {per_long}), 0L, "
              f"(acc, x) -> shiftleft(acc, {low_bits}) | (x & {low})))")
    body = let(f"transform({filled}, (x, j) -> xxhash64(x, j))", "e", packed)
    for value, name in ((spread, "d"), (smallest, "f"), (f"sort_array({shingles})", "s"),
                        (rf"transform(split(t, r'{common.SPACE}'), w -> xxhash64(w))", "h")):
        body = let(value, name, body)
    trimmed = rf"btrim(lower({text}), ' \t\n\u000b\u000c\r')"
    return F.expr(let(trimmed, "t", f"if(t = '', NULL, {body})"))


def as_text(packed: str) -> Column:
    return F.coalesce(F.array_join(F.transform(packed, lambda x: F.lpad(F.hex(x), 16, "0")), ""), F.lit(""))


def likeness(a: str, b: str, low_bits: int = LOW_BITS) -> Column:
    """Bias-corrected share of equal bins of two packed fingerprints."""
    per_long = 64 // low_bits
    ones = sum(1 << (low_bits * i) for i in range(per_long))
    folded = " | ".join(["x"] + [f"shiftrightunsigned(x, {k})" for k in range(1, low_bits)])
    differ = f"aggregate(zip_with({a}, {b}, (p, q) -> p ^ q), 0, (acc, x) -> acc + bit_count(({folded}) & {ones}L))"
    chance = 1.0 / (1 << low_bits)
    share = F.expr(f"1 - {differ} / CAST(size({a}) * {per_long} AS DOUBLE)")
    return (F.when(F.expr(f"{a} IS NULL AND {b} IS NULL"), 1.0).when(F.expr(f"{a} IS NULL OR {b} IS NULL"), 0.0)
            .otherwise(F.greatest(F.lit(0.0), (share - chance) / (1 - chance))))


def place_of(lowest: int) -> Column:
    """One number for (order_id, order_hash), monotone in both: the id plus the hash as a part of one; NULL ids just below ``lowest``."""
    whole = F.when(F.col("order_id") == NO_ID, F.lit(float(lowest)) - 1).otherwise(F.col("order_id").cast("double"))
    return whole + F.col("order_hash").cast("double") / 2.0 ** 64 + 0.5


def block_of(ids: DataFrame) -> Column:
    """A monotone block number of (order_id, order_hash), with about ROWS_PER_BLOCK rows a block and MOST_BLOCKS blocks at most.

    A few quantiles of all rows cut the range into segments, and blocks divide a segment evenly. The rows of an id that
    repeats, NULL among them, spread by their hashes. Doubles round large ids; then blocks are coarser and still monotone.
    """
    lowest = ids.agg(F.min(F.when(F.col("order_id") != NO_ID, F.col("order_id"))).alias("lowest")).first().lowest or 0
    place = place_of(lowest)
    shares = [i / SEGMENTS for i in range(SEGMENTS + 1)]
    found = ids.agg(F.count(F.lit(1)).alias("n"), F.percentile_approx(place, shares, 10_000).alias("knots")).first()
    knots = sorted(set(found.knots or [0.0]))
    blocks = min(MOST_BLOCKS, -(-found.n // ROWS_PER_BLOCK))
    each = max(1, -(-blocks // max(1, len(knots))))
    known = F.array(*[F.lit(k) for k in knots])
    at = F.size(F.filter(known, lambda k: k <= place))
    low, high = F.get(known, at - 1), F.get(known, at)
    inside = F.least(F.lit(each - 1), F.floor((place - low) * each / (high - low)))
    return (at * each + F.coalesce(F.greatest(F.lit(0), inside), F.lit(0))).cast("long")


def with_next(rows: DataFrame, carried: list[str]) -> DataFrame:
    """Each row with the ``carried`` columns of the next row in descending (order_id, order_hash) as next_*; after the last the first.

    Rows are sorted inside blocks; the first row of a block is also sent to the block before it in this order, which needs
    only a table of one row per block.
    """
    narrow = common.written(rows.select("order_id", "order_hash"), "ids")
    block = block_of(narrow)
    tops = narrow.select(block.alias("block"), F.struct("order_id", "order_hash").alias("at")).groupBy("block").agg(F.max("at").alias("top"))
    everything = Window.orderBy("block")
    above = F.coalesce(F.lead("block").over(everything), F.first("block").over(everything.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    receivers = tops.select(F.col("block").alias("__block"), F.col("top").alias("__top"), above.alias("__above"))
    placed = rows.withColumn("__block", block).join(F.broadcast(receivers), "__block")
    own = F.struct(F.col("__block").alias("block"), F.lit(0).alias("helper"))
    helper = F.struct(F.col("__above").alias("block"), F.lit(1).alias("helper"))
    copies = F.when(F.struct("order_id", "order_hash") == F.col("__top"), F.array(own, helper)).otherwise(F.array(own))
    dealt = placed.withColumn("__at", F.explode(copies)).drop("__block", "__top", "__above")
    order = Window.partitionBy("__at.block").orderBy("__at.helper", F.col("order_id").desc(), F.col("order_hash").desc())
    following = {f"next_{c}": F.lead(c).over(order) for c in carried}
    return dealt.withColumns(following).filter("__at.helper = 0").drop("__at")


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of each row."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(doc_id).cast("long"), F.expr("-9223372036854775808L")).alias("order_id"),
                       common.whole_text(text).alias("text")).withColumn("order_hash", F.xxhash64("text"))
    known = rows.withColumn("packed", packed_minhash("text"))
    paired = with_next(known, ["text", "packed"])
    moved = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.length("text") - moved), F.substring("next_text", F.lit(1), moved))
    made = paired.select("doc_id", F.length("text").cast("long").alias("n_chars"), "packed", "next_packed", edited.alias("edited"))
    both = made.withColumn("edited_packed", packed_minhash("edited"))
    return both.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), as_text("packed").alias("fingerprint"),
                       as_text("edited_packed").alias("edited_fingerprint"), likeness("packed", "edited_packed").alias("near_edited"),
                       likeness("packed", "next_packed").alias("near_next"))
