"""Phrase collocations: Rabin-Karp fingerprints of all n-grams, counted level by level, verified against the texts.

A worker turns words into 64-bit values and keeps prefix polynomials of them, so that the fingerprint of every n-gram of a batch
is one difference of an array. Per language and length a task adds occurrences of equal fingerprints before they are shuffled.
Each length is counted twice: first fingerprints and counts alone, then, for the frequent ones, rows with a pointer to a document
that holds the n-gram and the least and greatest value of a second polynomial. An n-gram is counted only where both shorter
n-grams inside it may be frequent: a bitmap of fixed size says so, lets frequent ones through always and others sometimes, and so
decides nothing. Tasks that count are large, TASK_WORDS words where the table allows: the more of a phrase's occurrences
meet in a task, the fewer rows are shuffled.

Texts appear only for frequent phrases. A fingerprint with one second value is read from the document that it points to. With two,
different phrases collided: their occurrences are read again and counted by their text. Counts are therefore those of the texts.

Every phrase has a least-scoring cut, found by joining its parts to their counts. Ranking keeps the first rows of each language
in every task before it sorts.

Defined results: NULL texts are empty, a NULL language is ``und``; ids only help to find a document and may be NULL or repeated;
every row counts, repeated rows too; equal scores go by count, then phrase; without frequent phrases there is no row; extra
columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import cache, reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeplan.llm import common

LONGEST = 5
BREAKS = b".,;:!?\x0a\x0b\x0c\x0d"
MARK = b"\xff"
TABLE = bytes(255 if c in BREAKS else 32 if c == 9 else c + 32 if 65 <= c <= 90 else c for c in range(256))
BITMAP_BITS = 1 << 24
HELD_ROWS = 1 << 19
SENT_ROWS = 1 << 15
BATCH_WORDS = 1 << 18
TASK_WORDS = 1 << 24
BLOCK_WORDS = 1 << 16
LONGEST_WINDOW = 64
CACHE_WORDS = 500_000
UNKNOWN = "und"

BASE, CHECK_BASE = 0x9E3779B97F4A7C15 | 1, 0xD6E8FEB86659FD93 | 1
MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15))
COLUMNS = ("key", "n", "row", "low", "high")


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * MIX[0]
    x = (x ^ (x >> np.uint64(27))) * MIX[1]
    return x ^ (x >> np.uint64(31))


class WordValues(dict):
    """A value of a word, never 0; 0 for the end of a piece. Kept by the worker up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[word] = value = 0 if word == MARK else xxhash.xxh64_intdigest(word) or 1
        return value


VALUES = WordValues()


def words_of(text: bytes) -> list[bytes]:
    """Words in lower case, with a mark where a piece ends."""
    return text.translate(TABLE).replace(MARK, b" \xff ").split()


@cache
def powers(base: int) -> tuple[np.ndarray, np.ndarray]:
    """base ** i and base ** -i modulo 2 ** 64, as far as a block and a window reach."""
    n = BLOCK_WORDS + LONGEST_WINDOW
    return tuple(np.cumprod(np.append(np.ones(1, np.uint64), np.full(n - 1, b, np.uint64))) for b in (base, pow(base, -1, 1 << 64)))


def windows(values: np.ndarray, n: int, base: int) -> np.ndarray:
    """Polynomials of all windows of n values: a difference of prefix sums of value * base ** -i, times a power.

    The sums start anew every BLOCK_WORDS windows, so that the powers are a table of fixed size.
    """
    up, down = powers(base)
    out = np.empty(max(0, len(values) - n + 1), np.uint64)
    for start in range(0, len(out), BLOCK_WORDS):
        block = values[start:start + BLOCK_WORDS + n - 1]
        sums = np.append(np.zeros(1, np.uint64), np.cumsum(block * down[:len(block)], dtype=np.uint64))
        count = len(block) - n + 1
        out[start:start + count] = (sums[n:] - sums[:count]) * up[n - 1:n - 1 + count]
    return out


class Batch:
    """The words of some documents as one array, with what each position belongs to."""

    def __init__(self, values: list[np.ndarray], tongues: list[int], rows: list[int], bits: int):
        self.lengths = [len(v) for v in values]
        lengths = np.array(self.lengths, np.int64) + 1
        zero = np.zeros(1, np.uint64)
        self.values = np.concatenate([x for v in values for x in (v, zero)]) if values else zero
        self.tongue = np.repeat(np.array(tongues, np.uint64), lengths) if values else zero
        self.row = np.repeat(np.array(rows, np.int64), lengths) if values else zero.astype(np.int64)
        self.bits = bits
        self.gaps = np.concatenate([[0], np.cumsum(self.values == 0)])

    def whole(self, n: int) -> np.ndarray:
        """Where a window of n words has no gap."""
        count = max(0, len(self.values) - n + 1)
        return self.gaps[n:n + count] == self.gaps[:count]

    def hashed(self, n: int, base: int) -> np.ndarray:
        """Polynomials of all windows, mixed with their language and length."""
        fingerprints = windows(self.values, n, base)
        return mixed(fingerprints + self.tongue[:len(fingerprints)] + np.uint64(n * int(MIX[2]) % (1 << 64)))

    def keys(self, n: int) -> np.ndarray:
        return (self.hashed(n, BASE) >> np.uint64(64 - self.bits)).view(np.int64)

    def checks(self, n: int) -> np.ndarray:
        return self.hashed(n, CHECK_BASE).view(np.int64)


def tongue_value(lang: str) -> int:
    return xxhash.xxh64_intdigest(lang.encode(), 7)


def in_bitmap(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = keys.view(np.uint64) & np.uint64(BITMAP_BITS - 1)
    return (bitmap[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1


def bitmap_of(counted: DataFrame) -> np.ndarray:
    """Bits of the keys of a table; at most BITMAP_BITS / 64 words come to the driver."""
    word = F.shiftright(F.col("key").bitwiseAND(BITMAP_BITS - 1), 6).alias("word")
    one = F.expr("shiftleft(1L, CAST(key & 63 AS INT))")
    found = counted.select(word, one.alias("one")).groupBy("word").agg(F.bit_or("one").alias("bits")).collect()
    bitmap = np.zeros(BITMAP_BITS // 64, np.int64)
    for r in found:
        bitmap[r.word] = r.bits
    return bitmap.view(np.uint64)


MERGED = {"n": np.add, "row": np.minimum, "low": np.minimum, "high": np.maximum}


def added(parts: list[tuple[np.ndarray, ...]], columns: tuple[str, ...]) -> tuple[np.ndarray, ...]:
    """Rows of equal keys as one."""
    whole = [np.concatenate(c) for c in zip(*parts, strict=True)]
    order = np.argsort(whole[0], kind="stable")
    key = whole[0][order]
    if not len(key):
        return tuple(whole)
    starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    return (key[starts], *(MERGED[c].reduceat(x[order], starts) for c, x in zip(columns[1:], whole[1:], strict=True)))


class Occurrences:
    """Adds up the occurrences that a task meets, and hands them on when it holds too many keys."""

    def __init__(self, columns: tuple[str, ...]):
        self.columns = columns
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.held = self.fresh = 0

    def add(self, batch: Batch, n: int, where: np.ndarray) -> None:
        at = np.flatnonzero(where)
        found = {"key": batch.keys(n)[at], "n": np.ones(len(at), np.int64)}
        if "row" in self.columns:
            found["row"] = batch.row[at]
            found["low"] = found["high"] = batch.checks(n)[at]
        self.parts.append(tuple(found[c] for c in self.columns))
        self.fresh += len(at)

    def batches(self, last: bool = False):
        if self.fresh > HELD_ROWS or (last and self.parts):
            whole = added(self.parts, self.columns)
            self.parts, self.held, self.fresh = [whole], len(whole[0]), 0
            if self.held > HELD_ROWS or last:
                self.parts, self.held = [], 0
                for i in range(0, len(whole[0]), SENT_ROWS):
                    yield pa.RecordBatch.from_arrays([pa.array(c[i:i + SENT_ROWS]) for c in whole], names=list(self.columns))


def prepared(docs: DataFrame, doc_id: str, text: str, lang: str) -> DataFrame:
    row = F.xxhash64(F.col(doc_id).cast("string"), F.col(text))
    return docs.select(row.alias("row"), F.coalesce(F.col(lang), F.lit(UNKNOWN)).alias("lang"), common.whole_text(text).cast("binary").alias("text"))


def text_values(column: pa.Array) -> Iterator[np.ndarray]:
    for text in column:
        words = words_of(text.as_py())
        yield np.fromiter(map(VALUES.__getitem__, words), np.uint64, len(words))


def encoded_values(column: pa.Array) -> Iterator[np.ndarray]:
    for words in column:
        yield np.frombuffer(words.as_py(), np.uint64)


def word_batches(rows: pa.RecordBatch, values_of, bits: int) -> Iterator[tuple[int, int, Batch]]:
    """(first row, end, batch) of rows(row, lang, words): some documents at a time, or one long one."""
    row, lang, column = rows.column(0).to_pylist(), rows.column(1).to_pylist(), rows.column(2)
    first, held, size = 0, [], 0
    for i, values in enumerate(values_of(column)):
        held.append(values)
        size += len(values)
        if size >= BATCH_WORDS or i + 1 == len(row):
            yield first, i + 1, Batch(held, [tongue_value(x) for x in lang[first:i + 1]], row[first:i + 1], bits)
            first, held, size = i + 1, [], 0


def possible(batch: Batch, n: int, shorter: np.ndarray | None, own: np.ndarray | None) -> np.ndarray:
    """Windows of n words without a gap that the bitmaps of the n-grams one word shorter, and of their own length, let pass."""
    where = batch.whole(n)
    if shorter is not None and len(where):
        inside = in_bitmap(shorter, batch.keys(n - 1))
        where = where & inside[:-1] & inside[1:]
    return where if own is None else where & in_bitmap(own, batch.keys(n))


def occurrences(rows: DataFrame, values_of, n: int, shorter: np.ndarray | None, own: np.ndarray | None, columns: tuple[str, ...], bits: int) -> DataFrame:
    """Partial rows of every task."""
    def run(batches):
        found = Occurrences(columns)
        for arrow in batches:
            for _, _, batch in word_batches(arrow, values_of, bits):
                found.add(batch, n, possible(batch, n, shorter, own))
                yield from found.batches()
        yield from found.batches(last=True)

    return common.map_arrow(rows, run, ", ".join(f"{c} long" for c in columns))


def frequent_keys(rows: DataFrame, values_of, n: int, shorter: np.ndarray | None, least: int, bits: int) -> np.ndarray:
    """Bitmap of the fingerprints with at least ``least`` occurrences; only fingerprints and counts are shuffled."""
    partial = occurrences(rows, values_of, n, shorter, None, ("key", "n"), bits)
    heavy = partial.groupBy("key").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
    return bitmap_of(common.written(heavy, f"heavy-{n}"))


def counted(tokens: DataFrame, n: int, own: np.ndarray, least: int, bits: int) -> DataFrame:
    """(key, n, row, low, high, size): n-grams with at least ``least`` occurrences, written."""
    partial = occurrences(tokens, encoded_values, n, None, own, COLUMNS, bits)
    sums = partial.groupBy("key").agg(F.sum("n").alias("n"), F.min("row").alias("row"), F.min("low").alias("low"), F.max("high").alias("high"))
    return common.written(sums.filter(F.col("n") >= least).withColumn("size", F.lit(n)), f"grams-{n}")


def encoded(rows: DataFrame, bitmap: np.ndarray, bits: int) -> DataFrame:
    """(row, lang, words, n_words), written: each document's word values, 0 where no frequent word can be."""
    def run(batches):
        for arrow in batches:
            for first, end, batch in word_batches(arrow, text_values, bits):
                held = np.where(in_bitmap(bitmap, batch.keys(1)), batch.values, np.uint64(0))
                out, counts, at = [], [], 0
                for length in batch.lengths:
                    out.append(held[at:at + length].tobytes())
                    counts.append(int(np.count_nonzero(batch.values[at:at + length])))
                    at += length + 1
                yield pa.RecordBatch.from_arrays([arrow.column(0)[first:end], arrow.column(1)[first:end], pa.array(out, pa.binary()), pa.array(counts, pa.int64())],
                                                 names=["row", "lang", "words", "n_words"])

    return common.written(common.map_arrow(rows, run, "row long, lang string, words binary, n_words long"), "encoded")


def pointed_phrases(rows: DataFrame, grams: DataFrame, longest: int, bits: int) -> DataFrame:
    """(key, low, lang, phrase): fingerprints read from the documents that they point to."""
    wanted = grams.groupBy("row").agg(F.collect_list("key").alias("wanted"))
    near = common.flagged(rows, grams, "row").filter("__maybe").drop("__maybe")

    def run(batches):
        for arrow in batches:
            keys, lows, langs, phrases = [], [], [], []
            for row, lang, text, want in zip(*(arrow.column(i).to_pylist() for i in range(4)), strict=True):
                words = words_of(text)
                batch = Batch([np.fromiter(map(VALUES.__getitem__, words), np.uint64, len(words))], [tongue_value(lang)], [row], bits)
                for n in range(1, min(longest, len(words)) + 1):
                    found, checks, whole = batch.keys(n), batch.checks(n), batch.whole(n)
                    hit = np.flatnonzero(whole & np.isin(found, np.array(want, np.int64)))
                    _, first = np.unique(np.stack([found[hit], checks[hit]]), axis=1, return_index=True)
                    for i in hit[first].tolist():
                        keys.append(int(found[i]))
                        lows.append(int(checks[i]))
                        langs.append(lang)
                        phrases.append(b" ".join(words[i:i + n]).decode())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(lows, pa.int64()), pa.array(langs, pa.string()), pa.array(phrases, pa.string())],
                                             names=["key", "low", "lang", "phrase"])

    joined = near.join(wanted, "row").select("row", "lang", "text", "wanted")
    return common.map_arrow(joined, run, "key long, low long, lang string, phrase string").dropDuplicates(["key", "low"])


def collided_phrases(rows: DataFrame, grams: DataFrame, longest: int, bits: int, least: int) -> DataFrame:
    """(lang, phrase, size, f): phrases whose fingerprints belong to several, counted by text."""
    bitmap = bitmap_of(grams)

    def run(batches):
        kinds = (pa.int64(), pa.string(), pa.string(), pa.int32(), pa.int64())
        for arrow in batches:
            langs = arrow.column(1).to_pylist()
            for first, end, batch in word_batches(arrow, text_values, bits):
                words = [w for text in arrow.column(2)[first:end].to_pylist() for w in (*words_of(text), MARK)]
                owner = np.repeat(np.arange(first, end), np.array(batch.lengths, np.int64) + 1)
                seen: Counter = Counter()
                for n in range(1, longest + 1):
                    keys = batch.keys(n)
                    for i in np.flatnonzero(batch.whole(n) & in_bitmap(bitmap, keys)).tolist():
                        seen[int(keys[i]), langs[owner[i]], b" ".join(words[i:i + n]).decode(), n] += 1
                columns = zip(*((*k, c) for k, c in seen.items()), strict=True) if seen else [[]] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["key", "lang", "phrase", "size", "f"])

    found = common.map_arrow(rows, run, "key long, lang string, phrase string, size int, f long")
    ours = found.join(grams.select("key", "size"), ["key", "size"], "left_semi")
    return ours.groupBy("lang", "phrase", "size").agg(F.sum("f").alias("f")).filter(F.col("f") >= least)


def frequent_phrases(docs: DataFrame, least: int = 100, longest: int = LONGEST, doc_id: str = "doc_id", text: str = "text",
                     lang: str = "lang", bits: int = 64) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, size, f) of all phrases of 1 to ``longest`` words, and (lang, n) of all words; both written."""
    rows = prepared(docs, doc_id, text, lang)
    frequent = frequent_keys(rows, text_values, 1, None, least, bits)
    tokens = encoded(rows, frequent, bits)
    totals = common.written(tokens.groupBy("lang").agg(F.sum("n_words").alias("n")), "totals")
    words = totals.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    tokens = tokens.coalesce(max(docs.sparkSession.sparkContext.defaultParallelism, words // TASK_WORDS))
    levels = [counted(tokens, 1, frequent, least, bits)]
    for n in range(2, longest + 1):
        frequent = frequent_keys(tokens, encoded_values, n, frequent, least, bits)
        levels.append(counted(tokens, n, frequent, least, bits))
    grams = common.written(reduce(DataFrame.unionByName, levels), "grams")
    pure, mixed_up = grams.filter("low = high"), grams.filter("low <> high")
    texts = pure.join(pointed_phrases(rows, pure, longest, bits), ["key", "low"]).select("lang", "phrase", "size", F.col("n").alias("f"))
    if not mixed_up.isEmpty():
        texts = texts.unionByName(collided_phrases(rows, common.written(mixed_up, "collided"), longest, bits, least))
    return common.written(texts, "phrases"), totals


def part(words: Column, start, length) -> Column:
    return F.array_join(F.slice(words, start, length), " ")


def inside_longer(candidates: DataFrame) -> DataFrame:
    """(lang, phrase, longer): the count of the most frequent candidate that holds a phrase of two words or more."""
    words = F.split("phrase", " ")
    starts = F.explode(F.flatten(F.transform(F.sequence(F.lit(2), F.col("size") - 1), lambda m: F.transform(
        F.sequence(F.lit(1), F.col("size") - m + 1), lambda i: F.struct(i.alias("i"), m.alias("m")))))).alias("at")
    held = candidates.filter("size > 2").select("lang", "f", words.alias("words"), starts)
    return held.groupBy("lang", part(F.col("words"), F.col("at.i"), F.col("at.m")).alias("phrase")).agg(F.max("f").alias("longer"))


def collocations(docs: DataFrame, least: int = 100, longest: int = LONGEST, top: int = 2000, held_percent: int = 100, factor: int = 1000,
                 doc_id: str = "doc_id", text: str = "text", lang: str = "lang", bits: int = 64) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first ``top`` phrases of every language."""
    grams, totals = frequent_phrases(docs, least, longest, doc_id, text, lang, bits)
    candidates = grams.filter("size > 1")
    cuts = candidates.select("lang", "phrase", F.col("f").alias("a"), F.split("phrase", " ").alias("words"), "size",
                             F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", part(F.col("words"), 1, F.col("k")).alias("first"),
                       part(F.col("words"), F.col("k") + 1, F.col("size") - F.col("k")).alias("rest"))
    left = grams.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    right = grams.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    exact = "decimal(19,0)"
    score = F.expr(f"((CAST({factor} * a AS {exact}) * CAST(n AS {exact})) div (CAST(l AS {exact}) * CAST(r AS {exact})))")
    valued = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"]).join(totals, "lang").withColumn("score", score)
    least_cut = F.min(F.struct("score", "k", "l", "r")).alias("cut")
    scored = valued.groupBy("lang", "phrase", "a", "n").agg(least_cut).select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    kept = (scored.join(inside_longer(candidates), ["lang", "phrase"], "left")
            .filter(F.col("longer").isNull() | (100 * F.col("longer") < held_percent * F.col("a"))))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
