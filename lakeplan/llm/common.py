"""Helpers shared by the operators: reading, bounded Arrow batches, written stages, labelled samples."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeplan.session import checkpoint_table

BATCH_ROWS = 500
SPACE = r"[\x20\x09-\x0D]+"


def tokenizer_file(name: str) -> str:
    """Path of an installed public vocabulary; resolved where it is used, as executors have their own disks."""
    import public_tokenizers

    return public_tokenizers.path(name)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def whole_text(text: str = "text") -> F.Column:
    return F.coalesce(F.col(text), F.lit(""))


def crc_fold(doc_id: str = "doc_id", folds: int = 5) -> F.Column:
    """crc32 of the id as text, modulo the number of folds."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(folds))


def map_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``mapInArrow`` with batches of at most BATCH_ROWS rows, so that long texts cannot fill a worker's memory."""
    conf = df.sparkSession.conf
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(conf.get(key, "10000")) not in range(1, BATCH_ROWS + 1):
        conf.set(key, str(BATCH_ROWS))
    return df.mapInArrow(fn, schema)


def per_row(make: Callable[[], Callable[[list], dict[str, list]]], inputs: list[str], schema: dict[str, pa.DataType]):
    """A mapInArrow function: ``make()`` once per task gives a function from input columns to output columns."""
    def run(batches):
        score = make()
        target = pa.schema(list(schema.items()))
        for batch in batches:
            got = score(*[batch.column(batch.schema.get_field_index(c)) for c in inputs])
            yield pa.RecordBatch.from_arrays([pa.array(got[c], type=t) for c, t in schema.items()], schema=target)
    return run


def bounded_sample(labelled: DataFrame, bound: int, key: str = "doc_id") -> DataFrame:
    """At most ``bound`` rows, chosen by the hash of their key: the same rows wherever they are stored."""
    return labelled.orderBy(F.xxhash64(F.col(key)), F.col(key)).limit(bound)


def one_text_each(docs: DataFrame, picked: DataFrame, keys: list[str]) -> DataFrame:
    """``picked`` with the text of its rows in ``docs``; of several texts under one key the one with the smallest hash.

    So a sample of keys is a sample of as many rows. Copies of a key are reduced before they are shuffled.
    """
    found = docs.join(F.broadcast(picked), keys).select(*picked.columns, "text")
    return found.groupBy(*picked.columns).agg(F.min_by("text", F.xxhash64("text")).alias("text"))


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, label: str) -> DataFrame:
    """Write a stage to the shared folder and read it back.

    Its shuffle files go once it is written, and not only when the driver happens to collect its garbage: the disk of an
    operator is that of its stages and of one shuffle, whatever ran before.
    """
    conf = df.sparkSession.conf
    before = conf.get(SHUFFLE_CLEANUP, None)
    conf.set(SHUFFLE_CLEANUP, "true")
    try:
        return checkpoint_table(df, f"llm-{label}")
    finally:
        conf.unset(SHUFFLE_CLEANUP) if before is None else conf.set(SHUFFLE_CLEANUP, before)


def worker_threads() -> None:
    """Keep native libraries inside a task on one thread."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"


def train_once(rows: DataFrame, train: Callable[[list[pa.RecordBatch]], bytes]) -> bytes:
    """Fit a model on a bounded sample in one task; only the model comes back."""
    def run(batches):
        yield pa.RecordBatch.from_arrays([pa.array([train(list(batches))], pa.binary())], names=["model"])

    made = map_arrow(rows.repartition(1), run, "model binary").collect()
    return bytes(made[0].model) if made else train([])


def labelled_rows(docs: DataFrame, marks: DataFrame, label: str, per_class: int, folds: int = 5) -> tuple[DataFrame, dict[int, int]]:
    """Texts of at most ``per_class`` training rows of each label value, and the counts of all training rows by value.

    Rows whose fold is 0 are held out. ``docs`` and ``marks`` share doc_id; ids and labels are sampled, then joined to one text
    each, so that a repeated id does not exceed the bound.
    """
    known = (marks.filter(F.col(label).isin(0, 1)).filter(crc_fold(folds=folds) != 0)
             .select("doc_id", F.col(label).cast("int").alias("label")).distinct())
    counts = {r.label: r.n for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    parts = [bounded_sample(known.filter(F.col("label") == v), per_class) for v in (0, 1)]
    picked = parts[0].unionByName(parts[1])
    return one_text_each(docs, picked, ["doc_id"]), counts


def logistic(x, y, weight, steps: int = 50, ridge: float = 1e-3):
    """Weighted logistic regression by Newton steps; x has the constant column first."""
    import numpy as np

    beta = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (weight * (y - p)) - ridge * beta
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(beta))
        step = np.linalg.solve(hessian, gradient)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return beta


BITMAP_BITS = 1 << 23


def bitmap(ids: DataFrame, key: str) -> DataFrame:
    """(word, bits): a bitmap of fixed size over the hashes of ``ids``; at most BITMAP_BITS / 64 rows, so it may be broadcast."""
    at = F.pmod(F.xxhash64(key), F.lit(BITMAP_BITS))
    one = F.expr(f"shiftleft(1L, CAST(pmod(xxhash64({key}), {BITMAP_BITS}) % 64 AS INT))")
    return ids.select(F.floor(at / 64).cast("int").alias("__word"), one.alias("one")).groupBy("__word").agg(F.bit_or("one").alias("__bits"))


def flagged(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """``df`` with __maybe: false only where ``key`` is certainly not in ``ids``; spares rows a shuffle, decides nothing."""
    at = f"pmod(xxhash64({key}), {BITMAP_BITS})"
    known = df.withColumn("__word", F.expr(f"CAST(floor({at} / 64) AS INT)")).join(F.broadcast(bitmap(ids, key)), "__word", "left")
    hit = F.expr(f"coalesce((shiftrightunsigned(__bits, CAST({at} % 64 AS INT)) & 1) = 1, false)")
    return known.withColumn("__maybe", hit).drop("__word", "__bits")


def maybe_in(ids: DataFrame, key: str) -> F.Column:
    """A condition on ``key``: false only where it is certainly not in ``ids``. The bitmap, of fixed size, is one scalar: no join."""
    words = [0] * (BITMAP_BITS // 64)
    for r in bitmap(ids, key).collect():
        words[r["__word"]] = r["__bits"]
    held = ids.sparkSession.createDataFrame([(words,)], "bits array<bigint>").select("bits").scalar()
    at = f"pmod(xxhash64({key}), {BITMAP_BITS})"
    word = F.get(held, F.expr(f"CAST(floor({at} / 64) AS INT)"))
    return F.expr(f"shiftleft(1L, CAST({at} % 64 AS INT))").bitwiseAND(word) != 0


def without(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose ``key`` is not in ``ids``(key); only rows that the bitmap cannot clear are shuffled."""
    known = flagged(df, ids, key)
    rest = known.filter("__maybe").join(ids.select(key).distinct(), key, "left_anti")
    return known.filter("NOT __maybe").unionByName(rest).select(*[F.col(f"`{c}`") for c in df.columns])


def append_columns(df: DataFrame, make: Callable[[], Callable[[list], dict[str, list]]], inputs: list[str], added: dict[str, tuple[pa.DataType, str]]) -> DataFrame:
    """``df`` with further columns computed by ``make()`` once per task from ``inputs``; its own columns pass through."""
    kept = df.columns

    def run(batches):
        score = make()
        for batch in batches:
            got = score(*[batch.column(kept.index(c)) for c in inputs])
            arrays = [*batch.columns, *(pa.array(got[c], type=t) for c, (t, _) in added.items())]
            yield pa.RecordBatch.from_arrays(arrays, names=[*kept, *added])

    schema = T.StructType([*df.schema.fields, *(T.StructField(c, T._parse_datatype_string(kind)) for c, (_, kind) in added.items())])
    return map_arrow(df, run, schema)
