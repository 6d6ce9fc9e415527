"""Language identification: sparse multinomial logistic regression on TF-IDF weights of character n-grams.

N-grams of one to three characters of the lower-cased letters and spaces are hashed to a fixed range, weighted by inverse
document frequency and scaled to unit length. One weight vector per language follows the regularised leader (FTRL-Proximal)
with an elastic-net penalty, whose L1 part leaves most weights zero. A temperature, fitted on rows that the weights have
not seen, turns the logits into calibrated probabilities. The model is fitted on at most SAMPLE_ROWS rows with a language
that are not held out, the first LEAST_PER_LANGUAGE of each language before any other; every row is predicted from its
whole text.

Defined results: NULL texts and texts without a letter are `und` with score 0; without any training row all are; a single
training language is predicted with score 1. Ties between languages go to the alphabetically first. Repeated ids are
predicted row by row, and learnt from by one text per id and language. Lang, source and id are no inputs of a prediction.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeplan.llm import common

SAMPLE_ROWS = 8_000
LEAST_PER_LANGUAGE = 200
HASH_BITS = 15
EPOCHS = 2
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.3, 0.1
FOLDS, HELD_OUT = 4, 2
UNKNOWN = "und"
SPACE_CODE = 32


def letter_codes(text: str) -> np.ndarray:
    """Code points of the lower-cased text with every run of other characters as one space; empty without letters."""
    kept = "".join(c if c.isalpha() else " " for c in text.lower()) if not text.isascii() else ascii_letters(text)
    words = kept.split()
    return np.frombuffer(f" {' '.join(words)} ".encode("utf-32-le"), dtype=np.uint32) if words else np.zeros(0, np.uint32)


ASCII = "".join(chr(c).lower() if chr(c).isalpha() else " " for c in range(128))


def ascii_letters(text: str) -> str:
    return text.translate(ASCII)


def gram_counts(text: str, bits: int = HASH_BITS) -> np.ndarray | None:
    """Counts of the hashed n-grams, or None for a text without letters."""
    codes = letter_codes(text).astype(np.uint64)
    if not len(codes):
        return None
    size, total = 1 << bits, None
    rolled = np.zeros(len(codes), np.uint64)
    for n in (1, 2, 3):
        if len(codes) < n:
            break
        rolled = rolled[:len(codes) - n + 1] * np.uint64(0x9E3779B97F4A7C15) + codes[n - 1:] + np.uint64(n)
        mixed = (rolled ^ (rolled >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        counts = np.bincount((mixed >> np.uint64(64 - bits)).astype(np.int64), minlength=size)
        total = counts if total is None else total + counts
    return total


def unit(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = counts * idf
    return x / max(1e-12, np.sqrt(x @ x))


def softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def follow_the_leader(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, classes: int, size: int, epochs: int = EPOCHS) -> np.ndarray:
    """Weights [classes, size + 1] after FTRL-Proximal passes over sparse rows (positions, values); the last column is the bias."""
    z, n = np.zeros((classes, size + 1)), np.zeros((classes, size + 1))

    def weights(at):
        zs = z[:, at]
        return -np.sign(zs) * np.maximum(np.abs(zs) - L1, 0) / ((BETA + np.sqrt(n[:, at])) / ALPHA + L2)

    rng = np.random.default_rng(3)
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            at, x = rows[i]
            at, x = np.append(at, size), np.append(x, 1.0)
            w = weights(at)
            p = softmax(w @ x)
            p[y[i]] -= 1
            g = p[:, None] * x
            grown = np.sqrt(n[:, at] + g * g)
            z[:, at] += g - (grown - np.sqrt(n[:, at])) / ALPHA * w
            n[:, at] += g * g
    return weights(np.arange(size + 1))


def temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature with the least log loss on unseen rows, from a grid."""
    grid = np.geomspace(0.05, 5, 60)
    loss = [-np.log(softmax(logits / t)[np.arange(len(y)), y] + 1e-12).mean() + 1e-4 * np.log(t) ** 2 for t in grid]
    return float(grid[int(np.argmin(loss))])


def fit(rows: list[tuple[int, str, np.ndarray, np.ndarray]], bits: int = HASH_BITS) -> bytes:
    """Pickled {languages, idf, weights, temperature} from (doc_id, lang, positions, counts) rows."""
    rows = sorted(rows, key=lambda r: (r[0], r[1]))
    languages, size = sorted({r[1] for r in rows}), 1 << bits
    if not rows:
        return pickle.dumps({"languages": []})
    df = np.zeros(size)
    for r in rows:
        df[r[2]] += 1
    idf = np.log((1 + len(rows)) / (1 + df)) + 0.1
    scaled = []
    for _, _, at, counts in rows:
        x = counts * idf[at]
        scaled.append((at, x / max(1e-12, np.sqrt(x @ x))))
    y = np.array([languages.index(r[1]) for r in rows])
    unseen = np.arange(len(rows)) % 10 == 0 if len(rows) >= 20 else np.zeros(len(rows), bool)
    weights = follow_the_leader([s for s, u in zip(scaled, unseen, strict=True) if not u], y[~unseen], len(languages), size)
    check = unseen if unseen.any() else ~unseen
    logits = np.array([weights[:, a] @ x + weights[:, -1] for (a, x), u in zip(scaled, check, strict=True) if u])
    return pickle.dumps({"languages": languages, "idf": idf, "weights": weights, "temperature": temperature(logits, y[check])})


class Predictor:
    def __init__(self, model: dict):
        self.model = model

    def __call__(self, text: str | None) -> tuple[str, float]:
        counts = gram_counts(text or "")
        if counts is None or not self.model["languages"]:
            return UNKNOWN, 0.0
        w = self.model["weights"]
        p = softmax((w[:, :-1] @ unit(counts, self.model["idf"]) + w[:, -1]) / self.model["temperature"])
        best = int(np.argmax(p))
        return self.model["languages"][best], float(p[best])


def training_ids(known: DataFrame, sample_rows: int = SAMPLE_ROWS, least: int = LEAST_PER_LANGUAGE) -> DataFrame:
    """At most ``sample_rows`` distinct (doc_id, lang), by the hash of the id; up to ``least`` of every language go first.

    Each place is given to all languages before the next, so a language is absent only if there are more than ``sample_rows``.
    """
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    place = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    placed = known.select("doc_id", "lang").distinct().withColumn("place", place).filter(F.col("place") <= sample_rows)
    return placed.orderBy(F.least("place", F.lit(least + 1)), *order, "lang").limit(sample_rows).select("doc_id", "lang")


def train(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> bytes:
    """Fit on a bounded sample of docs(doc_id, lang, text)."""
    known = docs.filter(F.col("lang").isNotNull() & (common.crc_fold(folds=FOLDS) != HELD_OUT))
    picked = common.one_text_each(known, training_ids(known, sample_rows), ["doc_id", "lang"]).withColumn("doc_id", F.col("doc_id").cast("long"))

    def counted():
        def score(ids, langs, texts):
            found = [(gram_counts(t or ""), i, y) for t, i, y in zip(texts.to_pylist(), ids.to_pylist(), langs.to_pylist(), strict=True)]
            found = [(c, np.flatnonzero(c), i, y) for c, i, y in found if c is not None]
            return {"doc_id": [i for _, _, i, _ in found], "lang": [y for *_, y in found],
                    "at": [at for _, at, _, _ in found], "n": [c[at] for c, at, _, _ in found]}
        return score

    kinds = {"doc_id": pa.int64(), "lang": pa.string(), "at": pa.list_(pa.int32()), "n": pa.list_(pa.int32())}
    counts = common.map_arrow(picked, common.per_row(counted, ["doc_id", "lang", "text"], kinds),
                              "doc_id long, lang string, at array<int>, n array<int>")

    def learn(batches):
        return fit([(i, y, at.values.to_numpy(), n.values.to_numpy()) for b in batches
                    for i, y, at, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), b.column(3), strict=True)])

    return common.train_once(counts, learn)


def with_language(docs: DataFrame, lang_column: str, score_column: str, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``docs`` with the predicted language and its score as further columns."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs.select("doc_id", "lang", "text"), sample_rows))

    def make():
        predict = Predictor(pickle.loads(model.value))

        def score(texts):
            found = [predict(t) for t in texts.to_pylist()]
            return {lang_column: [f[0] for f in found], score_column: [f[1] for f in found]}
        return score

    return common.append_columns(docs, make, ["text"], {lang_column: (pa.string(), "string"), score_column: (pa.float64(), "double")})


def predictions(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for each row of docs(doc_id, lang, text)."""
    held = F.coalesce(common.crc_fold(folds=FOLDS) == HELD_OUT, F.lit(False)).alias("held_out")
    scored = with_language(docs.select("doc_id", "lang", "text"), "lang_pred", "score", sample_rows)
    return scored.select(F.col("doc_id").cast("long").alias("doc_id"), held, "lang_pred", "score")
