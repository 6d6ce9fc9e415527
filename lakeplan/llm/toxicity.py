"""Toxicity by a factorization machine over hashed terms.

Terms are the lower-cased words of a text and the first letters of each word (for inflected insults), hashed to a fixed
range. The machine adds to a linear model the products of pairs of terms through short factor vectors, so that two terms
which are harmless alone can be toxic together. It is trained on at most PER_CLASS labelled rows of each kind
that are not held out; one part in five of them is left for the calibration of scores to the label's true frequency.

Defined results: NULL, empty and wordless texts have no terms and the score of the bias alone; repeated ids are scored row
by row; without labels of both kinds every score is the share of label 1. Labels, lang, source and id are no inputs.
"""

from __future__ import annotations

import pickle
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeplan.llm import common

PER_CLASS = 6_000
HASH_BITS = 22
PREFIXES = (4, 5, 6)
LEAST_DOCUMENTS = 4
FACTORS = 4
EPOCHS = 8
BATCH = 16
RATE = 0.1
SPARSITY = 0.18  # times the root of the number of training rows
DECAY = 0.1
THRESHOLD = 0.5
CACHE_WORDS = 400_000

WORD = re.compile(r"[^\W\d_]+")


class Terms:
    """Hashed terms of texts; the terms of each word are kept by the worker up to a bound."""

    def __init__(self, bits: int = HASH_BITS, bound: int = CACHE_WORDS):
        self.mask, self.bound = (1 << bits) - 1, bound
        self.clear()

    def clear(self) -> None:
        self.place: dict[str, int] = {}
        self.rows = np.zeros((1024, 1 + len(PREFIXES)), dtype=np.int32)

    def hash(self, term: str) -> int:
        return xxhash.xxh64_intdigest(term.encode()) & self.mask

    def add(self, word: str) -> int:
        at = len(self.place)
        if at == len(self.rows):
            self.rows = np.vstack([self.rows, np.zeros_like(self.rows)])
        whole = self.hash(f"={word}")
        self.rows[at] = [whole] + [self.hash(f"{n}{word[:n]}") if len(word) > n else whole for n in PREFIXES]
        self.place[word] = at
        return at

    def of(self, text: str) -> np.ndarray:
        """Distinct term hashes of a text."""
        words = set(WORD.findall(text.lower()))
        if len(self.place) + len(words) > self.bound:
            self.clear()
        get, add = self.place.get, self.add
        at = [i if (i := get(w)) is not None else add(w) for w in words]
        return np.unique(self.rows[at])


class Machine:
    """Factorization machine on sets of terms; only terms seen in training have parameters."""

    def __init__(self, terms: np.ndarray, factors: int = FACTORS, seed: int = 7):
        self.terms = terms
        self.bias = 0.0
        self.w = np.zeros(len(terms) + 1, dtype=np.float32)
        self.v = np.random.default_rng(seed).normal(0, 0.01, (len(terms) + 1, factors)).astype(np.float32)
        self.v[-1] = 0
        self.calibration = (0.0, 1.0)

    def known(self, hashes: np.ndarray) -> np.ndarray:
        """Positions of the known terms."""
        if not len(self.terms):
            return np.zeros(0, dtype=np.int64)
        at = np.searchsorted(self.terms, hashes)
        at[at == len(self.terms)] = 0
        return at[self.terms[at] == hashes]

    def margins(self, at: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Raw scores and factor sums of documents; ``at`` holds their terms one after the other, none empty."""
        v = self.v[at]
        sums = np.add.reduceat(v, starts)
        squares = np.add.reduceat((v * v).sum(1), starts)
        return self.bias + np.add.reduceat(self.w[at], starts) + 0.5 * ((sums * sums).sum(1) - squares), sums

    def margin(self, at: np.ndarray) -> float:
        return float(self.margins(at, np.zeros(1, np.int64))[0][0]) if len(at) else float(self.bias)

    def train(self, docs: list[np.ndarray], y: np.ndarray, weight: np.ndarray, epochs: int = EPOCHS, seed: int = 11) -> None:
        rng = np.random.default_rng(seed)
        sparsity = SPARSITY * np.sqrt(len(docs))
        z, n, gv = np.zeros(len(self.w)), np.zeros(len(self.w)), np.full_like(self.v, 1e-2)
        zb = nb = 0.0
        docs = [d if len(d) else np.array([len(self.terms)]) for d in docs]
        for _ in range(epochs):
            order = rng.permutation(len(docs))
            for i in range(0, len(order), BATCH):
                pick = order[i:i + BATCH]
                at = np.concatenate([docs[j] for j in pick])
                sizes = np.array([len(docs[j]) for j in pick])
                starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
                margin, sums = self.margins(at, starts)
                error = weight[pick] * (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - y[pick])
                each = np.repeat(error, sizes)
                terms, inverse = np.unique(at, return_inverse=True)
                g = np.bincount(inverse, each, len(terms))
                grown = np.sqrt(n[terms] + g * g)
                z[terms] += g - (grown - np.sqrt(n[terms])) / RATE * self.w[terms]
                n[terms] += g * g
                shrunk = np.sign(z[terms]) * np.maximum(np.abs(z[terms]) - sparsity, 0)
                self.w[terms] = -shrunk / ((1 + np.sqrt(n[terms])) / RATE + DECAY)
                active = self.w[at] != 0
                if active.any():
                    used, slot = np.unique(at[active], return_inverse=True)
                    pair = (each[:, None] * (np.repeat(sums, sizes, axis=0) - self.v[at]))[active]
                    dv = np.column_stack([np.bincount(slot, pair[:, f], len(used)) for f in range(pair.shape[1])]) + 1e-3 * self.v[used]
                    gv[used] += dv * dv
                    self.v[used] -= (0.3 * RATE * dv / np.sqrt(gv[used])).astype(np.float32)
                self.w[-1] = 0
                g = float(error.sum())
                grown = np.sqrt(nb + g * g)
                zb += g - (grown - np.sqrt(nb)) / RATE * self.bias
                nb += g * g
                self.bias = -zb * RATE / (1 + np.sqrt(nb))
        self.v[self.w == 0] = 0

    def probability(self, margin: np.ndarray) -> np.ndarray:
        a, b = self.calibration
        return 1 / (1 + np.exp(-np.clip(a + b * margin, -30, 30)))


def fit(rows: list[tuple[int, int, list[int]]], counts: dict[int, int]) -> bytes:
    """A pickled machine from (doc_id, label, terms) rows."""
    rows = sorted(rows, key=lambda r: (r[0], r[1]))
    seen = {r[1] for r in rows}
    if seen != {0, 1}:
        machine = Machine(np.zeros(0, np.int32))
        share = counts.get(1, 0) / max(1, sum(counts.values()))
        machine.bias = float(np.log((share + 1e-6) / (1 - share + 1e-6)))
        return pickle.dumps(machine)
    y = np.array([r[1] for r in rows], dtype=np.float32)
    hashes = [np.asarray(r[2], dtype=np.int32) for r in rows]
    terms, n = np.unique(np.concatenate(hashes), return_counts=True)
    machine = Machine(terms[n >= LEAST_DOCUMENTS])
    docs = [machine.known(h) for h in hashes]
    weight = np.where(y == 1, counts[1] / (y == 1).sum(), counts[0] / (y == 0).sum())
    weight = (weight / weight.mean()).astype(np.float32)
    rest = np.arange(len(rows)) % 5 == 0
    learn = ~rest if len(set(y[rest])) == 2 and len(set(y[~rest])) == 2 else np.ones(len(rows), bool)
    check = rest if learn.sum() < len(rows) else learn
    machine.train([d for d, k in zip(docs, learn, strict=True) if k], y[learn], weight[learn])
    margin = np.array([machine.margin(d) for d, k in zip(docs, check, strict=True) if k])
    a, b = common.logistic(np.column_stack([np.ones_like(margin), margin]), y[check].astype(float), weight[check].astype(float), ridge=0.05)
    machine.calibration = (float(a), float(max(b, 1e-3)))
    return pickle.dumps(machine)


def with_score(docs: DataFrame, marks: DataFrame, column: str, label: str = "toxic", per_class: int = PER_CLASS) -> DataFrame:
    """``docs`` with its toxicity score as a further column."""
    sample, counts = common.labelled_rows(docs.select("doc_id", "text"), marks, label, per_class)

    def hashed():
        terms = Terms()
        return lambda ids, y, texts: {"doc_id": ids, "label": y, "terms": [terms.of(t or "") for t in texts.to_pylist()]}

    kinds = {"doc_id": pa.int64(), "label": pa.int32(), "terms": pa.list_(pa.int32())}
    sample = common.map_arrow(sample.select(F.col("doc_id").cast("long").alias("doc_id"), "label", "text"),
                              common.per_row(hashed, ["doc_id", "label", "text"], kinds), "doc_id long, label int, terms array<int>")

    def train(batches):
        return fit([(i, y, x.values.to_numpy() if x.is_valid else []) for b in batches
                    for i, y, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True)], counts)

    model = docs.sparkSession.sparkContext.broadcast(common.train_once(sample, train))

    def make():
        machine, terms = pickle.loads(model.value), Terms()
        return lambda texts: {column: machine.probability(np.array([machine.margin(machine.known(terms.of(t or ""))) for t in texts.to_pylist()]))}

    return common.append_columns(docs, make, ["text"], {column: (pa.float64(), "double")})


def scores(docs: DataFrame, marks: DataFrame, label: str = "toxic", threshold: float = THRESHOLD, per_class: int = PER_CLASS) -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row of ``docs``."""
    scored = with_score(docs.select("doc_id", "text"), marks, "score", label, per_class)
    return scored.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(common.crc_fold() == 0, F.lit(False)).alias("held_out"),
                         "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
