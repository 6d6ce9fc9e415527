"""Quality by compression: which of two dictionaries, built from good and from bad text, compresses a text better.

The text is cut into blocks, so that the dictionaries and not the text's own repetitions decide; each block is compressed
with both dictionaries and the sizes are summed over the whole text. The normalised difference of the sums, with the
density (good size per byte, which is tiny for text that repeats itself), is mapped to a probability by a logistic
calibration on labelled rows that neither dictionary has seen, weighted to the label's true frequency. Models are fitted on at most PER_CLASS rows of each label; every row is scored.

Defined results: NULL and empty texts have difference 0, a typical density and the score that follows; repeated ids are scored row by
row; without labels of both kinds every score is the share of label 1 (1 if there are none). Labels, lang, source and id
are no inputs.
"""

from __future__ import annotations

import math
import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeplan.llm import common

PER_CLASS = 3_000
DICTIONARY_BYTES = 112_640
BLOCK_BYTES = 2_048
LEVEL = 3
THRESHOLD = 0.3
TYPICAL_DENSITY = -1.0


def blocks(text: str) -> list[bytes]:
    data = text.encode()
    return [data[i:i + BLOCK_BYTES] for i in range(0, len(data), BLOCK_BYTES)]


def dictionary(texts: list[str]) -> bytes:
    """A trained dictionary, or the samples themselves where there are too few to train one."""
    import zstandard

    samples = [b for t in texts for b in blocks(t)]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, level=LEVEL, k=64, d=8).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICTIONARY_BYTES:]


def compressors(dictionaries: tuple[bytes, bytes]) -> list:
    import zstandard

    made = []
    for data in dictionaries:
        shared = zstandard.ZstdCompressionDict(data)
        shared.precompute_compress(level=LEVEL)
        made.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=shared, write_checksum=False, write_content_size=False, write_dict_id=False))
    return made


def measures(text: str, good_bad: list) -> tuple[float, float]:
    """(bad size - good size) / (bad size + good size) over the blocks of a text, and log(good size / bytes)."""
    parts = blocks(text)
    good, bad = (sum(len(c.compress(b)) for b in parts) for c in good_bad)
    return ((bad - good) / (bad + good), math.log(good / sum(map(len, parts)))) if parts else (0.0, TYPICAL_DENSITY)


def design(d: np.ndarray) -> np.ndarray:
    """Columns of the calibration for rows of measures; densities far from text's are cut off."""
    return np.column_stack([np.ones(len(d)), 10 * d[:, 0], np.clip(d[:, 1] - TYPICAL_DENSITY, -2, 1)])


def fit(rows: list[tuple[int, int, str]], counts: dict[int, int]) -> bytes:
    """Pickled {dictionaries, beta} from (doc_id, label, text) rows; alternate rows build and calibrate."""
    rows = sorted(rows, key=lambda r: (r[1], r[0], r[2]))
    build = {v: [t for i, (_, y, t) in enumerate(rows) if y == v and i % 2 == 0] for v in (0, 1)}
    if not any(build[0]) or not any(build[1]):
        share = counts.get(1, 0) / max(1, sum(counts.values())) if counts else 1.0
        return pickle.dumps({"share": share})
    dictionaries = (dictionary(build[1]), dictionary(build[0]))
    pair = compressors(dictionaries)
    rest = [(y, measures(t, pair)) for i, (_, y, t) in enumerate(rows) if i % 2]
    y, d = np.array([r[0] for r in rest], float), np.array([r[1] for r in rest], float).reshape(-1, 2)
    weight = np.where(y == 1, counts[1] / max(1, (y == 1).sum()), counts[0] / max(1, (y == 0).sum()))
    beta = common.logistic(design(d), y, weight / weight.mean())
    return pickle.dumps({"dictionaries": dictionaries, "beta": beta})


def scores(docs: DataFrame, marks: DataFrame, label: str = "quality", threshold: float = THRESHOLD, per_class: int = PER_CLASS) -> DataFrame:
    """(doc_id, held_out, score, predicted, difference) for each row of ``docs``."""
    sample, counts = common.labelled_rows(docs.select("doc_id", common.whole_text().alias("text")), marks, label, per_class)

    def train(batches):
        return fit([r for b in batches for r in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True)], counts)

    model = docs.sparkSession.sparkContext.broadcast(common.train_once(sample, train))

    def make():
        fitted = pickle.loads(model.value)
        pair = compressors(fitted["dictionaries"]) if "beta" in fitted else None

        def score(ids, held, texts):
            values = [t or "" for t in texts.to_pylist()]
            d = np.array([measures(t, pair) for t in values] if pair else np.zeros((len(values), 2))).reshape(-1, 2)
            if pair:
                p = 1 / (1 + np.exp(-np.clip(design(d) @ fitted["beta"], -30, 30)))
            else:
                p = np.full(len(values), fitted["share"])
            return {"doc_id": ids, "held_out": held, "score": p, "predicted": (p >= threshold).astype("int32"), "difference": d[:, 0]}
        return score

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(common.crc_fold() == 0, F.lit(False)).alias("held_out"), "text")
    kinds = {"doc_id": pa.int64(), "held_out": pa.bool_(), "score": pa.float64(), "predicted": pa.int32(), "difference": pa.float64()}
    return common.map_arrow(rows, common.per_row(make, ["doc_id", "held_out", "text"], kinds),
                            "doc_id long, held_out boolean, score double, predicted int, difference double")
