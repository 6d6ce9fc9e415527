"""Fingerprints against exact Jaccard similarity, and the order of documents against a plain sort."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeplan.llm import fingerprints
from tests.llm import cases


def shingles(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text.lower()) if w]
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def expected(rows):
    """(doc_id, n_chars, edited) and the next text, in descending id order; NULL ids last."""
    order = sorted(rows, key=lambda r: (-(r[0] if r[0] is not None else -(1 << 63)), r[1]))
    for k, (i, t) in enumerate(order):
        after = order[(k + 1) % len(order)][1]
        half = len(t) // 2
        yield i, t, t[:len(t) - half] + after[:half], after


@pytest.mark.parametrize("n", [1, 2, 700])
def test_edits_and_likeness(spark, n):
    rng = random.Random(n)
    ids = rng.sample(range(-500, 100_000, 7), n) if n < 700 else [i * i * 3 for i in range(n - 1)] + [10 ** 15]
    texts = [cases.sentence(rng, rng.choice([0, 1, 4, 5, 9, 60, 300, 900])) + rng.choice(["", " É", "🙂"]) for _ in ids]
    docs = spark.createDataFrame(list(zip(ids, texts, strict=True)), "doc_id long, text string").repartition(4)
    got = {r.doc_id: r for r in fingerprints.fingerprints(docs).collect()}
    errors = []
    for i, text, edited, after in expected(list(zip(ids, texts, strict=True))):
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        for value, other in ((r.near_edited, edited), (r.near_next, after)):
            assert 0 <= value <= 1
            errors.append(value - jaccard(shingles(text), shingles(other)))
            assert text.lower().split() != other.lower().split() or value == 1
    if n > 100:
        assert np.abs(errors).max() < 0.2 and np.abs(errors).mean() < 0.03 and abs(np.mean(errors)) < 0.01
    assert len(got) == n


def test_awkward_rows(spark):
    docs = cases.with_clashes(cases.awkward(spark))
    rows = fingerprints.fingerprints(docs).collect()
    assert len(rows) == docs.count()
    texts = [r.text or "" for r in docs.collect()]
    assert sorted(r.n_chars for r in rows) == sorted(map(len, texts))
    by_chars = {}
    for r in rows:
        assert (len(r.fingerprint) == 256) == (r.fingerprint != "")
        by_chars.setdefault((r.n_chars, r.fingerprint), set()).add(r.fingerprint)
    wordless = [r for r in rows if r.fingerprint == ""]
    assert len(wordless) == sum(not t.split() for t in texts)
    repeated = {r.fingerprint for r in rows if r.doc_id in (18, 19)}
    assert len(repeated) == 1
    assert fingerprints.fingerprints(cases.empty(spark)).collect() == []


def test_no_python_in_the_plan(spark):
    docs = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string")
    plan = fingerprints.fingerprints(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_bins_hold_smallest_hashes_of_distinct_shingles(spark):
    texts = [" ".join(f"w{k}" for k in range(n)) for n in (5, 6, 40, 3000)]
    df = spark.createDataFrame([(t, f"{t} {t}") for t in texts], "a string, b string")
    rows = df.select(fingerprints.packed_minhash("a").alias("p"), fingerprints.packed_minhash("b").alias("q"), fingerprints.packed_minhash("upper(a)").alias("u")).collect()
    assert all(len(r.p) == 16 and r.p == r.u for r in rows)
    near = df.select(fingerprints.packed_minhash("a").alias("p"), fingerprints.packed_minhash("b").alias("q")).select(fingerprints.likeness("p", "q").alias("x")).collect()
    assert near[3].x > 0.95
    assert near[0].x < 0.4


def blocks(ids):
    return ids.select("order_id", "order_hash", fingerprints.block_of(ids).alias("b"))


def test_blocks_are_monotone_and_bounded(spark):
    values = [*range(3000), *range(10 ** 12, 10 ** 12 + 3000), -(1 << 62), (1 << 62)]
    ids = spark.createDataFrame([(i,) for i in values], "order_id long").withColumn("order_hash", F.xxhash64("order_id"))
    numbers = [r.b for r in blocks(ids).orderBy("order_id").collect()]
    assert numbers == sorted(numbers)
    assert blocks(ids).groupBy("b").count().agg(F.max("count")).first()[0] <= 400


def test_rows_of_one_id_spread(spark):
    """A third of the rows without an id, a tenth with one id: no block holds more than a few times the aim."""
    n = 30_000
    order_id = F.when(F.col("id") % 3 == 0, F.lit(fingerprints.NO_ID)).when(F.col("id") % 10 == 1, F.lit(77)).otherwise(F.col("id"))
    ids = spark.range(n).select(order_id.alias("order_id"), F.xxhash64("id").alias("order_hash"))
    numbers = [r.b for r in blocks(ids).orderBy("order_id", "order_hash").collect()]
    assert numbers == sorted(numbers)
    sizes = [r["count"] for r in blocks(ids).groupBy("b").count().collect()]
    assert sum(sizes) == n and max(sizes) <= 4 * fingerprints.ROWS_PER_BLOCK


def test_next_of_rows_without_ids(spark):
    rows = [(None if i % 3 == 0 else 5 if i % 3 == 1 else i, f"t{i}") for i in range(3000)] + [(None, "t0"), (5, "t1")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    known = docs.select(F.coalesce("doc_id", F.lit(fingerprints.NO_ID)).alias("order_id"), "text", F.xxhash64("text").alias("order_hash"))
    got = fingerprints.with_next(known, ["text"]).collect()
    order = sorted(got, key=lambda r: (r.order_id, r.order_hash), reverse=True)
    following = {(r.order_id, r.text): set() for r in order}
    for a, b in zip(order, order[1:] + order[:1], strict=True):
        following[a.order_id, a.text].add(b.text)
    assert len(got) == len(rows) and all(r.next_text in following[r.order_id, r.text] for r in got)
    assert sorted(r.next_text for r in got) == sorted(t for _, t in rows)
