"""Phrases and their scores against plain counting."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeplan.llm import collocations as co
from tests.llm import cases


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def brute(rows, least, top, longest=5):
    counts, total = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered(text)):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for n in range(1, longest + 1):
                for i in range(len(words) - n + 1):
                    counts[lang, tuple(words[i:i + n])] += 1
    out = []
    for lang in total:
        frequent = {p: a for (tongue, p), a in counts.items() if tongue == lang and len(p) > 1 and a >= least}
        kept = []
        for p, a in frequent.items():
            inside = any(len(q) > len(p) and 100 * f >= 100 * a and any(q[i:i + len(p)] == p for i in range(len(q))) for q, f in frequent.items())
            if not inside:
                cuts = [(1000 * a * total[lang] // (counts[lang, p[:k]] * counts[lang, p[k:]]), k) for k in range(1, len(p))]
                score, k = min(cuts)
                kept.append((-score, -a, " ".join(p).encode(), counts[lang, p[:k]], counts[lang, p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, total[lang], -score))
    return sorted(out)


def some_docs(spark, n=300, seed=1):
    rng = random.Random(seed)
    words = ["the", "The", "of", "and", "naïve", "ÀB", "x" * 40, "new", "york", "city", "Ñ", "a b", " ", "it's", "<|end|>"]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(rng.randint(0, 40)):
            parts.append(rng.choice(["new york city", "of the", "the the the the the the", *words]))
            parts.append(rng.choice([" ", " ", " ", "\t", "  ", ". ", ",", "\n", "\r\n", "\x0b", "\x1c"]))
        rows.append((i, "".join(parts), rng.choice(["en", "en", "fr", None, "und"])))
    rows += [(None, None, None), (1, "", "en"), (None, "new york city", None), (5, rows[5][1], rows[5][2]), (5, rows[5][1], rows[5][2])]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


@pytest.mark.parametrize("least,top,bits", [(5, 2000, 64), (20, 3, 64), (5, 2000, 6), (8, 50, 9)])
def test_phrases_equal_plain_counting(spark, least, top, bits):
    """Few bits make fingerprints collide; the texts decide then."""
    docs = some_docs(spark)
    got = sorted(tuple(r) for r in co.collocations(docs.repartition(5), least=least, top=top, bits=bits).collect())
    want = brute([(r.lang, r.text) for r in docs.collect()], least, top)
    assert want and got == want


def test_defined_results(spark):
    docs = cases.with_clashes(cases.awkward(spark))
    got = sorted(tuple(r) for r in co.collocations(docs, least=2).collect())
    assert got == brute([(r.lang, r.text) for r in docs.collect()], 2, 2000) and got
    assert co.collocations(cases.empty(spark)).collect() == []
    assert co.collocations(docs, least=10**9).collect() == []
    assert co.collocations(docs.withColumn("text", F.lit(None).cast("string"))).collect() == []


def test_large_products_are_exact(spark):
    """1000 * a * n passes 64 bits."""
    expr = "((CAST(1000 * a AS decimal(19,0)) * CAST(n AS decimal(19,0))) div (CAST(l AS decimal(19,0)) * CAST(r AS decimal(19,0))))"
    a, n, left, right = 9 * 10**12, 9 * 10**14 + 7, 10**13 + 3, 3 * 10**13 + 1
    got = spark.createDataFrame([(a, n, left, right)], "a long, n long, l long, r long").select(F.expr(expr)).first()[0]
    assert got == 1000 * a * n // (left * right)


def test_windows_are_polynomials():
    rng = np.random.default_rng(2)
    values = rng.integers(1, 1 << 63, 70_000).astype(np.uint64)
    for n in (1, 2, 5):
        got = co.windows(values, n, co.BASE)
        assert len(got) == len(values) - n + 1
        for i in (0, 17, 65_530, 65_533, 65_535, 65_536, len(got) - 1):
            plain = 0
            for v in values[i:i + n].tolist():
                plain = (plain * co.BASE + v) % (1 << 64)
            assert int(got[i]) == plain
    assert len(co.windows(values[:3], 5, co.BASE)) == 0
