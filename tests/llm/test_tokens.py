"""Token counts, byte-level BPE and packing against the tokenizer libraries on whole texts."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from lakeplan.llm import byte_bpe, common, packing, token_counts
from tests.llm import cases


@pytest.fixture(scope="module")
def library():
    return token_counts.load(common.tokenizer_file("byte_bpe_50k.json"))


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_counts_equal_the_library(spark, library):
    docs = cases.with_clashes(cases.awkward(spark))
    got = Counter((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts.token_counts(docs).collect())
    want = Counter()
    for r in docs.collect():
        n = len(ids_of(library, r.text))
        want[(r.doc_id, len((r.text or "").encode()), n, n > 512)] += 1
    assert got == want


def test_counts_of_no_documents(spark):
    assert token_counts.token_counts(cases.empty(spark)).collect() == []


def test_cache_keeps_frequent_words_when_full():
    class Encoded:
        ids = [1, 2]

    cache = token_counts.LengthCache({" the": 1}, lambda w, add_special_tokens: Encoded, bound=3)
    assert [cache[f"w{i}"] for i in range(10)] == [2] * 10
    assert cache[" the"] == 1 and len(cache) <= 3


def test_frequent_words_cover_all_rows(spark):
    docs = spark.createDataFrame([(i, " the the of") for i in range(40)] + [(99, None)], "doc_id long, text string").repartition(5)
    assert {r.word: r.n for r in token_counts.frequent_words(docs).collect()} == {"the": 80, "of": 40}


def digests(encoding, text):
    ids = encoding.encode_ordinary(text or "")
    return len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()


@pytest.mark.parametrize("chunk,overlap", [(32_768, 1_024), (40, 12)])
def test_round_trip_equals_the_library(spark, chunk, overlap):
    encoding = byte_bpe.rank_encoding(byte_bpe.VOCABULARY)
    docs = cases.with_clashes(cases.awkward(spark))
    got = Counter(tuple(r) for r in byte_bpe.round_trip(docs, chunk_chars=chunk, overlap=overlap).collect())
    assert got == Counter((r.doc_id, *digests(encoding, r.text)) for r in docs.collect())


def test_stitching_random_texts(spark):
    rng = random.Random(9)
    alphabet = ["'ll", "'s", " ", "  ", "\n", "\n\n", "\t", "word", "é", "123", "...", "'", " ", "🙂", "x" * 40, " y"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 120))) for _ in range(120)]
    encoding = byte_bpe.rank_encoding(byte_bpe.VOCABULARY)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: tuple(r)[1:] for r in byte_bpe.round_trip(docs, chunk_chars=48, overlap=16).collect()}
    assert got == {i: digests(encoding, t) for i, t in enumerate(texts)}


def test_round_trip_of_no_documents(spark):
    assert byte_bpe.round_trip(cases.empty(spark)).collect() == []


def check_packing(pieces, ids, capacity):
    by_sequence, by_doc = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_sequence[p.sequence_id].append(p)
        by_doc[p.doc_id].append(p)
    for sequence in by_sequence.values():
        at = 0
        for p in sorted(sequence, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at == capacity or at & (at - 1) == 0 and at < capacity
    assert set(by_doc) == set(ids)
    for i, parts in by_doc.items():
        at = 0
        for p in sorted(parts, key=lambda p: p.start):
            assert p.start == at and p.length > 0 and p.doc_tokens == len(ids[i])
            assert p.ids_crc32 == zlib.crc32(ids[i][at:at + p.length].tobytes())
            at += p.length
        assert at == len(ids[i])


def test_packing_holds_every_id_once(spark, library):
    docs = spark.createDataFrame(list(enumerate(cases.texts())), "doc_id long, text string").repartition(3)
    ids = {i: np.array([*ids_of(library, t), 1], "<u4") for i, t in enumerate(cases.texts())}
    check_packing(packing.pack(docs).collect(), ids, 2048)


def test_packing_repeats_and_clashes(spark):
    docs = cases.with_clashes(cases.awkward(spark))
    pieces = packing.pack(docs).collect()
    assert sum(p.length for p in pieces if p.start == 0) > 0
    assert sum(1 for p in pieces if p.start == 0) == docs.count()
    assert packing.pack(cases.empty(spark)).collect() == []


def test_groups_are_full_and_balanced():
    rng = np.random.default_rng(1)
    rests = [packing.Piece(i, 0, np.zeros(n, np.uint32), n) for i, n in enumerate(rng.integers(1, 2048, 900))]
    pieces, count, left = packing.pack_group(rests)
    used, cost = Counter(), Counter()
    for p in pieces:
        used[p.sequence] += len(p.ids)
        cost[p.sequence] += packing.piece_cost(len(p.ids))
    assert set(used.values()) == {2048} and len(used) == count
    assert sum(len(p.ids) for p in left) < 2048
    assert len(pieces) <= len(rests) + count
    naive = [packing.piece_cost(2048), packing.piece_cost(1) * 2048]
    assert max(cost.values()) - min(cost.values()) < naive[0] - naive[1]


def test_tail_is_powers_of_two():
    tail = packing.powers_of_two([packing.Piece(1, 0, np.arange(700, dtype=np.uint32), 700), packing.Piece(2, 0, np.arange(300, dtype=np.uint32), 300)])
    assert [sum(len(p.ids) for p in s) for s in tail] == [512, 256, 128, 64, 32, 8]
