"""Exact and near duplicates, components and shared lines against brute force."""

import hashlib
import random
import re
import time
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeplan.llm import common, components, exact_dedup, line_dedup, ngram_join
from tests.llm import cases

SPACE = re.compile(r"[\x20\x09-\x0D]+")


def exact_expected(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[hashlib.sha256(SPACE.sub(" ", r.text or "").encode()).hexdigest()].append(r.doc_id)
    return groups


def test_exact_dedup_equals_brute_force(spark):
    docs = cases.with_clashes(cases.awkward(spark)).repartition(5)
    got = exact_dedup.decisions(docs).collect()
    groups = exact_expected(docs.collect())
    assert sum(r.kept for r in got) == len(groups) and len(got) == docs.count()
    for r in got:
        ids = groups[r.text_sha256]
        assert r.group_size == len(ids)
        assert r.keep_id == min((i for i in ids if i is not None), default=None)
        assert not r.kept or r.doc_id == r.keep_id
    kept = exact_dedup.keep_one(docs)
    assert kept.columns == docs.columns
    found = kept.collect()
    assert {hashlib.sha256(SPACE.sub(" ", r.text or "").encode()).hexdigest() for r in found} == set(groups) and len(found) == len(groups)
    assert exact_dedup.decisions(cases.empty(spark)).collect() == [] == exact_dedup.keep_one(cases.empty(spark)).collect()


def test_cuckoo_index_against_a_dict():
    rng, index, plain = random.Random(2), exact_dedup.CuckooIndex(4), {}
    digests = [hashlib.sha256(str(i).encode()).digest() for i in range(3000)]
    for step in range(12_000):
        d = rng.choice(digests)
        if rng.random() < 0.3:
            assert index.delete(d) == (plain.pop(d, None) is not None)
        else:
            assert index.insert(d, (step, 0)) == (d not in plain)
            first, n = plain.get(d, (step, 0))
            plain[d] = (min(first, step), n + 1)
    assert {e[0]: (e[1][0], e[2]) for e in index.entries()} == plain
    assert index.live == len(plain) and index.mask + 1 > 4
    assert all(index.stored(d) is None for d in digests if d not in plain)


def test_colliding_fingerprints_are_verified():
    index = exact_dedup.CuckooIndex(2)
    same = [bytes(10) + bytes([i]) * 22 for i in range(30)]
    assert all(index.insert(d, (i, 0)) for i, d in enumerate(same[:8]))
    assert not index.insert(same[3], (0, 0)) and index.stored(same[9]) is None
    assert index.delete(same[3]) and index.stored(same[3]) is None and index.stored(same[4]) is not None


def test_index_update(spark):
    def keys(names, **more):
        return [(hashlib.sha256(n.encode()).digest(), i, 0, 1, *more.values()) for i, n in enumerate(names)]

    stored = spark.createDataFrame(keys("abcdef"), exact_dedup.ENTRY_SCHEMA)
    changes = spark.createDataFrame(keys("ab", live=False) + keys("gc", live=True), exact_dedup.ENTRY_SCHEMA + ", live boolean")
    got = {bytes(r.digest): r.copies for r in exact_dedup.update(stored, changes, 3).collect()}
    assert got == {hashlib.sha256(n.encode()).digest(): c for n, c in zip("cdefg", (2, 1, 1, 1, 1), strict=True)}


def plain_set(text, words):
    found = [w for w in re.split(r"[\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")) if w]
    return {tuple(found[i:i + words]) for i in range(max(1, len(found) - words + 1))} if found else set()


def brute_components(rows, words, num, den):
    ids = sorted({r[0] for r in rows})
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    sets = [(i, plain_set(t, words)) for i, t in rows]
    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and den * len(a & b) >= num * len(a | b):
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    return Counter((i, len(s), root(i) if s else i) for i, s in sets)


def near_texts(seed, groups, words, edits):
    """Groups of copies with a few words changed, in steps, so that links form chains; and loners."""
    rng, made = random.Random(seed), []
    for _ in range(groups):
        base = [f"w{rng.randrange(4000)}" for _ in range(rng.choice(words))]
        for _ in range(rng.randrange(1, 9)):
            made.append(" ".join(base))
            base = list(base)
            for _ in range(rng.randrange(edits + 1)):
                base[rng.randrange(len(base))] = f"w{rng.randrange(4000)}"
    rng.shuffle(made)
    return made


@pytest.mark.parametrize("join,edits", [(ngram_join.Join(), 3), (ngram_join.Join(words=5, num=80, den=100, growth=1.2), 3)])
def test_near_components_equal_brute_force(spark, join, edits):
    texts = near_texts(5, 45, (2, 6, 12, 30, 80, 200, 400), edits) + cases.texts()
    docs = cases.with_clashes(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).repartition(4)
    got = Counter(tuple(r) for r in ngram_join.near_components(docs, join).collect())
    assert got == brute_components(list(enumerate(texts)), join.words, join.num, join.den)


def test_near_components_of_awkward_rows(spark):
    docs = cases.awkward(spark)
    got = ngram_join.near_components(docs).collect()
    assert len(got) == docs.count()
    assert all(r.component_id == r.doc_id for r in got if r.n_shingles == 0)
    kept = ngram_join.one_per_group(docs, ngram_join.Join())
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r.component_id for r in got} | {None}
    assert ngram_join.near_components(cases.empty(spark)).collect() == []


@pytest.mark.parametrize("join", [ngram_join.Join(), ngram_join.Join(words=5, num=80, den=100, growth=1.2), ngram_join.Join(num=50, den=100)])
def test_similar_sets_share_a_signature(join):
    rng = np.random.default_rng(8)
    for size in (1, 2, 3, 5, 8, 9, 10, 11, 17, 25, 40, 77, 150, 400, 1300):
        for _ in range(25):
            a = np.unique(rng.integers(0, 1 << 63, size, dtype=np.uint64))
            most = int(2 * len(a) * (join.den - join.num) / (join.den + join.num)) + 1
            drop, add = rng.integers(0, most + 1), rng.integers(0, most + 1)
            b = np.unique(np.concatenate([rng.permutation(a)[min(drop, len(a) - 1):], rng.integers(0, 1 << 63, add, dtype=np.uint64)]))
            difference = len(np.setxor1d(a, b))
            sketches = ngram_join.folded([ngram_join.sketch(a), ngram_join.sketch(b)])
            assert np.bitwise_count(sketches[0] ^ sketches[1]).sum() <= difference
            if difference and join.similar(difference, len(a) + len(b)):
                assert np.intersect1d(ngram_join.signatures(a, join), ngram_join.signatures(b, join)).size


def test_large_groups_are_split_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK_MEMBERS", 4)
    base = [f"w{i}" for i in range(60)]
    texts = [" ".join([*base[:i], f"x{i}", *base[i + 1:]]) for i in range(0, 60)] + [" ".join(base)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = Counter(tuple(r) for r in ngram_join.near_components(docs).collect())
    assert got == brute_components(list(enumerate(texts)), 3, 90, 100)


def test_hot_signatures_are_dealt_before_they_are_listed(spark, monkeypatch):
    """Near copies of one text, of another with the same ending, and strays: lists stay small and grow with the rows, not their square."""
    monkeypatch.setattr(ngram_join, "BLOCK_MEMBERS", 8)
    seen, written = [], ngram_join.common.written

    def watched(df, label):
        made = written(df, label)
        if label == "groups":
            seen.extend(r.n for r in made.selectExpr("size(members) AS n").collect())
        return made

    monkeypatch.setattr(ngram_join.common, "written", watched)
    base, other, end = [f"w{i}" for i in range(70)], [f"v{i}" for i in range(16)], [f"e{i}" for i in range(40)]
    made = [[*base[:i], f"x{i}", *base[i + 1:], *end] for i in range(0, 70)] + [[*other, *base[16:60], f"y{i}", *base[61:], *end] for i in range(20)]
    made += [[*base[:k], *[f"z{k}{i}" for i in range(10)], *base[k + 10:], *end] for k in range(0, 60, 12)]
    texts = [" ".join(t) for t in made]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = Counter(tuple(r) for r in ngram_join.near_components(docs).collect())
    assert got == brute_components(list(enumerate(texts)), 3, 90, 100)
    assert max(seen) <= 6 * 8
    signed = sum(len(ngram_join.signatures(ngram_join.shingle_set(t, 3), ngram_join.Join())) for t in texts)
    assert sum(seen) <= ngram_join.ROUNDS * signed


def test_rows_without_an_id_do_not_join_others(spark):
    p, q, r = ([f"{x}{i}" for i in range(60)] for x in "pqr")
    rows = [(7, p), (None, [*p, "tail"]), (900, q), (None, [*q, "tail"]), (None, r), (None, [*r, "tail"])]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in rows], "doc_id long, text string").repartition(3)
    got = Counter((r.doc_id, r.component_id) for r in ngram_join.near_components(docs).collect())
    assert got == Counter({(7, 7): 1, (None, 7): 1, (900, 900): 1, (None, 900): 1, (None, None): 2})
    assert Counter(r.doc_id for r in ngram_join.one_per_group(docs, ngram_join.Join()).collect()) == Counter({7: 1, 900: 1, None: 4})


def test_repeated_ids_chain_every_set_and_drop_by_row(spark):
    a, b, c = ([f"{x}{i}" for i in range(60)] for x in "abc")
    rows = [(1, a), (5, a), (5, b), (8, b), (8, c), (8, []), (9, c)]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in rows], "doc_id long, text string").repartition(3)
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.near_components(docs).collect())
    assert got == brute_components([(i, " ".join(t)) for i, t in rows], 3, 90, 100)
    assert sorted((r.doc_id, r.text[:2]) for r in ngram_join.one_per_group(docs, ngram_join.Join()).collect()) == [(1, "a0"), (8, "")]


def test_components_of_chains_stars_and_loops(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(200, 201), (201, 202), (202, 200), (300, 300)]
    rng.shuffle(edges)
    got = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 140), 100), **dict.fromkeys((200, 201, 202), 200)}
    assert components.components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_short_lines_on_many_sites_go(spark):
    rows = [(i, f"own line of document {i}\nHome\n\n x\t", "en", f"s{i}", 1) for i in range(6)]
    got = line_dedup.without_boilerplate(spark.createDataFrame(rows, cases.SCHEMA)).collect()
    assert {(r.doc_id, r.text, r.n_removed) for r in got} == {(i, f"own line of document {i}\n", 2) for i in range(6)}


def brute_lines(rows, sites, least):
    spread = defaultdict(set)
    for r in rows:
        for line in (r.text or "").split("\n"):
            if len(line.strip(" \t\r")) >= least and r.source is not None:
                spread[line.strip(" \t\r")].add(r.source)
    out = []
    for r in rows:
        lines = (r.text or "").split("\n")
        keep = [x for x in lines if len(spread[x.strip(" \t\r")]) < sites]
        out.append((r.doc_id, len(lines), len(lines) - len(keep), "\n".join(keep) if len(keep) < len(lines) else r.text))
    return Counter(out)


def test_lines_on_many_sites_go(spark):
    rng, rows = random.Random(6), []
    shared = [(f"boilerplate line number {k} of all", k) for k in range(1, 12)]
    for i in range(300):
        site = rng.randrange(12)
        lines = [f"own line of document {i}", *(f"  {t}\t" for t, k in shared if site < k), "short", "", f"repeated {i % 7} here and there, long"]
        rng.shuffle(lines)
        rows.append((i, "\n".join(lines), "en", None if i % 50 == 0 else f"s{site}", 1))
    docs = spark.createDataFrame(rows, cases.SCHEMA).unionByName(cases.awkward(spark)).repartition(4)
    docs = cases.with_clashes(docs).drop("site")
    cleaned = line_dedup.without_boilerplate(docs, sites=4)
    assert cleaned.columns == [*docs.columns, "n_lines", "n_removed"]
    got = Counter((r.doc_id, r.n_lines, r.n_removed, r.text) for r in cleaned.collect())
    assert got == brute_lines(docs.collect(), 4, line_dedup.LEAST_CHARS)
    assert line_dedup.without_boilerplate(cases.empty(spark)).collect() == []


def test_rows_that_read_alike_keep_their_own_lines(spark):
    """A row without an id whose text looks like another row's id and text."""
    rows = [(i, "same line", "en", f"s{i}", 1) for i in range(1, 7)] + [(None, "1|same line", "en", "s1", 1), (None, "same line", "en", "s1", 1)]
    got = Counter((r.doc_id, r.text) for r in line_dedup.without_boilerplate(spark.createDataFrame(rows, cases.SCHEMA)).collect())
    assert got == Counter([(i, "") for i in range(1, 7)] + [(None, "1|same line"), (None, "")])


def test_line_counts_replace_columns_of_their_name(spark):
    docs = cases.awkward(spark).withColumns({"n_lines": F.lit("clash"), "n_removed": F.lit("clash")})
    cleaned = line_dedup.without_boilerplate(docs)
    assert cleaned.columns == [*docs.drop("n_lines", "n_removed").columns, "n_lines", "n_removed"] and cleaned.filter("n_lines < 1").count() == 0


def shuffle_files(spark):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {n for n in re.findall(r"shuffle_\d+_\d+", disk.getAllBlocks().mkString(" "))}


def test_a_written_stage_leaves_no_shuffle_files(spark):
    before = shuffle_files(spark)
    df = spark.range(50_000).repartition(7, "id").groupBy(F.expr("id % 1000").alias("k")).count()
    assert common.written(df, "shuffled").count() == 1000
    for _ in range(50):
        left = {n for n in shuffle_files(spark) - before}
        if len(left) <= 8:  # of the count, which is no stage
            break
        time.sleep(0.2)
    assert len(left) <= 8, left
    assert spark.conf.get(common.SHUFFLE_CLEANUP) == "false"


def test_a_cold_signature_is_its_own_block(spark):
    signed = spark.createDataFrame([(5, 1), (5, 2), (9, 2), (9, 1), (7, 3)], "signature long, set_id long")
    found = ngram_join.groups(signed)
    assert [(sorted(r.members), r.block) for r in found.collect()] == [([1, 2], 5)]
    assert sorted(found.columns) == ["block", "group_id", "members"]
