"""Registered queries against SQL, and the pipeline's stages against brute force on a small table."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from lakeplan.llm import byte_bpe, catalogue, common, packing
from tests.llm import cases
from tests.llm.test_dedup import brute_components, exact_expected
from tests.llm.test_tokens import check_packing
from tools.check_oracle import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_matches_sql(spark, name):
    assert compare(catalogue.QUERIES[name](spark, SF).toPandas(), connect(SF).execute(catalogue.ORACLES[name]).fetch_df()) == "ok"


def test_all_ten_and_the_pipeline_are_registered():
    numbers = Counter(n.split("_")[0] for n in entry.queries() if n.startswith("op") and n[2].isdigit())
    assert numbers == {f"op{i}": 1 for i in range(1, 11)} and "pipeline" in entry.queries()


@pytest.fixture(scope="module")
def small(spark, tmp_path_factory):
    """A folder with documents and labels: languages, insults, copies, near copies and awkward rows."""
    rng, rows, marks = random.Random(12), [], []
    vocabularies = {"en": "the of and that with from this which".split(), "de": "der und nicht eine für auch über schön".split()}
    for i in range(160):
        lang = "en" if i % 2 else "de"
        words = [rng.choice(vocabularies[lang]) + rng.choice(["", "a", "en", "ly"]) for _ in range(rng.choice([12, 40, 120]))]
        toxic = i % 5 == 0
        for _ in range(3 * toxic):
            words.insert(rng.randrange(len(words)), rng.choice(["scumbag", "moronic"]))
        rows.append((1000 + i, " ".join(words), lang, f"s{i % 3}", None))
        marks.append((1000 + i, 1, int(toxic)))
    clean = [r for r in rows if "scumbag" not in r[1] and "moronic" not in r[1]]
    for k, r in enumerate(clean[:20]):
        rows.append((2000 + k, r[1].replace(" ", "  ", 3), r[2], "s9", None))
        rows.append((3000 + k, r[1] + " tail", r[2], "s9", None))
    rows += [(4000 + i, t, None, None, None) for i, t in enumerate(cases.texts())]
    path = tmp_path_factory.mktemp("small")
    spark.createDataFrame(rows, cases.SCHEMA).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(marks, "doc_id long, quality long, toxic long").write.parquet(f"{path}/labels.parquet")
    return str(path)


def test_stages_one_by_one(spark, small):
    docs, seen = common.documents(spark, small), {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, common.written(stage(spark, docs, small), f"test-{name}")
        seen[name] = (before, docs)
        if name != "packing":
            assert docs.columns == before.columns == ["doc_id", "text", "lang", "source", "n_chars"]

    def ids(name):
        return [{r.doc_id for r in df.select("doc_id").collect()} for df in seen[name]]

    before, after = ids("language")
    assert {4000, 4001, 4002, 4003, 4007} <= before - after and {i for i in before if i < 4000} <= after
    before, after = ids("toxicity")
    toxic = {1000 + i for i in range(0, 160, 5)}
    assert len(toxic & after) <= 1 and before - after <= toxic | set(range(4000, 4100))
    before, after = ids("exact_dedup")
    groups = exact_expected(seen["exact_dedup"][0].collect())
    assert after == {min(g) for g in groups.values()}
    rows = [(r.doc_id, r.text) for r in seen["near_dedup"][0].collect()]
    assert ids("near_dedup")[1] == {c for _, _, c in brute_components(rows, 5, 80, 100)}
    assert not any(3000 <= i < 3020 for i in ids("near_dedup")[1] if len(dict(rows)[i].split()) > 30)
    encoding = byte_bpe.rank_encoding(byte_bpe.VOCABULARY, packing.SPECIALS)
    kept = {r.doc_id: np.array([*encoding.encode(r.text, allowed_special="all"), 1], "<u4") for r in seen["near_dedup"][1].collect()}
    check_packing(seen["packing"][1].collect(), kept, 2048)


def test_run_is_the_stages(spark, small):
    pieces = corpus_pipeline.run(spark, small)
    assert pieces.columns == list(packing.FIELDS) and pieces.count() > 50
    assert all(0 <= r.ids_crc32 <= 0xFFFFFFFF for r in pieces.select("ids_crc32").collect())
    assert zlib.crc32(b"") == 0


def test_pipeline_of_no_documents(spark, tmp_path):
    cases.empty(spark).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality long, toxic long").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
