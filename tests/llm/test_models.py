"""Quality, toxicity and language: held-out results, independence of labels, awkward input."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeplan.llm import common, language, quality, toxicity
from tests.llm import cases

SF = "/root/testdata/sf0.1"


def auc(y, score):
    rank = np.argsort(np.argsort(score)) + 1
    ones, zeros = (y == 1).sum(), (y == 0).sum()
    return (rank[y == 1].sum() - ones * (ones + 1) / 2) / (ones * zeros)


def held_out(scores, marks, label):
    found = scores.filter("held_out").join(marks.select("doc_id", F.col(label).alias("y")), "doc_id").toPandas()
    return found.y.to_numpy(), found


@pytest.mark.parametrize("model,label,least", [(quality, "quality", 0.98), (toxicity, "toxic", 0.95)])
def test_held_out_labels(spark, model, label, least):
    docs, marks = common.documents(spark, SF), common.labels(spark, SF)
    y, found = held_out(model.scores(docs, marks), marks, label)
    assert auc(y, found.score.to_numpy()) > least
    assert (found.predicted.to_numpy() == y).mean() > 0.97
    assert found.predicted[y == (1 if label == "quality" else 0)].mean() == pytest.approx(1 if label == "quality" else 0, abs=0.01)


def test_held_out_languages(spark):
    docs = common.documents(spark, SF)
    found = language.predictions(docs).filter("held_out").join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    assert (found.lang == found.lang_pred).mean() > 0.995
    assert found.score.between(0, 1).all()


@pytest.mark.parametrize("model,label", [(quality, "quality"), (toxicity, "toxic")])
def test_held_out_rows_teach_nothing(spark, model, label):
    docs = cases.with_clashes(cases.awkward(spark))
    marks = cases.marks(spark, docs, label)
    turned = marks.withColumn(label, F.when(common.crc_fold() == 0, 1 - F.col(label)).otherwise(F.col(label)))
    first, second = (sorted(map(str, model.scores(docs, m).collect())) for m in (marks, turned))
    assert first == second and len(first) == docs.count()


@pytest.mark.parametrize("model,label", [(quality, "quality"), (toxicity, "toxic")])
def test_scores_without_labels(spark, model, label):
    docs, none = cases.awkward(spark), cases.marks(spark, cases.empty(spark), label)
    rows = model.scores(docs, none).collect()
    assert len(rows) == docs.count() and len({r.score for r in rows}) == 1 and all(0 <= r.score <= 1 for r in rows)
    assert model.scores(cases.empty(spark), none).collect() == []
    one_kind = cases.marks(spark, docs, label).withColumn(label, F.lit(1))
    assert all(r.predicted == 1 for r in model.scores(docs, one_kind).collect())


def test_folds_are_crc32(spark):
    rows = spark.range(50).select("id", common.crc_fold("id").alias("fold")).collect()
    assert all(r.fold == zlib.crc32(str(r.id).encode()) % 5 for r in rows)


def test_pairs_of_terms_matter():
    rng = np.random.default_rng(0)
    terms, rows = toxicity.Terms(), []
    for i in range(3000):
        words = {f"w{k}" for k in rng.integers(0, 60, 8)} | ({"slur"} if rng.random() < 0.5 else set()) | ({"group"} if rng.random() < 0.5 else set())
        text = " ".join(w.translate(str.maketrans("0123456789", "abcdefghij")) for w in sorted(words))
        rows.append((i, int({"slur", "group"} <= words), terms.of(text).tolist()))
    import pickle

    machine = pickle.loads(toxicity.fit(rows, {0: sum(r[1] == 0 for r in rows), 1: sum(r[1] for r in rows)}))
    p = machine.probability(np.array([machine.margin(machine.known(np.array(r[2]))) for r in rows]))
    assert ((p >= 0.5) == np.array([r[1] for r in rows])).mean() > 0.97
    assert np.abs(machine.v).max() > 0.2


def test_language_of_awkward_texts(spark):
    docs = cases.with_clashes(cases.awkward(spark))
    rows = language.predictions(docs).collect()
    assert len(rows) == docs.count()
    by_id = {r.doc_id: r for r in rows}
    assert all(by_id[i].lang_pred == "und" and by_id[i].score == 0 for i in (0, 1, 2, 7))
    assert by_id[18].lang_pred == "en"
    assert {r.lang_pred for r in language.predictions(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    assert language.predictions(cases.empty(spark)).collect() == []


def test_grams_see_the_whole_text():
    short, long_text = language.gram_counts("abc " * 10), language.gram_counts("abc " * 10 + "xyz" * 3)
    assert long_text.sum() > short.sum() and language.gram_counts("12 !?") is None
    assert language.ascii_letters("A-b9Z") == "a b z"


def hot_id(spark, n=900):
    """A third of the rows under one id that is not held out, each with its own text."""
    doc_id = F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id"))
    return spark.range(n).select(doc_id.alias("doc_id"), F.concat(F.lit("words of text "), F.col("id").cast("string")).alias("text"),
                                 F.when(F.col("id") == 5, "rare").otherwise("common").alias("lang"))


@pytest.mark.parametrize("per_class", [10, 10_000])
def test_samples_are_bounded_by_rows(spark, per_class):
    docs = hot_id(spark)
    marks = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic"))
    sample, counts = common.labelled_rows(docs, marks, "toxic", per_class)
    rows = sample.collect()
    assert len(rows) == len({r.doc_id for r in rows}) == sum(min(per_class, n) for n in counts.values())
    assert all(r.text in {t.text for t in docs.filter(F.col("doc_id") == r.doc_id).collect()} for r in rows if r.doc_id in (1, 2))
    assert sorted(map(str, rows)) == sorted(map(str, common.labelled_rows(docs.repartition(7), marks, "toxic", per_class)[0].collect()))


def test_every_language_is_learnt(spark):
    known = hot_id(spark).filter("lang IS NOT NULL")
    picked = language.training_ids(known, 8, 3).collect()
    assert len(picked) == len(set(picked)) == 8 and sum(r.lang == "rare" for r in picked) == 1
    many = spark.range(1000).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 990, "a").otherwise(F.concat(F.lit("b"), F.col("id") % 5)).alias("lang"))
    assert len({r.lang for r in language.training_ids(many, 6).collect()}) == 6
    found = language.training_ids(many, 40, 2).collect()
    assert all(sum(r.lang == f"b{k}" for r in found) == 2 for k in range(5)) and len(found) == 40


def test_language_score_is_the_dense_model(spark):
    """The predicted score, by a softmax over dense weights, one n-gram at a time."""
    import pickle

    docs = common.documents(spark, "/root/testdata/sf0.001")
    model = pickle.loads(language.train(docs))
    got = {(r.doc_id, r.lang_pred): r.score for r in language.predictions(docs).collect()}
    for r in docs.filter("text IS NOT NULL").orderBy("doc_id").limit(50).collect():
        counts = language.gram_counts(r.text)
        if counts is None:
            continue
        x = [c * w for c, w in zip(counts.tolist(), model["idf"].tolist(), strict=True)]
        length = sum(v * v for v in x) ** 0.5
        logits = [(sum(v / length * w for v, w in zip(x, row, strict=False) if v) + row[-1]) / model["temperature"] for row in model["weights"].tolist()]
        top = max(logits)
        parts = [np.exp(z - top) for z in logits]
        best = int(np.argmax(parts))
        assert got[r.doc_id, model["languages"][best]] == pytest.approx(parts[best] / sum(parts), abs=1e-9)


def test_quality_difference_is_the_sizes_by_hand(spark):
    import pickle

    import zstandard

    docs, marks = common.documents(spark, "/root/testdata/sf0.001"), common.labels(spark, "/root/testdata/sf0.001")
    sample, counts = common.labelled_rows(docs.select("doc_id", common.whole_text().alias("text")), marks, "quality", quality.PER_CLASS)
    model = pickle.loads(quality.fit([tuple(r) for r in sample.select("doc_id", "label", "text").collect()], counts))
    got = {r.doc_id: r for r in quality.scores(docs, marks).collect()}
    for r in docs.orderBy("doc_id").limit(50).collect():
        data, sizes = (r.text or "").encode(), []
        for d in model["dictionaries"]:
            packer = zstandard.ZstdCompressor(level=quality.LEVEL, dict_data=zstandard.ZstdCompressionDict(d), write_checksum=False,
                                              write_content_size=False, write_dict_id=False)
            sizes.append(sum(len(packer.compress(data[i:i + quality.BLOCK_BYTES])) for i in range(0, len(data), quality.BLOCK_BYTES)))
        difference = (sizes[1] - sizes[0]) / sum(sizes) if data else 0.0
        assert got[r.doc_id].difference == pytest.approx(difference, abs=0.02)


def test_machine_margin_is_the_double_loop():
    rng = np.random.default_rng(5)
    machine = toxicity.Machine(np.arange(40))
    machine.bias, machine.w, machine.v = 0.3, rng.normal(size=41).astype(np.float32), rng.normal(size=(41, 4)).astype(np.float32)
    for n in range(12):
        at = rng.choice(40, n, replace=False)
        plain = 0.3 + sum(float(machine.w[i]) for i in at)
        plain += sum(float(machine.v[a] @ machine.v[b]) for i, a in enumerate(at) for b in at[i + 1:])
        assert machine.margin(at) == pytest.approx(plain, abs=1e-3)
