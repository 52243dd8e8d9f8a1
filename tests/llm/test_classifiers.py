import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import boosting, labelled, quality, toxicity
from ledgerloom.llm.queries import QUERIES

DOCS = "doc_id long, text string, lang string, source string, score string"
LABELS = "doc_id long, quality int, toxic int"


def walk(forest, row):
    total = forest.base
    for node in forest.roots:
        while forest.left[node] != node:
            node = forest.left[node] if row[forest.feature[node]] <= forest.threshold[node] else forest.right[node]
        total += forest.value[node]
    return total


def test_flat_arrays_are_the_trees():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(800, 5)).round(1)
    y = (x[:, 0] * x[:, 1] > 0.2) ^ (rng.random(800) < 0.05)
    forest = boosting.fit(x, y, trees=40)
    assert np.allclose(forest.margin(x), [walk(forest, r) for r in x])
    test = rng.normal(size=(500, 5))
    assert ((forest.probability(test) > 0.5) == (test[:, 0] * test[:, 1] > 0.2)).mean() > 0.85


def test_constant_without_both_classes():
    assert boosting.fit(np.zeros((0, 3)), np.zeros(0)).probability(np.zeros((2, 3))).tolist() == [0.5, 0.5]
    assert (boosting.fit(np.ones((50, 2)), np.ones(50)).probability(np.ones((1, 2))) > 0.9).all()


def test_isotonic():
    rng = np.random.default_rng(2)
    margins = rng.normal(size=4000) * 2
    truth = boosting.sigmoid(margins * 0.5)
    calibrated = boosting.isotonic(margins, rng.random(4000) < truth)
    grid = np.linspace(-5, 5, 200)
    assert (np.diff(calibrated(grid)) >= 0).all()
    assert np.abs(calibrated(margins) - truth).mean() < 0.04


@pytest.mark.parametrize("extract, width", [(quality.features, len(quality.FEATURES)),
                                            (lambda t: toxicity.features(t, {"scum": 2.0}), len(toxicity.FEATURES))])
def test_features_of_odd_texts(extract, width):
    for text in (None, b"", b" \n\t", b"\xff\xfe", b"a", b"!" * 50, "é 😀".encode(), b"scum you", b"x " * 60_000):
        row = extract(text)
        assert len(row) == width and np.isfinite(row).all()


def test_obfuscated_words_count():
    plain, odd = (toxicity.features(t, {}) for t in (b"you are an idiot", b"you are an 1d1ot"))
    assert plain[1] == odd[1] == 1.0 and odd[toxicity.FEATURES.index("disguised lexicon words")] == 1.0


@pytest.mark.parametrize("name, label, least", [("op8_quality_classifier", "quality", 0.95), ("op9_toxicity", "toxic", 0.9)])
def test_held_out_accuracy(spark, name, label, least):
    sf_dir = "/root/testdata/sf0.1"
    out = QUERIES[name](spark, sf_dir).toPandas()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id").toPandas()
    assert sorted(out.doc_id) == sorted(docs.doc_id)
    assert out.score.between(0, 1).all()
    assert (out.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in out.doc_id]).all()
    both = out[out.held_out].merge(spark.read.parquet(f"{sf_dir}/labels.parquet").toPandas(), on="doc_id")
    pos, neg = both.score[both[label] == 1].to_numpy(), both.score[both[label] == 0].to_numpy()
    auc = (pos[:, None] > neg[None]).mean() + 0.5 * (pos[:, None] == neg[None]).mean()
    assert auc > least
    assert (both.predicted == both[label]).mean() > 0.95


@pytest.mark.parametrize("module, label", [(quality, "quality"), (toxicity, "toxic")])
def test_odd_tables(spark, module, label):
    rows = [(i, "fine words here" if i % 2 else "scum scum !!!", "en", "s", "x") for i in range(60)]
    rows += [(100, None, None, None, None), (101, "", None, None, None), (None, "text", None, None, None), (1, "fine words here", None, None, None)]
    docs = spark.createDataFrame(rows, DOCS)
    labels = spark.createDataFrame([(i, i % 2, 1 - i % 2) for i in range(60)] + [(None, 1, 1), (5, None, None), (5, 1, 0), (777, 1, 1)], LABELS)
    out = module.scored(docs, labels)
    assert out.columns == ["doc_id", "text", "lang", "source", "score"]
    found = out.collect()
    assert len(found) == len(rows) and all(0 <= r.score <= 1 for r in found)
    assert len({r.score for r in found if r.text in (None, "")}) == 1
    none = spark.createDataFrame([], LABELS)
    assert {r.score for r in module.scored(docs, none).collect()} == {0.5}
    assert module.scored(spark.createDataFrame([], DOCS), labels).collect() == []


def test_labels_of_held_out_rows_are_not_learned(spark):
    labels = spark.range(500).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"))
    folds = [r.fold for r in labelled.training_sample(labels, "quality").collect()]
    assert folds and labelled.HELD_OUT not in folds
    assert labelled.training_sample(labels, "quality", 7).count() == 7
