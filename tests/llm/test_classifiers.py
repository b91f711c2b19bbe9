import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from catchlake.llm import quality, queries, toxicity
from catchlake.llm.common import Sample, fold, platt, table
from llm_helpers import prose

FOLDER = "/root/testdata/sf0.01"


def labelled(spark, scored, label, fold_):
    labels = table(spark, FOLDER, "labels").select("doc_id", label)
    rows = scored.join(labels, "doc_id").filter(fold_).select("predicted", label).collect()
    return np.array([r[0] for r in rows]), np.array([r[1] for r in rows])


@pytest.mark.parametrize("name,label,folds,held", [("op1_toxicity", "toxic", 3, 1), ("op4_quality", "quality", 5, 0)])
def test_held_out_accuracy(spark, name, label, folds, held):
    scored = queries.QUERIES[name](spark, FOLDER).cache()
    assert scored.count() == 1000 and scored.filter((F.col("score") < 0) | (F.col("score") > 1) | F.col("score").isNull()).count() == 0
    assert scored.filter(F.col("held_out") != (fold("doc_id", folds) == held)).count() == 0
    predicted, truth = labelled(spark, scored, label, F.col("held_out"))
    assert (predicted == truth).mean() >= 0.95


def small_sample(n=120):
    rng = random.Random(2)
    toxic = [prose(i, 60) + f" you {rng.choice(['zork', 'blug'])}{rng.choice(['', 'ish', 'er'])} " + prose(i + 999, 60) for i in range(n)]
    clean = [prose(i + 5000, 120) for i in range(n)]
    return Sample(toxic + clean, np.array([1.0] * n + [0.0] * n), ["en", "fr"] * n, 0.5)


@pytest.fixture(scope="module")
def cnn():
    return toxicity.train_cnn(small_sample())


def test_cnn_learns_words_wherever_they_stand(cnn):
    filler = prose(77, 40_000)
    scores = toxicity.score_texts(cnn, [filler, filler + " zorkish zorkish", "blug " + filler, filler[:100_000] + " zork " + filler[100_000:]])
    assert scores[0] < scores[1:].min() / 5


def test_blocks_change_no_score(cnn):
    texts = [prose(i, 700) + " zork" for i in range(5)] + ["", None, "a b"]
    whole = toxicity.score_texts(cnn, texts)
    small = toxicity.CnnModel(**{**vars(cnn), "settings": toxicity.CnnSettings(block_words=50)})
    assert np.allclose(whole, toxicity.score_texts(small, texts), atol=1e-5)


def test_toxicity_cases(docs_of, odd_texts, cnn):
    docs = docs_of(odd_texts, ["en", None, "xx"] * 5)
    rows = {r["doc_id"]: r["score"] for r in toxicity.with_toxicity(docs, cnn, keep=["doc_id"]).collect()}
    assert len(rows) == len(odd_texts) and all(0 <= s <= 1 for s in rows.values()) and rows[6] == rows[7] and rows[0] == rows[1] == rows[2]
    kept = toxicity.drop_toxic(docs.unionByName(docs_of(["oh zork you blug zorker"], first=99)), cnn)
    assert kept.columns == docs.columns and 99 not in {r["doc_id"] for r in kept.collect()}
    assert toxicity.drop_toxic(docs.limit(0), cnn).count() == 0


@pytest.mark.parametrize("labels,score", [([1.0, 1.0], 1.0), ([], 0.0)])
def test_one_class_gives_the_share(labels, score):
    sample = Sample(["a b"] * len(labels), np.array(labels), [None] * len(labels), score)
    assert (toxicity.score_texts(toxicity.train_cnn(sample), ["", "x"]) == score).all()
    assert (quality.score_texts(quality.train_mil(sample), ["", "x"]) == score).all()


def test_no_labels_at_all(spark, docs_of):
    docs, labels = docs_of(["a", "b"]), spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert toxicity.fit_toxicity(docs, labels, F.lit(True)).table is None
    assert not quality.fit_quality(docs, labels, F.lit(True)).weights


def test_threshold_lies_in_the_gap():
    assert toxicity.best_threshold(np.array([0.9, 0.8, 0.4, 0.1]), np.array([1, 1, 0, 0])) == pytest.approx(0.6)
    assert toxicity.best_threshold(np.array([0.5, 0.5]), np.array([1, 0])) <= 0.5


def test_platt_gives_the_prior():
    slope, offset = platt(np.zeros(100), np.array([1.0] * 50 + [0.0] * 50), 0.1)
    assert 1 / (1 + np.exp(-offset)) == pytest.approx(0.1, abs=0.03) and slope >= 0


@pytest.fixture(scope="module")
def mil():
    good = [prose(i, 150) for i in range(120)]
    poor = [prose(i + 900, 70) + " " + " ".join(f"{w}%%%" for w in prose(i, 80).split()) for i in range(120)]
    return quality.train_mil(Sample(good + poor, np.array([1.0] * 120 + [0.0] * 120), ["en"] * 240, 0.5))


def test_quality_cases(docs_of, odd_texts, mil):
    docs = docs_of(odd_texts)
    rows = {r["doc_id"]: r["score"] for r in quality.with_quality(docs, mil, keep=["doc_id"]).collect()}
    assert len(rows) == len(odd_texts) and all(0 <= s <= 1 for s in rows.values()) and rows[6] == rows[7] and rows[0] == rows[1] == rows[2]
    junk = " ".join(f"{w}%%%" for w in prose(3, 200).split())
    kept = quality.drop_poor(docs.unionByName(docs_of([junk, prose(4, 200)], first=98)), mil)
    ids = {r["doc_id"] for r in kept.collect()}
    assert kept.columns == docs.columns and 98 not in ids and 99 in ids
    assert quality.drop_poor(docs.limit(0), mil).count() == 0


def test_attention_sums_to_one_and_covers_the_text(mil):
    text = prose(8, 200)
    parts = quality.attention(mil, text)
    assert " ".join(p for p, _ in parts) == text and sum(a for _, a in parts) == pytest.approx(1, abs=1e-4)


def test_a_bag_does_not_depend_on_its_neighbours(mil):
    texts = [prose(i, 130 + i) for i in range(6)] + [None]
    alone = np.concatenate([quality.score_texts(mil, [t]) for t in texts])
    assert np.allclose(alone, quality.score_texts(mil, texts), atol=1e-5)
