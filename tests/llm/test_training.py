import numpy as np
import pyarrow as pa
import pytest
from llm_helpers import prose
from pyspark import TaskContext
from pyspark.sql import functions as F

from catchlake.llm import common, toxicity, training
from catchlake.session import materialize


def of(spark, texts, toxic, first=0):
    docs = spark.createDataFrame([(first + i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(first + i, y) for i, y in enumerate(toxic)], "doc_id long, toxic int")
    return docs, labels


def test_long_texts_are_learned_from(spark):
    """The only toxic words stand in texts of more than 20,000 characters."""
    texts = [prose(i, 5000) + " zork " + prose(i, 20) for i in range(25)] + [prose(i + 500, 60) for i in range(75)]
    assert min(map(len, texts[:25])) > 20_000
    docs, labels = of(spark, texts, [1] * 25 + [0] * 75)
    model = toxicity.fit_toxicity(docs, labels, F.lit(True), toxicity.CnnSettings(buckets=1 << 14, steps=200))
    scores = toxicity.score_texts(model, [prose(900, 60), "zork " + prose(900, 60)])
    assert scores[1] > 20 * scores[0]


@pytest.fixture
def many(spark, monkeypatch):
    """Rows of several shards, a null text, labels given twice, without an id, without a value and without a text."""
    monkeypatch.setattr(training, "SHARD_ROWS", 100)
    texts = [prose(i % 40, 30) + (" blug " if i % 3 == 0 else " mild ") + prose(i % 7, 10) for i in range(600)]
    texts[7] = None
    docs, labels = of(spark, texts, [int(i % 3 == 0) for i in range(600)])
    return texts, docs, labels.unionByName(labels.limit(50)).unionByName(spark.createDataFrame([(None, 1), (3, None), (9999, 1)], labels.schema))


def test_every_labelled_row_is_counted(many):
    texts, docs, labels = many
    s = toxicity.CnnSettings(buckets=1 << 10)
    data = training.labelled_words(docs, labels, "toxic", F.lit(True), s.folds, lambda: toxicity._worder(s), "test-words")
    assert data.rows.count() == 600 and data.total == 601 and data.rows.select("_shard").distinct().count() > 3
    seen, n = toxicity._seen(data.rows, s)
    plain, cache = np.zeros((2, s.buckets)), toxicity._cache(s)
    for i, t in enumerate(texts):
        w = toxicity._words(t, cache)
        for part in (w & 0xFFFFFFFF, w >> 32):
            plain[int(i % 3 == 0), np.unique(part)] += 1
    assert n.sum(axis=0).tolist() == [400, 200] and (seen.sum(axis=0) == plain).all()
    made = training.counted_logits(data.rows, lambda c: (np.arange(len(c.words)), np.array([float(len(w)) for w in c.words])))
    assert made[3].sum() == 600 and (made[0] * made[3]).sum() == sum(len(toxicity._words(t, cache)) for t in texts)


def test_shards_are_averaged(many):
    _, docs, labels = many
    s = toxicity.CnnSettings(buckets=1 << 12, steps=300)
    one, two = (toxicity.fit_toxicity(docs.repartition(n), labels, F.lit(True), s) for n in (2, 5))
    assert (one.table == two.table).all() and one.scale == two.scale  # however the rows come
    scores = toxicity.score_texts(one, ["mild " + prose(77, 40), "blug " + prose(77, 40)])
    assert scores[0] < 0.3 and scores[1] > 0.7


def test_a_change_is_the_mean_over_the_shards_that_made_it(spark):
    rows = materialize(spark.createDataFrame([(i, 0, 0, "", [i]) for i in range(4)], "_shard int, _fold int, _label int, _lang string, _words array<bigint>"), "shards")

    def learn(k, state, chunk, fit, rng):
        word = int(chunk.words[0][0])
        state[0]["w"][word // 2] += word + 1
        state[1]["w"][word // 2] += 2 * word

    state = ({"w": np.zeros((5, 2), np.float32)}, {"w": np.ones((5, 2), np.float32)})
    (w, sums), = training.averaged_round(rows, [state], 2, learn, (1,))
    assert w["w"].tolist() == [[1.5, 1.5], [3.5, 3.5], [0, 0], [0, 0], [0, 0]]
    assert sums["w"].tolist() == [[2, 2], [6, 6], [1, 1], [1, 1], [1, 1]]


def test_a_task_learns_one_state_and_the_driver_holds_them_once(spark):
    """Each state has its own tasks, and the arrays given are changed in place."""
    rows = materialize(spark.createDataFrame([(0, 5, 0, "", [i]) for i in range(4)], "_shard int, _fold int, _label int, _lang string, _words array<bigint>").coalesce(1), "shards")

    def learn(k, state, chunk, fit, rng):
        state[0]["w"] += 1 + TaskContext.get().partitionId()

    states = [({"w": np.zeros((40_000, 2), np.float32)}, {"w": np.ones((40_000, 2), np.float32)}) for _ in range(3)]
    given = [w["w"] for w, _ in states]
    after = training.averaged_round(rows, states, 2, learn, (1,))
    assert [(w["w"].min(), w["w"].max()) for w, _ in after] == [(1, 1), (2, 2), (3, 3)]  # the task of each state
    assert all(np.shares_memory(w["w"], g) for (w, _), g in zip(after, given, strict=True))


def kept_now(spark, keeps):
    """What a worker keeps after it was asked to keep something, seen by the next task."""
    def seen(batches):
        yield from batches
    ask = lambda batches: (common.kept_in_worker(bytes, 10 ** 6), *batches)[1:]
    one = spark.range(1).coalesce(1)
    common.map_batches(one, ask, "id long", keeps=True).collect()
    common.map_batches(one, seen, "id long", keeps=keeps).collect()
    return common.map_batches(one, lambda batches: (pa.RecordBatch.from_pydict({"id": [len(common._KEPT)]}) for _ in batches), "id long", keeps=True).first()["id"]


def test_a_worker_lets_go_of_what_another_operator_kept(spark):
    assert kept_now(spark, True) == 1 and kept_now(spark, False) == 0


def test_the_driver_sends_and_receives_one_state_at_a_time(many, monkeypatch):
    """The states of the folds are trained one after the other, and only models of the folds are sent to be scored with."""
    _, docs, labels = many
    sent, context = [], docs.sparkSession.sparkContext
    broadcast = context.broadcast

    def watched(value):
        sent.append(value)
        return broadcast(value)

    monkeypatch.setattr(context, "broadcast", watched)
    s = toxicity.CnnSettings(buckets=1 << 12, steps=300)
    received, averaged = [], toxicity.averaged_round
    monkeypatch.setattr(toxicity, "averaged_round", lambda rows, states, *a, **k: received.append(len(states)) or averaged(rows, states, *a, **k))
    model = toxicity.fit_toxicity(docs, labels, F.lit(True), s)
    assert received == [1] * (s.folds + 1) * s.rounds
    assert len(sent) == len(received) + 1 and len(sent[-1]) == s.folds
    assert not any((m.table == model.table).all() for m in sent[-1])
