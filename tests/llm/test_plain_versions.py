"""The trained models, the shards and the robust estimate against plain versions written out here."""

import collections
import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from catchlake.llm import outliers, quality, sharding, toxicity
from catchlake.llm.common import Sample, table
from llm_helpers import prose

CNN = dict(buckets=512, dim=3, filters=2, epochs=1, steps=1, batch=14, drop=0.0, rate=0.05)
MIL = dict(buckets=1 << 16, dim=3, hidden=4, gate=3, epochs=1, steps=1, batch=16, passage=8, rate=0.05)


def gradient_of(before, after, rate):
    """The gradient of Adagrad's first step, from what it changed: the step is rate * g / sqrt(0.001 + g * g)."""
    r = np.clip((np.asarray(before, np.float64) - np.asarray(after, np.float64)) / rate, -0.999999, 0.999999)
    return np.sign(r) * np.sqrt(1e-3 * r * r / (1 - r * r))


def slope(loss, array, at, eps=1e-5):
    kept = array[at]
    array[at] = kept + eps
    up = loss()
    array[at] = kept - eps
    down = loss()
    array[at] = kept
    return (up - down) / (2 * eps)


def some(array, n=12):
    every = list(itertools.product(*map(range, array.shape)))
    return random.Random(3).sample(every, min(n, len(every)))


def texts_of(n, seed):
    rng = random.Random(seed)
    return [" ".join(rng.choice(["Ab", "cd", "EF", "g%", "12", "lo", "Mi!", "x" * 40]) for _ in range(rng.randint(1, 25))) for _ in range(n)]


def plain_cnn(parts, text):
    """The logit of one text, word by word."""
    s = parts["settings"]
    packed = [toxicity.word_rows(w, s.buckets, s.prefix) for w in text.lower().split()] or [0]
    vectors = [parts["table"][p & 0xFFFFFFFF] + parts["table"][p >> 32] for p in packed]
    pooled = []
    for kernel in parts["kernels"]:
        for f in range(s.filters):
            pooled.append(max(sum(float(kernel[j][:, f] @ vectors[i + j]) for j in range(len(kernel)) if i + j < len(vectors))
                              for i in range(len(vectors))))
    return sum(max(p + b, 0.0) * o for p, b, o in zip(pooled, parts["bias"], parts["out"], strict=True)) + parts["offset"]


def parts_of(model):
    wide = lambda x: np.asarray(x, np.float64).copy()
    return {"settings": model.settings, "table": wide(model.table), "kernels": [wide(k) for k in model.kernels], "bias": wide(model.bias),
            "out": wide(model.out), "offset": float(model.offset)}


def test_cnn_scores_and_gradients_against_plain_ones(monkeypatch):
    s = toxicity.CnnSettings(**CNN)
    begin = toxicity._start

    def untied(*args):
        """Words of equal log odds tie for the maximum, where a slope is not defined."""
        model = begin(*args)
        model.table[1:] += np.random.default_rng(1).normal(0, 0.05, model.table[1:].shape).astype(np.float32)
        return model

    monkeypatch.setattr(toxicity, "_start", untied)
    texts, labels = texts_of(14, 5), np.array([1.0, 0.0] * 4 + [0.0] * 6)
    cache = toxicity._cache(s)
    words = [cache.of(t.lower().split()) for t in texts]
    every = np.arange(len(texts))
    start, after = toxicity._start(s, 0.0, words, labels), toxicity._fit(words, labels, every, s)
    for model in (start, after):
        assert np.allclose(toxicity._logits(model, texts, cache), [plain_cnn(parts_of(model), t) for t in texts], atol=1e-5)
    parts = parts_of(start)
    weight = np.where(labels == 1, 0.5 / labels.mean(), 0.5 / (1 - labels.mean()))

    def loss():
        logits = np.array([plain_cnn(parts, t) for t in texts])
        return (weight * (np.logaddexp(0, logits) - labels * logits)).mean() + 0.5e-4 * (parts["out"] ** 2).sum()

    # a word row that the largest response of a filter rests on, and others
    rows = sorted({int(p) & 0xFFFFFFFF for w in words for p in w})
    pairs = [(parts["bias"], start.bias, after.bias), (parts["out"], start.out, after.out),
             *zip(parts["kernels"], start.kernels, after.kernels, strict=True)]
    for mine, before, trained in pairs:
        found = gradient_of(before, trained, s.rate)
        for at in some(mine):
            assert slope(loss, mine, at) == pytest.approx(found[at], abs=2e-4)
    found = gradient_of(start.table, after.table, s.rate)
    for at in itertools.product(rows[:10], range(s.dim)):
        assert slope(loss, parts["table"], at) == pytest.approx(found[at], abs=2e-4)
    assert found[toxicity.PAD].tolist() == [0.0] * s.dim


def test_training_of_the_filters_beats_their_start():
    """What is toxic here is the order of two words, which no log odds of single words show."""
    rng = random.Random(12)

    def text(i, toxic):
        words = prose(i, 40).split()
        at = rng.randrange(len(words))
        one, two = ("zork", "blug") if toxic else ("blug", "zork")
        return " ".join([*words[:at], one, two, *words[at:]])

    labels = np.array([1.0, 0.0] * 600)
    texts = [text(i, y == 1) for i, y in enumerate(labels)]
    learn, held = slice(0, 800), slice(800, 1200)
    s = toxicity.CnnSettings(buckets=1 << 14, epochs=20)
    cache = toxicity._cache(s)
    words = [cache.of(t.lower().split()) for t in texts[learn]]
    right = lambda model: (((x := toxicity._logits(model, texts[held], cache)) > np.median(x)) == (labels[held] == 1)).mean()
    start = right(toxicity._start(s, 0.5, words, labels[learn]))
    trained = right(toxicity._fit(words, labels[learn], np.arange(800), s))
    assert start < 0.65 and trained > 0.9


def plain_mil(w, s, text):
    """The logit of one text: passages encoded word by word, gated attention, weighted sum."""
    words = quality.words_of(text) or [None]
    facts = [quality.word_facts(x, s.buckets, s.shapes) if x is not None else 0 for x in words]
    triples = collections.Counter(zip(facts, facts[1:], facts[2:], strict=False)) if len(facts) > 3 else {}
    hidden, raw = [], []
    for a in range(0, len(facts), s.passage):
        own = facts[a:a + s.passage]
        mean = sum(w["word"][x & 0xFFFF] + w["shape"][x >> 16 & 0xFFF] for x in own) / len(own)
        again = sum(triples.get(tuple(facts[i:i + 3]), 0) > 1 for i in range(a, a + len(own)))
        symbols = [x >> 34 & 31 for x in own]
        rates = [again / len(own), sum(min(x, 4) for x in symbols) / len(own) / 2, sum(x > 0 for x in symbols) / len(own),
                 sum(x >> 39 & 1 for x in own) / len(own), sum(x >> 28 & 63 for x in own) / len(own) / 8, len(own) / s.passage]
        h = np.tanh(np.concatenate([mean, rates]) @ w["enc"] + w["enc_b"])
        hidden.append(h)
        raw.append(float((np.tanh(h @ w["tanh"]) / (1 + np.exp(-(h @ w["gate"])))) @ w["att"]))
    share = np.exp(np.array(raw) - max(raw))
    share /= share.sum()
    return float(sum(a * h for a, h in zip(share, hidden, strict=True)) @ w["out"] + w["out_b"][0])


def test_attention_scores_and_gradients_against_plain_ones():
    s = quality.MilSettings(**MIL)
    texts, labels = texts_of(20, 8), np.array([1.0, 0.0] * 10)
    order = np.random.default_rng(s.seed).permutation(len(texts))  # as training holds back the first fifth of it
    fit = order[4:]
    assert len(set(labels[fit])) == 2 == len(set(labels[order[:4]]))
    start, after = quality._start(s), quality.train_mil(Sample(texts, labels, ["en"] * 20, 0.5), s)
    wide = {k: np.asarray(v, np.float64).copy() for k, v in start.items()}
    cache = quality._cache(s)
    odd = [*texts, "", None, "a", "same same same " * 9, "=" * 700]
    for weights in (start, after.weights):
        w = {k: np.asarray(v, np.float64) for k, v in weights.items()}
        assert np.allclose(quality._logits(quality.MilModel(s, 0.5, weights), odd, cache), [plain_mil(w, s, t) for t in odd], atol=1e-5)

    def loss():
        logits = np.array([plain_mil(wide, s, texts[i]) for i in fit])
        return (np.logaddexp(0, logits) - labels[fit] * logits).mean() + 0.5e-4 * (wide["out"] ** 2).sum()

    facts = [cache[x] for i in fit for x in quality.words_of(texts[i])]
    places = {"word": [(int(x) & 0xFFFF, d) for x in sorted(set(facts))[:6] for d in range(s.dim)],
              "shape": [(int(x) >> 16 & 0xFFF, d) for x in sorted(set(facts))[:6] for d in range(s.dim)]}
    for k in start:
        found = gradient_of(start[k], after.weights[k], s.rate)
        for at in places.get(k) or some(wide[k]):
            assert slope(loss, wide[k], at) == pytest.approx(found[at], abs=2e-4), k


@pytest.mark.parametrize("shards", [5, 24])
def test_interleaving_against_a_plain_one(spark, shards):
    docs = table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text", "source")
    docs = docs.unionByName(docs.limit(7)).unionByName(docs.limit(3).selectExpr("doc_id", "text", "CAST(NULL AS STRING) AS source"))
    docs = docs.unionByName(docs.limit(2).selectExpr("CAST(NULL AS BIGINT) AS doc_id", "CAST(NULL AS STRING) AS text", "source"))
    body = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", F.col("source").alias("_source"), (F.octet_length(body) + 8).cast("bigint").alias("size"),
                       F.crc32(body.cast("binary")).alias("text_crc32"))
    seed, unit = 17, 1 << 20
    shuffled = rows.select("*", F.xxhash64(F.lit(seed), "doc_id", *rows.columns).alias("mix"), F.xxhash64(F.lit(seed), "_source").alias("mix2"),
                           F.pmod(F.xxhash64(F.lit(seed), F.hex(F.col("_source").cast("string"))), F.lit(unit)).alias("offset")).collect()
    first_null = lambda x: (x is not None, x if x is not None else 0)
    by_source = collections.defaultdict(list)
    for r in shuffled:
        by_source[r["_source"]].append(r)
    ranked, position = [], 0
    for source in sorted(by_source, key=lambda x: (x is not None, x or "")):
        own = sorted(by_source[source], key=lambda r: (r["mix"], first_null(r["doc_id"]), r["size"], r["text_crc32"]))
        for rank, r in enumerate(own):
            offset = r["offset"] / unit
            ranked.append(((rank + offset) / len(own), r["mix2"], position, r))
            position += 1
    ranked.sort(key=lambda x: x[:3])
    want = []
    for place, (_, _, _, r) in enumerate(ranked):
        shard = place * shards // len(ranked)
        want.append((r["doc_id"], r["size"], r["text_crc32"], shard, place - math.ceil(shard * len(ranked) / shards)))
    got = sharding.shard_documents(docs, shards).select("doc_id", "size", "text_crc32", "shard", "slot").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def plain_mcd(x, s, starts=40, steps=30):
    """Minimum covariance determinant by concentration from random starts, rows sorted by their distance."""
    rng = np.random.default_rng(5)
    h, best = math.ceil(len(x) * s.share), None

    def near(rows):
        centre, cov = rows.mean(axis=0), np.cov(rows.T, bias=True)
        d = np.einsum("ij,jk,ik->i", x - centre, np.linalg.inv(cov), x - centre)
        return x[np.argsort(d, kind="stable")[:h]], np.linalg.det(cov)

    for _ in range(starts):
        rows = x[rng.choice(len(x), 12, replace=False)]
        for _ in range(steps):
            rows, _ = near(rows)
        det = np.linalg.det(np.cov(rows.T, bias=True))
        if best is None or det < best[0]:
            best = det, rows
    rows = best[1]
    return rows.mean(axis=0), np.cov(rows.T, bias=True) * outliers.consistency(s.share)


def test_robust_estimate_against_a_plain_one(spark):
    rng = np.random.default_rng(3)
    mix = rng.normal(0, 1, (5, 5)) + 2 * np.eye(5)
    clean = rng.normal(0, 1, (900, 5)) @ mix.T + 40
    odd = rng.normal(0, 1, (150, 5)) @ mix.T + 40 + 12 * mix[:, 0]
    x = np.round(np.concatenate([clean, odd]) * outliers.SCALE).astype(int)
    s = outliers.McdSettings()
    df = spark.createDataFrame([("a", *map(int, r)) for r in x], "_g string, x0 long, x1 long, x2 long, x3 long, x4 long")
    found = outliers.estimates_of(df, s)
    row = found.first()
    centre, cov = plain_mcd(x / outliers.SCALE, s)
    root = np.zeros((5, 5))
    for i, j in outliers.PAIRS:
        root[i, j] = row[f"w{i}{j}"]
    own = np.linalg.inv(root.T @ root)
    assert np.abs(np.array([row[f"m{i}"] for i in range(5)]) - centre).max() < 0.15 * np.sqrt(np.diag(cov)).max()
    assert np.linalg.det(own) == pytest.approx(np.linalg.det(cov), rel=0.25)
    d = np.einsum("ij,jk,ik->i", x / outliers.SCALE - centre, np.linalg.inv(cov), x / outliers.SCALE - centre)
    theirs = df.join(F.broadcast(found), "_g").select(*[f"x{i}" for i in range(5)], outliers.distance().alias("d")).collect()
    by_row = {tuple(r[f"x{i}"] for i in range(5)): r["d"] for r in theirs}
    mine = np.array([by_row[tuple(map(int, r))] for r in x])
    assert np.corrcoef(np.log(d), np.log(mine))[0, 1] > 0.99
    assert ((d > s.cut) == (mine > s.cut)).mean() > 0.98
    assert (mine[900:] > s.cut).all() and (mine[:900] > s.cut).mean() < 0.02
