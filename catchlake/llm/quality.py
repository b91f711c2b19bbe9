"""Quality classifier: attention-based multiple-instance learning over the passages of a document.

A document is a bag of passages of 64 words; a word of more than 31 characters goes in as consecutive pieces of 31, so that the
whole text counts, be it without blanks. Each passage is encoded from the mean of hashed word and word-shape
embeddings and a few rates (repeated word triples, symbols, capitals, lengths). Gated attention gives each passage a
weight, the weighted sum of passages is the document's representation, and a logistic layer scores it. Only document
labels are known, so the attention learns which passages matter. Trained in numpy on a bounded sample.

Cases: null and empty texts and texts without words are a bag of one empty passage; a very long text is encoded whole;
repeated rows get equal scores. With labels of one class only (or none) every score is the share of label 1.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass, field
from functools import partial

import numpy as np
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catchlake.llm.common import Sample, TwoAges, free_name, give_back, platt, sigmoid, training_sample, with_text_columns, word_cache

SHAPE = re.compile(r"(.)\1+", re.DOTALL)
RATES = 6
PIECE = 31  #: the most characters of a word whose length and symbols fit the bits kept of them


@dataclass(frozen=True)
class MilSettings:
    buckets: int = 1 << 16
    shapes: int = 1 << 12
    dim: int = 12
    hidden: int = 16
    gate: int = 8
    passage: int = 64
    epochs: int = 6
    batch: int = 16
    rate: float = 0.05
    max_rows: int = 4000  #: bound of the training sample, half of each class
    max_chars: int = 20_000  #: longer texts are not learned from
    held_back: float = 0.2
    steps: int = 1000  #: small samples are gone through more often, up to so many steps
    block_words: int = 1 << 17
    seed: int = 11


@dataclass
class MilModel:
    settings: MilSettings
    prior: float
    weights: dict[str, np.ndarray] = field(default_factory=dict)
    scale: tuple[float, float] = (1.0, 0.0)


def words_of(text: str | None) -> list[str]:
    """The words of a text, long ones in pieces."""
    words = (text or "").split()
    if max(map(len, words), default=0) <= PIECE:
        return words
    return [w[i:i + PIECE] for w in words for i in range(0, len(w), PIECE)]


def word_facts(word: str, buckets: int, shapes: int) -> int:
    """Of a word of PIECE characters at most: word row (16 bits), shape row (12), length (6), symbols (5), capitals flag (1) and 20 more bits of the hash."""
    data = word.encode("utf-8", "surrogatepass")
    code = zlib.crc32(data)
    kinds = "".join("A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c for c in word)
    shape = zlib.crc32(SHAPE.sub(r"\1\1", kinds).encode("utf-8", "surrogatepass"))
    symbols = sum(not c.isalnum() and c not in ".,;:'\"-" for c in word)
    capitals = word.isupper() and len(word) > 1
    more = zlib.adler32(data) ^ zlib.crc32(data, 99)
    return (code % buckets) | (shape % shapes) << 16 | len(word) << 28 | symbols << 34 | capitals << 39 | (more & 0xFFFFF) << 40


def _cache(s: MilSettings) -> TwoAges:
    return word_cache(partial(word_facts, buckets=s.buckets, shapes=s.shapes))


def _repeated(words: np.ndarray) -> np.ndarray:
    """For each word, whether the triple that begins there occurs more than once in the text."""
    out = np.zeros(len(words), np.float32)
    if len(words) > 3:
        w = words.astype(np.uint64)
        key = (w[:-2] * np.uint64(0x9E3779B97F4A7C15)) ^ (w[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F)) ^ (w[2:] * np.uint64(0x165667B19E3779F9))
        order = np.argsort(key, kind="stable")
        same = key[order][1:] == key[order][:-1]
        hit = np.zeros(len(key), bool)
        hit[order[1:]] |= same
        hit[order[:-1]] |= same
        out[:len(key)] = hit
    return out


@dataclass
class Bags:
    """Passages of several texts: packed words, where each passage starts, its rates, and where each bag starts."""

    words: np.ndarray
    starts: np.ndarray
    rates: np.ndarray
    bags: np.ndarray


def _bags(texts: list[np.ndarray], s: MilSettings) -> Bags:
    words = np.concatenate(texts)
    repeated = np.concatenate([_repeated(t) for t in texts])
    counts = [-(-len(t) // s.passage) for t in texts]
    first = np.concatenate([[0], np.cumsum([len(t) for t in texts])[:-1]])
    starts = np.concatenate([a + s.passage * np.arange(n) for a, n in zip(first, counts, strict=True)])
    size = np.diff(np.append(starts, len(words))).astype(np.float32)
    mean = lambda x: np.add.reduceat(x.astype(np.float32), starts) / size
    length, symbols, capitals = words >> 28 & 63, words >> 34 & 31, words >> 39 & 1
    rates = np.stack([mean(repeated), mean(np.minimum(symbols, 4)) / 2, mean(symbols > 0), mean(capitals), mean(length) / 8,
                      size / s.passage], axis=1)
    return Bags(words, starts, rates, np.concatenate([[0], np.cumsum(counts)[:-1]]))


def _layout(texts: list, cache: TwoAges, s: MilSettings):
    """Bags of about block_words words; a longer text is a block of its own."""
    block, size = [], 0
    for text in texts:
        words = cache.of(words_of(text))
        words = words if len(words) else np.zeros(1, np.int64)
        if block and size + len(words) > s.block_words:
            yield _bags(block, s)
            block, size = [], 0
        block.append(words)
        size += len(words)
    if block:
        yield _bags(block, s)


def _forward(w: dict[str, np.ndarray], b: Bags, s: MilSettings) -> dict:
    rows, shapes = b.words & 0xFFFF, b.words >> 16 & 0xFFF
    size = np.diff(np.append(b.starts, len(b.words))).astype(np.float32)[:, None]
    mean = np.empty((len(b.starts), s.dim), np.float32)
    for a in range(0, len(b.starts), 2048):  # bounds the table of vectors, also for a very long text
        z = min(a + 2048, len(b.starts))
        lo, hi = b.starts[a], b.starts[z] if z < len(b.starts) else len(b.words)
        mean[a:z] = np.add.reduceat(w["word"][rows[lo:hi]] + w["shape"][shapes[lo:hi]], b.starts[a:z] - lo, axis=0)
    mean /= size
    x = np.concatenate([mean, b.rates], axis=1)
    h = np.tanh(x @ w["enc"] + w["enc_b"])
    left, right = np.tanh(h @ w["tanh"]), sigmoid(h @ w["gate"])
    raw = (left * right) @ w["att"]
    counts = np.diff(np.append(b.bags, len(b.starts)))
    e = np.exp(raw - np.repeat(np.maximum.reduceat(raw, b.bags), counts))
    a = e / np.repeat(np.add.reduceat(e, b.bags), counts)
    z = np.add.reduceat(a[:, None] * h, b.bags, axis=0)
    return {"x": x, "h": h, "left": left, "right": right, "a": a, "z": z, "counts": counts, "rows": rows, "shapes": shapes,
            "size": size, "logit": z @ w["out"] + w["out_b"][0]}


def _start(s: MilSettings) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(s.seed)
    r = lambda *shape, by=0.3: rng.normal(0, by, shape).astype(np.float32)
    return {"word": r(s.buckets, s.dim, by=0.02), "shape": r(s.shapes, s.dim, by=0.1), "enc": r(s.dim + RATES, s.hidden),
            "enc_b": r(s.hidden, by=0.01), "tanh": r(s.hidden, s.gate), "gate": r(s.hidden, s.gate), "att": r(s.gate),
            "out": r(s.hidden), "out_b": r(1, by=0.01)}


def train_mil(sample: Sample, s: MilSettings = MilSettings()) -> MilModel:
    """Fit on a bounded sample in the driver: stochastic gradients with Adagrad, sparse in the embedding tables."""
    if len(set(sample.labels.tolist())) < 2:
        return MilModel(s, sample.prior)
    cache, rng = _cache(s), np.random.default_rng(s.seed)
    order = rng.permutation(len(sample.texts))
    back = max(2, int(len(order) * s.held_back))
    held, fit = order[:back], order[back:]
    if len(set(sample.labels[fit].tolist())) < 2 or len(set(sample.labels[held].tolist())) < 2:
        held = fit = order
    words = {int(i): w if len(w := cache.of(words_of(sample.texts[i]))) else np.zeros(1, np.int64) for i in fit}
    w = _start(s)
    sums = {k: np.full(v.shape, 1e-3, np.float32) for k, v in w.items()}
    for _ in range(max(s.epochs, -(-s.steps * s.batch // len(fit)))):
        rng.shuffle(fit)
        for at in range(0, len(fit), s.batch):
            ids = fit[at:at + s.batch]
            b = _bags([words[int(i)] for i in ids], s)
            f = _forward(w, b, s)
            error = (sigmoid(f["logit"]) - sample.labels[ids]) / len(ids)
            dz = error[:, None] * w["out"]
            each = np.repeat(dz, f["counts"], axis=0)
            da = (each * f["h"]).sum(axis=1)
            inner = np.repeat(np.add.reduceat(f["a"] * da, b.bags), f["counts"])
            draw = f["a"] * (da - inner)
            dpair = draw[:, None] * w["att"]
            dleft, dright = dpair * f["right"] * (1 - f["left"] ** 2), dpair * f["left"] * f["right"] * (1 - f["right"])
            dh = f["a"][:, None] * each + dleft @ w["tanh"].T + dright @ w["gate"].T
            dpre = dh * (1 - f["h"] ** 2)
            dmean = ((dpre @ w["enc"].T)[:, :s.dim] / f["size"]).astype(np.float32)
            grads = {"enc": f["x"].T @ dpre, "enc_b": dpre.sum(axis=0), "tanh": f["h"].T @ dleft, "gate": f["h"].T @ dright,
                     "att": (f["left"] * f["right"]).T @ draw, "out": f["z"].T @ error + 1e-4 * w["out"], "out_b": error.sum()[None]}
            for k, g in grads.items():
                sums[k] += (g * g).astype(np.float32)
                w[k] -= (s.rate * g / np.sqrt(sums[k])).astype(np.float32)
            per_word = np.repeat(dmean, f["size"][:, 0].astype(np.int64), axis=0)
            for k, ids_of in (("word", f["rows"]), ("shape", f["shapes"])):
                by = np.argsort(ids_of, kind="stable")
                unique, first = np.unique(ids_of[by], return_index=True)
                g = np.add.reduceat(per_word[by], first, axis=0)
                sums[k][unique] += g * g
                w[k][unique] -= s.rate * g / np.sqrt(sums[k][unique])
    model = MilModel(s, sample.prior, w)
    model.scale = platt(_logits(model, [sample.texts[i] for i in held], cache), sample.labels[held], sample.prior)
    return model


def _logits(model: MilModel, texts: list, cache: TwoAges) -> np.ndarray:
    parts = [_forward(model.weights, b, model.settings)["logit"] for b in _layout(texts, cache, model.settings)]
    return np.concatenate(parts).astype(np.float64) if parts else np.zeros(0)


def score_texts(model: MilModel, texts: list, cache: TwoAges | None = None) -> np.ndarray:
    """Scores from 0 to 1 of whole texts."""
    if not model.weights:
        return np.full(len(texts), model.prior)
    logits = _logits(model, texts, cache if cache is not None else _cache(model.settings))
    return sigmoid(model.scale[0] * logits + model.scale[1])


def attention(model: MilModel, text: str) -> list[tuple[str, float]]:
    """The passages of one text with their attention weights, to see what a score rests on."""
    words = words_of(text)
    b = next(_layout([text], _cache(model.settings), model.settings))
    a = _forward(model.weights, b, model.settings)["a"]
    p = model.settings.passage
    return [(" ".join(words[i * p:(i + 1) * p]), float(x)) for i, x in enumerate(a)]


def _scorer(model: Broadcast):
    cache = _cache(model.value.settings)
    return lambda texts: [score_texts(model.value, texts, cache)]


def fit_quality(docs: DataFrame, labels: DataFrame, train: Column, settings: MilSettings = MilSettings()) -> MilModel:
    """Learn labels.quality from rows of labels that satisfy train."""
    model = train_mil(training_sample(docs, labels, "quality", train, settings.max_rows, settings.max_chars), settings)
    give_back()  # the driver has no more use for the sample
    return model


def with_quality(docs: DataFrame, model: MilModel, text: str = "text", score: str = "score", keep=None) -> DataFrame:
    """Add the score of every whole text. Texts stay where they are: no shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # its size is fixed by the settings: 4 MB
    return with_text_columns(docs, text, [T.StructField(score, T.DoubleType())], partial(_scorer, shared), keep)


def drop_poor(docs: DataFrame, model: MilModel, threshold: float = 0.3) -> DataFrame:
    """The documents whose score reaches the threshold, with their columns."""
    score = free_name(docs, "quality_score")
    return with_quality(docs, model, score=score).filter(F.col(score) >= threshold).drop(score)
