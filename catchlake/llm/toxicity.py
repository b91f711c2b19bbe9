"""Toxicity: a convolutional text classifier over hashed word embeddings, trained on all labelled rows.

Every word has two hashed rows in one embedding table, one by the word and one by its first letters, which are added.
Filters of several widths run over the words of the whole text, each filter keeps its largest response (max pooling),
and a logistic layer turns the pooled responses into a score, calibrated on scores that models of other folds give. Thresholds for a decision
are calibrated by language on the same scores; the language decides about the threshold only, never about the score.

Cases: null and empty texts and texts without words are scored as one padding word; a very long text is scored whole, in
overlapping blocks whose maxima are merged; repeated rows get equal scores. With labels of one class only (or none) every
score is the share of label 1. An unknown or null language takes the threshold of all languages together, and so does a language that the
labelled rows have fewer than 10 rows of either class of, since so few rows say nothing about where to cut.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass, field
from functools import partial

import numpy as np
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catchlake.llm.common import Sample, TwoAges, free_name, give_back, platt, sigmoid, with_text_columns, word_cache
from catchlake.llm.training import Chunk, State, averaged_round, counted, counted_logits, labelled_words

PAD = 0
STRIP = ".,;:!?\"'()[]{}<>*#$%&|-_/\\«»¡¿…"


@dataclass(frozen=True)
class CnnSettings:
    buckets: int = 1 << 18
    dim: int = 8
    widths: tuple[int, ...] = (1, 2, 3)
    filters: int = 8
    prefix: int = 4
    epochs: int = 8
    rounds: int = 4  #: passes through rows of several shards, averaged after each
    batch: int = 32
    rate: float = 0.05
    folds: int = 3  #: for calibration, scores of each fold come from a model of the others
    steps: int = 1000  #: few rows are gone through more often, up to so many steps
    drop: float = 0.3  #: of the words in a step, so that more than one word of a text is learned
    doubt: float = 2.0
    block_words: int = 1 << 15
    seed: int = 7


@dataclass
class CnnModel:
    settings: CnnSettings
    prior: float
    table: np.ndarray | None = None
    kernels: list[np.ndarray] = field(default_factory=list)  #: one array (width, dim, filters) for each width
    bias: np.ndarray | None = None
    out: np.ndarray | None = None
    offset: float = 0.0
    scale: tuple[float, float] = (1.0, 0.0)
    thresholds: dict[str, float] = field(default_factory=dict)
    threshold: float = 0.5


def word_rows(word: str, buckets: int, prefix: int) -> int:
    """Two rows of the embedding table, packed into one integer; row 0 is padding."""
    plain = word.strip(STRIP) or word
    first = zlib.crc32(plain.encode("utf-8", "surrogatepass"))
    second = zlib.crc32(b"^" + plain[:prefix].encode("utf-8", "surrogatepass"))
    return (1 + first % (buckets - 1)) | (1 + second % (buckets - 1)) << 32


def _cache(s: CnnSettings) -> TwoAges:
    return word_cache(partial(word_rows, buckets=s.buckets, prefix=s.prefix))


def _words(text: str | None, cache: TwoAges) -> np.ndarray:
    """The packed words of a text, one of padding where it has none."""
    words = cache.of((text or "").lower().split())
    return words if len(words) else np.zeros(1, np.int64)


def _layout(texts: list[np.ndarray], s: CnnSettings):
    """Blocks of at most about block_words words: packed words with padding between texts, where each part of a text
    starts, whose text it is, and which rows are padding. Parts of one text overlap by the widest filter less one."""
    reach = max(s.widths) - 1
    parts, owners, size = [], [], 0
    for i, words in enumerate(texts):
        for at in range(0, len(words), s.block_words):
            part = words[at:at + s.block_words + reach]
            if size and size + len(part) > s.block_words:
                yield _pack(parts, reach), np.array(owners)
                parts, owners, size = [], [], 0
            parts.append(part)
            owners.append(i)
            size += len(part) + reach
    if parts:
        yield _pack(parts, reach), np.array(owners)


def _pack(parts: list[np.ndarray], reach: int):
    gap = np.zeros(reach, np.int64)
    flat = np.concatenate([x for p in parts for x in (p, gap)])
    sizes = np.array([len(p) for p in parts])
    starts = np.concatenate([[0], np.cumsum(sizes + reach)[:-1]])
    dead = (starts + sizes)[:, None] + np.arange(reach)
    return flat, starts, sizes, dead.ravel()


def _responses(model: CnnModel, flat: np.ndarray, dead: np.ndarray):
    """The words' vectors and, for each width, the filters' responses at each word; padding can't win."""
    vectors = model.table[flat & 0xFFFFFFFF] + model.table[flat >> 32]
    made = []
    for kernel in model.kernels:
        r = vectors @ kernel[0]
        for j in range(1, len(kernel)):
            r[:-j] += vectors[j:] @ kernel[j]
        r[dead] = -1e9
        made.append(r)
    return vectors, made


def _logits(model: CnnModel, texts: list, cache: TwoAges) -> np.ndarray:
    return _logits_of([_words(t, cache) for t in texts], model)


def _logits_of(texts: list[np.ndarray], model: CnnModel) -> np.ndarray:
    pooled = np.full((len(texts), len(model.bias)), -1e9, np.float32)
    for (flat, starts, _, dead), owners in _layout(texts, model.settings):
        top = np.concatenate([np.maximum.reduceat(r, starts, axis=0) for r in _responses(model, flat, dead)[1]], axis=1)
        np.maximum.at(pooled, owners, top)
    return np.maximum(pooled + model.bias, 0).astype(np.float64) @ model.out + model.offset


def _start(s: CnnSettings, prior: float, words: list[np.ndarray], labels: np.ndarray) -> CnnModel:
    """The start for rows in memory."""
    seen = np.zeros((2, s.buckets))
    for w, y in zip(words, labels, strict=True):
        for rows in (w & 0xFFFFFFFF, w >> 32):
            seen[int(y), np.unique(rows)] += 1
    return _start_of(s, prior, seen, np.array([(1 - labels).sum(), labels.sum()]))


def _start_of(s: CnnSettings, prior: float, seen: np.ndarray, texts: np.ndarray) -> CnnModel:
    """Random weights, with one dimension that begins at the log odds of the rows: max pooling passes gradients to single
    words only, so it needs words worth looking at from the first step. seen counts the texts of each label that have a
    row of the table, texts all of them."""
    rng = np.random.default_rng(s.seed)
    table = rng.normal(0, 0.05, (s.buckets, s.dim)).astype(np.float32)
    pos, neg = seen[1] / max(texts[1], 1), seen[0] / max(texts[0], 1)
    doubt = s.doubt / max(min(texts), 1)  # so many rows' worth of even odds
    table[:, 0] = np.clip(np.log((pos + doubt) / (neg + doubt)), -3, 6) / 2
    table[PAD] = 0
    kernels = [rng.normal(0, 0.2, (w, s.dim, s.filters)).astype(np.float32) for w in s.widths]
    kernels[0][0, :, 0] = 0
    kernels[0][0, 0, 0] = 1
    n = s.filters * len(s.widths)
    return CnnModel(s, prior, table, kernels, np.zeros(n, np.float32), np.full(n, 0.1), 0.0)


def train_cnn(sample: Sample, s: CnnSettings = CnnSettings()) -> CnnModel:
    """Fit on texts in memory, all of them; fit_toxicity does the same with all labelled rows of a table, by shards."""
    if len(set(sample.labels.tolist())) < 2:
        return CnnModel(s, sample.prior)
    cache = _cache(s)
    words = [_words(t, cache) for t in sample.texts]
    every = np.arange(len(words))
    model = _fit(words, sample.labels, every, s)
    model.prior = sample.prior
    of = np.empty(len(words), np.int64)
    for label in (0, 1):  # each fold has its share of both
        own = np.flatnonzero(sample.labels == label)
        of[np.random.default_rng(s.seed).permutation(own)] = np.arange(len(own)) % s.folds
    logits = np.zeros(len(words))
    for fold in range(s.folds):
        rest = every[of != fold]
        part = _fit(words, sample.labels, rest, s) if len(set(sample.labels[rest].tolist())) == 2 else model
        logits[of == fold] = _logits_of([words[i] for i in every[of == fold]], part)
    return _calibrated(model, logits, sample.labels, sample.langs, np.ones(len(words)))


def _calibrated(model: CnnModel, logits: np.ndarray, labels: np.ndarray, langs: list, counts: np.ndarray) -> CnnModel:
    """Set the scale and the thresholds by logits that stand for so many rows each."""
    model.scale = platt(logits, labels, model.prior, counts)
    scores = sigmoid(model.scale[0] * logits + model.scale[1])
    model.threshold = best_threshold(scores, labels, counts=counts)
    langs = np.array([x or "" for x in langs])
    for lang in sorted(set(langs.tolist()) - {""}):
        own = langs == lang
        if min((counts * labels)[own].sum(), (counts * (1 - labels))[own].sum()) >= 10:
            model.thresholds[lang] = best_threshold(scores[own], labels[own], counts=counts[own])
    return model


def _weights(model: CnnModel) -> dict[str, np.ndarray]:
    kernels = {f"kernel{k}": x for k, x in enumerate(model.kernels)}
    return {"table": model.table, **kernels, "bias": model.bias, "out": model.out, "offset": np.array([model.offset])}


def _model_of(s: CnnSettings, prior: float, w: dict[str, np.ndarray]) -> CnnModel:
    kernels = [w[f"kernel{k}"] for k in range(len(s.widths))]
    return CnnModel(s, prior, w["table"], kernels, w["bias"], w["out"], float(w["offset"][0]))


def _first_sums(w: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    return {k: np.full(v.shape, 1e-3, np.float32 if k == "table" else np.float64) for k, v in w.items()}


def _fit(words: list[np.ndarray], labels: np.ndarray, fit: np.ndarray, s: CnnSettings) -> CnnModel:
    """Stochastic gradients over rows in memory."""
    w = _weights(_start(s, 0.0, [words[i] for i in fit], labels[fit]))
    weight = (0.5 / (1 - labels[fit].mean()), 0.5 / labels[fit].mean())  # both classes count alike
    _learn((w, _first_sums(w)), words, labels, fit, weight, s, np.random.default_rng(s.seed), _rounds(s, len(fit)))
    return _model_of(s, 0.0, w)


def _rounds(s: CnnSettings, rows: int) -> int:
    return max(s.epochs, -(-s.steps * s.batch // rows))


def _best_words(model: CnnModel, words: list[np.ndarray], rng: np.random.Generator):
    """Of each text and filter the largest response, and for each width the words it rests on, some words being left out. A long
    text goes in blocks, so memory is bounded."""
    s = model.settings
    pooled = np.full((len(words), len(model.bias)), -np.inf)
    picked = [np.zeros((len(words), s.filters, width), np.int64) for width in s.widths]
    for (flat, starts, sizes, dead), owners in _layout(words, s):
        flat = np.where(rng.random(len(flat)) < s.drop, PAD, flat)
        _, made = _responses(model, flat, dead)
        for k, r in enumerate(made):
            best = np.stack([r[a:a + n].argmax(axis=0) + a for a, n in zip(starts, sizes, strict=True)])
            top = np.take_along_axis(r, best, axis=0)
            rests = flat[np.minimum(best[:, :, None] + np.arange(len(model.kernels[k])), len(flat) - 1)]
            own = slice(k * s.filters, (k + 1) * s.filters)
            if len(set(owners.tolist())) == len(owners):
                larger = top > pooled[owners, own]
                pooled[owners, own] = np.where(larger, top, pooled[owners, own])
                picked[k][owners] = np.where(larger[:, :, None], rests, picked[k][owners])
                continue
            for i, part in enumerate(owners):  # parts of one text in one block
                larger = top[i] > pooled[part, own]
                pooled[part, own] = np.where(larger, top[i], pooled[part, own])
                picked[k][part] = np.where(larger[:, None], rests[i], picked[k][part])
    return pooled, picked


def _learn(state: State, words: list[np.ndarray], labels: np.ndarray, fit: np.ndarray, weight: tuple[float, float], s: CnnSettings,
           rng: np.random.Generator, rounds: int) -> None:
    """Stochastic gradients with Adagrad, sparse in the embedding table; changes the state. weight is that of a row of each label."""
    w, sums = state
    model = _model_of(s, 0.0, w)
    dense = [*(f"kernel{k}" for k in range(len(s.widths))), "bias", "out", "offset"]
    for _ in range(rounds):
        fit = rng.permutation(fit)
        for at in range(0, len(fit), s.batch):
            ids = fit[at:at + s.batch]
            model.offset = float(w["offset"][0])
            pooled, picked = _best_words(model, [words[i] for i in ids], rng)
            act = np.maximum(pooled + model.bias, 0)
            error = np.take(weight, labels[ids].astype(np.int64)) * (sigmoid(act @ model.out + model.offset) - labels[ids]) / len(ids)
            back_act = error[:, None] * model.out * (act > 0)
            grads, rows, changes = [], [], []
            for k, kernel in enumerate(model.kernels):
                d = back_act[:, k * s.filters:(k + 1) * s.filters]
                grad = np.zeros(kernel.shape)
                for j in range(len(kernel)):
                    own = picked[k][:, :, j]
                    halves = (own & 0xFFFFFFFF, own >> 32)
                    grad[j] = np.einsum("bf,bfd->df", d, model.table[halves[0]] + model.table[halves[1]])
                    change = (d[:, :, None] * kernel[j].T).reshape(-1, s.dim)
                    for half in halves:
                        rows.append(half.ravel())
                        changes.append(change)
                grads.append(grad)
            grads += [back_act.sum(axis=0), act.T @ error + 1e-4 * model.out, error.sum()[None]]
            for k, g in zip(dense, grads, strict=True):
                sums[k] += g * g
                w[k] -= (s.rate * g / np.sqrt(sums[k])).astype(w[k].dtype)
            unique, inverse = np.unique(np.concatenate(rows), return_inverse=True)
            g = np.zeros((len(unique), s.dim), np.float32)
            np.add.at(g, inverse, np.concatenate(changes).astype(np.float32))
            g[unique == PAD] = 0
            sums["table"][unique] += g * g
            w["table"][unique] -= s.rate * g / np.sqrt(sums["table"][unique])


def best_threshold(scores: np.ndarray, labels: np.ndarray, least: float = 0.3, most: float = 0.9, counts: np.ndarray | None = None) -> float:
    """The threshold of the best F1; where several cuts are equally good, the middle of the widest gap. A score counts for so many rows."""
    order = np.argsort(-scores, kind="stable")
    s, n = scores[order], np.ones(len(scores)) if counts is None else counts[order]
    y = labels[order] * n
    f1 = 2 * np.cumsum(y) / (np.cumsum(n) + y.sum())
    gap = np.append(s[:-1] - s[1:], s[-1])
    f1[gap <= 0] = -1
    ties = np.flatnonzero(f1 >= f1.max() - 1e-12)
    at = ties[np.argmax(gap[ties])]
    return float(np.clip(s[at] - gap[at] / 2, least, most))


def score_texts(model: CnnModel, texts: list, cache: TwoAges | None = None) -> np.ndarray:
    """Scores from 0 to 1 of whole texts."""
    if model.table is None:
        return np.full(len(texts), model.prior)
    logits = _logits(model, texts, cache if cache is not None else _cache(model.settings))
    return sigmoid(model.scale[0] * logits + model.scale[1])


def _scorer(model: Broadcast):
    cache = _cache(model.value.settings)
    return lambda texts: [score_texts(model.value, texts, cache)]


def _worder(s: CnnSettings):
    cache = _cache(s)
    return lambda text: _words(text, cache)


def fit_toxicity(docs: DataFrame, labels: DataFrame, train: Column, settings: CnnSettings = CnnSettings()) -> CnnModel:
    """Learn labels.toxic from all rows of labels that satisfy train, and calibrate on scores that models of other folds give."""
    s = settings
    data = labelled_words(docs, labels, "toxic", train, s.folds, partial(_worder, s), "toxicity-words")
    seen, texts = _seen(data.rows, s)
    if min(texts.sum(axis=0)) == 0:
        return CnnModel(s, data.prior)
    shards = data.rows.select("_shard").distinct().count()
    every = int(texts.sum())
    rounds, each = (s.rounds, max(1, -(-s.steps * s.batch // (every * s.rounds)))) if shards > 1 else (1, _rounds(s, every))
    models = []
    for k in range(s.folds + 1):  # the model of all rows, and one without each fold; one after the other, so the driver holds one state
        rest = np.arange(s.folds) != k - 1
        if min(texts[rest].sum(axis=0)) == 0:
            rest[:] = True
        w = _weights(_start_of(s, data.prior, seen[rest].sum(axis=0), texts[rest].sum(axis=0)))
        states = [(w, _first_sums(w))]
        weight = tuple(0.5 * texts[rest].sum() / texts[rest].sum(axis=0))
        for i in range(rounds):
            states = averaged_round(data.rows, states, s.dim, partial(_learn_chunk, weight, s, each), (s.seed, i), first=k)
        models.append(_model_of(s, data.prior, states[0][0]))
        del w, states
    del seen
    model, *others = models
    shared = data.rows.sparkSession.sparkContext.broadcast(others)
    del models, others
    give_back()
    logits, truth, langs, counts = counted_logits(data.rows, partial(_held_out, shared))
    shared.destroy()
    del shared
    give_back()  # the driver goes on with the one model
    return _calibrated(model, logits, truth, langs, counts)


def _seen(rows: DataFrame, s: CnnSettings) -> tuple[np.ndarray, np.ndarray]:
    """Texts by fold and label that have a row of the table, and all texts by fold and label."""
    def count(chunks):
        for chunk in chunks:
            found = np.zeros((s.folds, 2, s.buckets + 1), np.int64)  # the last for all texts
            for w, fold, y in zip(chunk.words, chunk.folds, chunk.labels.astype(np.int64), strict=True):
                for part in (w & 0xFFFFFFFF, w >> 32):
                    found[fold, y, np.unique(part)] += 1
                found[fold, y, -1] += 1
            at = np.nonzero(found)
            yield {"fold": at[0], "label": at[1], "row": at[2], "n": found[at]}

    made = counted(rows, "fold label row", count)
    every = np.zeros((s.folds, 2, s.buckets + 1))
    for batch in made.to_batches():
        every[tuple(batch.column(c).to_numpy() for c in ("fold", "label", "row"))] = batch.column("n").to_numpy()
    return every[:, :, :-1], every[:, :, -1]


def _learn_chunk(weight: tuple[float, float], s: CnnSettings, rounds: int, k: int, state: State, chunk: Chunk, fit: np.ndarray,
                 rng: np.random.Generator) -> None:
    _learn(state, chunk.words, chunk.labels, fit, weight, s, rng, rounds)


def _held_out(shared: Broadcast, chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Each row's logit by the model that has not seen its fold."""
    logits = np.zeros(len(chunk.words))  # shared holds the models of the folds, without that of all rows
    for fold in set(chunk.folds.tolist()):
        own = np.flatnonzero(chunk.folds == fold)
        logits[own] = _logits_of([chunk.words[i] for i in own], shared.value[fold])
    return np.arange(len(logits)), logits


def with_toxicity(docs: DataFrame, model: CnnModel, text: str = "text", score: str = "score", keep=None) -> DataFrame:
    """Add the score of every whole text. Texts stay where they are: no shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # its size is fixed by the settings: 8 MB
    return with_text_columns(docs, text, [T.StructField(score, T.DoubleType())], partial(_scorer, shared), keep)


def threshold_of(model: CnnModel, lang: str = "lang") -> Column:
    """The calibrated threshold of a row's language."""
    out = F.lit(model.threshold)
    for name, value in sorted(model.thresholds.items()):
        out = F.when(F.col(lang) == name, value).otherwise(out)
    return out


def drop_toxic(docs: DataFrame, model: CnnModel) -> DataFrame:
    """The documents whose score is below the threshold of their language, with their columns."""
    score = free_name(docs, "toxicity_score")
    return with_toxicity(docs, model, score=score).filter(F.col(score) < threshold_of(model)).drop(score)
