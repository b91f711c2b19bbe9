"""Training of a classifier on every labelled row: shards learn at the same time, and what they change is averaged.

The labelled texts are joined to their labels, turned into packed words once and written, a file for each shard. In a
round, every shard starts from the shared state and goes through its own rows (stochastic gradients with Adagrad, see
the classifiers). A row of a table is changed by the mean over the shards that touched it, and its squared gradients grow by
one number for the row, the mean of all of them. Changes are summed as whole numbers, so the order of the sum makes no
difference. What comes to the driver is as large as the state, whatever the
number of rows.

Cases: rows without a label or an id are left out; an id labelled twice counts once, by its larger label; null texts are
learned from as empty ones, as they are scored. A shard is read in chunks, so that neither many rows nor long texts have
to lie in memory at once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catchlake.llm.common import BATCH_ROWS, give_back, map_batches
from catchlake.operators.sizing import measured
from catchlake.session import materialize

SHARD_ROWS = 8192  #: about so many rows in a shard; there are as many shards as the rows ask for
CHUNK_ROWS, CHUNK_WORDS = 2 * SHARD_ROWS, 1 << 22  #: a longer shard is gone through in chunks of so much
PIECE_ROWS = 1 << 14  #: rows in a batch of counts or changes
UNIT = 2.0 ** 28  #: changes are counted in parts of so many to one
GRID, FINE = 256, 2.0 ** 20  #: logits are counted in cells of 1/GRID, of which the mean logit is kept

#: A model's weights and its sums of squared gradients, by name.
State = tuple[dict[str, np.ndarray], dict[str, np.ndarray]]


@dataclass(frozen=True)
class Labelled:
    """All labelled rows as packed words, written, and what the labels say about the classes."""

    rows: DataFrame  #: _shard, _fold, _label, _lang, _words
    total: int  #: labelled ids
    prior: float  #: share of label 1 among them


@dataclass(frozen=True)
class Chunk:
    shard: int
    labels: np.ndarray
    folds: np.ndarray
    langs: list
    words: list[np.ndarray]


def labelled_words(docs: DataFrame, labels: DataFrame, label: str, train: Column, folds: int, factory: Callable[[], Callable], name: str) -> Labelled:
    """The labelled texts as words; factory is called once a task and returns a function from a text to its packed words."""
    rows = (labels.filter(train & F.col(label).isin(0, 1) & F.col("doc_id").isNotNull())
            .groupBy("doc_id").agg(F.max(label).alias("_label")))
    counts = {r["_label"]: r["count"] for r in rows.groupBy("_label").count().collect()}
    total = sum(counts.values())
    n = max(1, -(-total // SHARD_ROWS))
    texts = docs.select("doc_id", F.col("text").alias("_text"), F.col("lang").alias("_lang"))
    joined = texts.join(measured(rows=rows)["rows"], "doc_id").repartition(n, "doc_id").select(
        F.pmod(F.hash("doc_id"), F.lit(n)).cast("int").alias("_shard"), F.pmod(F.xxhash64("doc_id"), F.lit(folds)).cast("int").alias("_fold"),
        F.col("_label").cast("int").alias("_label"), "_lang", "_text", F.col("doc_id").alias("_key"))
    ordered = joined.sortWithinPartitions("_shard", "_key", "_text", "_lang").drop("_key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = factory()
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH_ROWS):
                batch = whole.slice(at, BATCH_ROWS)
                words = [work(t) for t in batch.column("_text").to_pylist()]
                ends = np.cumsum([0, *map(len, words)])
                for lo in _runs(ends):  # the offsets of a list column are of 31 bits
                    part = slice(lo[0], lo[1])
                    made = pa.ListArray.from_arrays(pa.array(ends[lo[0]:lo[1] + 1] - ends[lo[0]], pa.int32()), pa.array(np.concatenate(words[part]), pa.int64()))
                    own = batch.slice(lo[0], lo[1] - lo[0])
                    yield pa.RecordBatch.from_arrays([own.column(c) for c in ("_shard", "_fold", "_label", "_lang")] + [made], names=["_shard", "_fold", "_label", "_lang", "_words"])

    packed = map_batches(ordered, run, "_shard int, _fold int, _label int, _lang string, _words array<bigint>")
    return Labelled(materialize(packed, name), total, counts.get(1, 0) / total if total else 0.0)


def _runs(ends: np.ndarray) -> Iterator[tuple[int, int]]:
    """Rows in runs of about CHUNK_WORDS words."""
    first = 0
    for i in range(1, len(ends)):
        if ends[i] - ends[first] >= CHUNK_WORDS or i == len(ends) - 1:
            yield first, i
            first = i


def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[Chunk]:
    """Rows that follow each other in a shard, of one shard at a time."""
    held, size = [], 0

    def made() -> Chunk:
        shard, fold, label, lang, words = zip(*held, strict=True)
        return Chunk(shard[0], np.array(label, np.float64), np.array(fold), list(lang), list(words))

    for batch in batches:
        lists = batch.column("_words")
        flat, ends = lists.values.to_numpy(), lists.offsets.to_numpy()
        plain = [batch.column(c).to_pylist() for c in ("_shard", "_fold", "_label", "_lang")]
        for i, row in enumerate(zip(*plain, strict=True)):
            words = flat[ends[i]:ends[i + 1]]
            if held and (row[0] != held[0][0] or len(held) >= CHUNK_ROWS or size + len(words) > CHUNK_WORDS):
                yield made()
                held, size = [], 0
            held.append((*row, words))
            size += len(words)
    if held:
        yield made()


def counted(rows: DataFrame, keys: str, count: Callable[[Iterator[Chunk]], Iterator[dict]]) -> pa.Table:
    """Sums over all rows of the counts that tasks give as columns: the whole-number keys and n."""
    names = keys.split()
    schema = ", ".join(f"{k} int" for k in names) + ", n bigint"

    def run(batches):
        for made in count(chunks(batches)):
            yield from _in_pieces([*(made[k] for k in names), made["n"]], [pa.int32()] * len(names) + [pa.int64()], [*names, "n"])

    return map_batches(rows, run, schema).groupBy(*names).agg(F.sum("n").alias("n")).toArrow()


def _in_pieces(columns: list[np.ndarray], kinds: list[pa.DataType], names: list[str]) -> Iterator[pa.RecordBatch]:
    """The columns in batches of PIECE_ROWS rows, since a batch lies in the worker and beside the JVM's heap at the same time."""
    for at in range(0, len(columns[0]), PIECE_ROWS):
        yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c[at:at + PIECE_ROWS]), k) for c, k in zip(columns, kinds, strict=True)], names=names)


def averaged_round(rows: DataFrame, states: list[State], width: int, learn: Callable[[int, State, Chunk, np.ndarray, np.random.Generator], None],
                   seed: tuple[int, ...], first: int = 0) -> list[State]:
    """The states after every shard has learned from its rows and the changes are averaged; those given are changed in place, so the driver
    holds them once.

    The states given are numbered from first on. State 0 learns from all rows, state k from those that are not of fold k - 1. learn changes
    the state of the number it is given, by the rows of a chunk that it is given. Arrays are sent as rows of width numbers. States do not
    depend on each other, so they may be given one at a time where the driver is to hold, send and receive only one.
    """
    numbers = [f"w{i}" for i in range(width)] + ["s"]
    schema = "model int, part int, row int, " + ", ".join(f"{c} bigint" for c in numbers)
    shared = [rows.sparkSession.sparkContext.broadcast(state) for state in states]

    def learned(k: int) -> DataFrame:
        """The changes of state k. Each state has its own tasks, so a worker never holds all of them."""
        begin_of = shared[k - first]

        def run(batches):
            before = begin_of.value
            for shard, own in groupby(chunks(batches), key=lambda c: c.shard):
                after = tuple({name: v.copy() for name, v in x.items()} for x in before)
                for no, chunk in enumerate(own):
                    fit = np.flatnonzero(chunk.folds != k - 1)
                    if len(fit):
                        learn(k, after, chunk, fit, np.random.default_rng([*seed, shard, no, k]))
                for part, name in enumerate(sorted(before[0])):
                    touched, whole = _changes(*(x[name] for x in (*before, *after)), width)
                    n = len(touched)
                    yield from _in_pieces([np.full(n, k), np.full(n, part), touched, *whole.T], [pa.int32()] * 3 + [pa.int64()] * len(numbers), ["model", "part", "row", *numbers])

        return map_batches(rows, run, schema)

    mean = [(F.sum(c) / F.count(F.lit(1)) / UNIT).cast("float").alias(c) for c in numbers]
    changes = reduce(DataFrame.unionByName, [learned(first + i) for i in range(len(states))])
    made = changes.groupBy("model", "part", "row").agg(*mean).toArrow()
    for x in shared:
        x.destroy()
    for batch in made.to_batches():  # a row comes once
        model, part, row = (batch.column(c).to_numpy() for c in ("model", "part", "row"))
        change = np.stack([batch.column(c).to_numpy() for c in numbers], axis=1)
        for k, (w, sums) in enumerate(states, first):
            for i, name in enumerate(sorted(w)):
                own = np.flatnonzero((model == k) & (part == i))
                for side, grown in ((w, change[own, :width]), (sums, change[own, width:])) if len(own) else ():
                    old = side[name]
                    table = _in_rows(old, width)
                    table[row[own]] += grown.astype(table.dtype)
                    side[name] = table.reshape(-1)[:old.size].reshape(old.shape)
    del made
    give_back()
    return states


def _in_rows(a: np.ndarray, width: int) -> np.ndarray:
    """The numbers in rows of width, filled up with zeros."""
    return np.append(a.reshape(-1), np.zeros(-a.size % width, a.dtype)).reshape(-1, width) if a.size % width else a.reshape(-1, width)


def _changes(w: np.ndarray, sums: np.ndarray, new_w: np.ndarray, new_sums: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The rows that have changed, and by how much, in whole numbers: each weight, and the mean of the row's squared gradients."""
    size = w.size
    w, sums, new_w, new_sums = (_in_rows(a, width) for a in (w, sums, new_w, new_sums))
    at = np.flatnonzero((sums != new_sums).any(axis=1) | (w != new_w).any(axis=1))
    by = new_w[at].astype(np.float64) - w[at]
    grown = (new_sums[at].astype(np.float64) - sums[at]).sum(axis=1) / np.minimum(width, size - at * width)
    return at, np.rint(np.column_stack([by, grown]) * UNIT).astype(np.int64)


def counted_logits(rows: DataFrame, logits: Callable[[Chunk], tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, list, np.ndarray]:
    """Logits, labels, languages and counts: logits gives a chunk's places and their logits. Every row is counted; those of a language
    and label whose logits lie in one cell of the grid count at their mean, so the driver gets as many as there are cells."""
    def run(batches):
        for chunk in chunks(batches):
            at, values = logits(chunk)
            yield pa.RecordBatch.from_arrays([pa.array([chunk.langs[i] for i in at], pa.string()), pa.array(chunk.labels[at].astype(np.int32)),
                                              pa.array(values, pa.float64())], names=["_lang", "_label", "_logit"])

    scored = map_batches(rows, run, "_lang string, _label int, _logit double")
    cell, fine = F.round(F.col("_logit") * GRID).cast("bigint"), F.round(F.col("_logit") * FINE).cast("bigint")
    made = (scored.groupBy("_lang", "_label", cell.alias("_cell")).agg(F.count(F.lit(1)).alias("n"), F.sum(fine).alias("s"))
            .orderBy("_lang", "_label", "_cell").toArrow())
    n = made.column("n").to_numpy()
    return made.column("s").to_numpy() / FINE / n, made.column("_label").to_numpy().astype(np.float64), made.column("_lang").to_pylist(), n
