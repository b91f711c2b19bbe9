"""What several operators share: frames of texts through Arrow, bounded training samples, cached word features."""

from __future__ import annotations

import gc
import tempfile
import zipfile
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

BATCH_ROWS = 512
ARROW_ROWS_KEY, ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", "1000"
ASCII_UPPER, ASCII_LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give this package to the Python workers of all executors, once an application, as a zip file by addPyFile."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix="ship-")) / f"{root.name}.zip"  # the driver's copy, which Spark serves to executors
    with zipfile.ZipFile(target, "w") as out:
        for file in sorted(root.rglob("*.py")):
            out.write(file, file.relative_to(root.parent))
    context.addPyFile(str(target))
    _SHIPPED.add(context.applicationId)


def fold(doc_id: str, folds: int) -> Column:
    """The fold of a row: crc32 of the id's text, by remainder."""
    return F.crc32(F.col(doc_id).cast("string")) % folds


def lower_ascii(text: Column) -> Column:
    """A-Z only, as bytes.lower() does; other letters stay."""
    return F.translate(text, ASCII_UPPER, ASCII_LOWER)


def free_name(df: DataFrame, stem: str) -> str:
    """A column name that the frame does not have, whatever the letters' case."""
    taken = {c.lower() for c in df.columns}
    while stem.lower() in taken:
        stem += "_"
    return stem


_KEPT: dict[tuple, object] = {}


def kept_in_worker(make: Callable, *args):
    """What make(*args) gives, made once in a Python worker, which keeps it until a task asks for something else or asks for nothing (see map_batches)."""
    key = (make, *args)
    if key not in _KEPT:
        _KEPT.clear()
        _KEPT[key] = make(*args)
    return _KEPT[key]


def let_go() -> None:
    """Drop what this Python worker keeps."""
    if _KEPT:
        _KEPT.clear()
        give_back()


def give_back() -> None:
    """Give memory that is free back to the machine."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    pa.system_memory_pool().release_unused()


def map_batches(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: T.StructType | str,
                keeps: bool = False) -> DataFrame:
    """mapInArrow with this package on the workers.

    A worker goes on to other tasks, so memory is given back at a task's end. Only tasks that keep something (keeps, see kept_in_worker) leave
    it to those that follow; others let go of it before they begin.

    Where the session has Spark's default of 10,000 rows an Arrow batch, it is set to 1000 for the session, since texts are long and a
    batch lies in memory several times; another setting is left as it is.
    """
    ship_package(df.sparkSession)
    if df.sparkSession.conf.get(ARROW_ROWS_KEY) == "10000":
        df.sparkSession.conf.set(ARROW_ROWS_KEY, ARROW_ROWS)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not keeps:
            let_go()
        yield from run(batches)
        give_back()

    return df.mapInArrow(whole, schema)


def with_text_columns(df: DataFrame, text: str, fields: Sequence[T.StructField], factory: Callable[[], Callable],
                      keep: Sequence[str] | None = None, keeps: bool = False) -> DataFrame:
    """Add columns made from a text column, in Arrow batches.

    factory is called once a task and returns a function from a list of texts (None for null) to one list or array per
    field. keep names the columns that go on (all by default); one that has the name of a new field is replaced. keeps is that of map_batches.
    """
    names = [f.name for f in fields]
    kept = [c for c in (df.columns if keep is None else keep) if c not in names]
    kinds = [to_arrow_type(f.dataType) for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = factory()
        for whole in batches:
            for at in range(0, max(whole.num_rows, 1), BATCH_ROWS):  # bounds what Python holds of a batch
                batch = whole.slice(at, BATCH_ROWS)
                made = work(batch.column(text).to_pylist()) if batch.num_rows else [[] for _ in fields]
                columns = [batch.column(c) for c in kept] + [pa.array(c, type=k) for c, k in zip(made, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=kept + names)

    schema = T.StructType([df.schema[c] for c in kept] + list(fields))
    return map_batches(df.select(*dict.fromkeys([*kept, text])), run, schema, keeps)


@dataclass(frozen=True)
class Sample:
    """A bounded labelled sample and what the whole of the labelled rows says about the classes."""

    texts: list[str]
    labels: np.ndarray
    langs: list[str | None]
    prior: float  #: share of label 1 among all rows to learn from


def training_sample(docs: DataFrame, labels: DataFrame, label: str, train: Column, max_rows: int,
                    max_chars: int) -> Sample:
    """At most max_rows labelled texts for the driver, half of each class, chosen by a hash of the id.

    The sample is bounded by max_rows and max_chars together (texts over max_chars are not learned from, though they are
    scored whole). Rows without a label are left out; an id labelled twice counts once, by its larger label.
    """
    rows = (labels.filter(train & F.col(label).isin(0, 1) & F.col("doc_id").isNotNull())
            .groupBy("doc_id").agg(F.max(label).alias("_label")))
    counts = {r["_label"]: r["count"] for r in rows.groupBy("_label").count().collect()}
    halves = [rows.filter(F.col("_label") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows // 2)
              for c in (0, 1)]
    picked = F.broadcast(halves[0].unionByName(halves[1]))  # max_rows rows at most
    columns = [F.col("text").alias("_text"), F.col("lang").alias("_lang")]
    texts = (docs.select("doc_id", *columns).filter(F.length("_text") <= max_chars).join(picked, "doc_id")
             .orderBy("doc_id", "_text", "_lang").limit(max_rows).toArrow().to_pydict())
    total = sum(counts.values())
    return Sample(texts["_text"], np.array(texts["_label"], dtype=np.float64), texts["_lang"],
                  counts.get(1, 0) / total if total else 0.0)


class TwoAges(dict):
    """A dict that makes what it lacks, with bounded memory: when it is full its entries become the old age, and old
    entries that are asked for again come back. So frequent keys stay and rare ones go."""

    def __init__(self, make: Callable, limit: int):
        super().__init__()
        self.make, self.limit, self.old = make, limit, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)  # never None
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value

    def of(self, keys: list) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, keys), np.int64, len(keys))


def word_cache(features: Callable[[str], int]) -> TwoAges:
    """Features of words as integers, computed once a word while it is in use."""
    return TwoAges(features, 200_000)


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def platt(logits: np.ndarray, labels: np.ndarray, prior: float, counts: np.ndarray | None = None) -> tuple[float, float]:
    """Slope and offset that turn logits into probabilities at the given share of label 1 (Platt's smoothed targets). A logit counts
    for so many rows."""
    n = np.ones(len(labels)) if counts is None else np.asarray(counts, np.float64)
    pos, neg = (n * labels).sum(), (n * (1 - labels)).sum()
    target = np.where(labels == 1, (pos + 1) / (pos + 2), 1 / (neg + 2))
    weight = np.where(labels == 1, prior / max(pos, 1), (1 - prior) / max(neg, 1)) * n.sum() * n
    mean = (n * logits).sum() / n.sum()
    spread = max(float(np.sqrt((n * (logits - mean) ** 2).sum() / n.sum())), 1e-6)
    x = np.stack([logits / spread, np.ones(len(logits))], axis=1)
    loss = lambda v: (weight * (np.logaddexp(0, x @ v) - target * (x @ v))).sum() + 0.01 * v[0] ** 2
    v = np.zeros(2)
    for _ in range(100):
        p = sigmoid(x @ v)
        grad = x.T @ (weight * (p - target)) + [0.02 * v[0], 0]
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag([0.02, 1e-6])
        step = np.linalg.solve(hess, grad)
        size = 1.0
        while size > 1e-6 and loss(v - size * step) > loss(v):
            size /= 2
        v = v - size * step
        if np.abs(size * step).max() < 1e-8:
            break
    return float(max(v[0], 0.0) / spread), float(v[1])
