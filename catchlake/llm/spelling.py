"""Grouping of spelling variants by k-d trees over letter-count vectors.

A word is a point whose coordinates say how often it has each letter. One inserted or deleted letter moves the point by 1, one replaced
letter by 2 (in the sum of absolute differences, L1), so near words are found by range searches: words of one length within 2, and words of
one length among those one letter longer within 1. Of what lies in the range the order of the letters is compared.

The upper part of each length's tree is made from a bounded sample of the vocabulary (`sample` words, chosen by hash). It only says how
the space is cut into cells; every word is in the cell that its point lies in, so the sample bears on the balance and never on the result. A
word visits the cells whose box its range touches: of its own length those behind its own cell, so that a pair meets once. Inside a cell
the lower part of the tree is built over the cell's words, and visitors stream past it in batches. Words with equal counts
(anagrams) share a point.

Counting words is one pass in Arrow batches with a bounded table of partial sums for each task; nothing but words and counts is shuffled.
The form of a word is its near word of the largest count where that is large enough, and the root follows forms by path
doubling, which ends after the logarithm of a chain whose counts grow by the factor at every step.

Cases: null and empty texts have no words; a null id stands as an empty text in what is hashed; repeated rows count as often as they stand
there; very long texts and words are taken whole; ties go to the word that comes first in code-point order; an empty table gives no
rows; other columns are not read, whatever their names.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catchlake.llm.common import map_batches
from catchlake.operators.sizing import measured
from catchlake.session import materialize

RUN = re.compile(rb"[a-z\xC0-\xFF]+")
LETTERS = 90  #: a to z and U+00C0 to U+00FF
CELL_BITS = 24


@dataclass(frozen=True)
class SpellingSettings:
    least_letters: int = 6
    least_count: int = 5
    factor: int = 5  #: a form's count is so many times the word's at least
    salt: int = 199  #: a run whose hash this divides loses a letter
    sample: int = 20_000  #: words that the cells are made from
    cell_words: int = 8192  #: words of a cell, about
    leaf_words: int = 48
    table: int = 200_000  #: words that a task counts at a time


def altered(run: bytes, prefix: int, salt: int) -> bytes:
    """The run, without one letter if the salt divides the crc32 of what precedes it and the run in UTF-8."""
    h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), prefix)
    if h % salt:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def word_counts(docs: DataFrame, s: SpellingSettings, key: str = "doc_id", text: str = "text") -> DataFrame:
    """word and n for all words of enough letters and occurrences."""
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def flushed(counts: dict) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([w.decode("latin-1") for w in counts], pa.string()), pa.array(counts.values(), pa.int64())], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[bytes, int] = defaultdict(int)
        for batch in batches:
            for id_, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                prefix = zlib.crc32(f"{id_ or ''}:".encode())
                # one byte for each code point: what has no letter's code becomes a question mark
                runs = Counter(RUN.findall((body.as_py() or "").encode("latin-1", "replace").lower()))
                for word, n in runs.items():
                    if len(word) >= s.least_letters:
                        word = altered(word, prefix, s.salt)
                        if len(word) >= s.least_letters:
                            counts[word] += n
                if len(counts) > s.table:
                    yield flushed(counts)
                    counts.clear()
        yield flushed(counts)

    rows = map_batches(docs.select(F.col(key).cast("string").alias("id"), F.col(text).alias("body")), run, "word string, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= s.least_count)


def letter_counts(words: list[bytes]) -> np.ndarray:
    """A row of letter counts for each word in Latin-1, 16 bits each (a count beyond is cut, which only widens a range)."""
    codes = np.frombuffer(b"".join(words), np.uint8)
    place = np.where(codes >= 0xC0, codes.astype(np.int64) - (0xC0 - 26), codes.astype(np.int64) - ord("a"))
    rows = np.repeat(np.arange(len(words)), [len(w) for w in words])
    counts = np.bincount(rows * LETTERS + place, minlength=len(words) * LETTERS).reshape(len(words), LETTERS)
    return np.minimum(counts, 30_000).astype(np.int16)


@dataclass
class Node:
    low: np.ndarray
    high: np.ndarray
    left: "Node | None" = None
    right: "Node | None" = None
    leaf: int = -1
    points: np.ndarray | None = None  #: rows of the points, in a leaf


def split(points: np.ndarray, rows: np.ndarray) -> tuple[int, int] | None:
    """The letter whose counts spread most, and the middle count; none if all points are one."""
    mine = points[rows]
    spread = mine.astype(np.float32).var(axis=0)
    letter = int(spread.argmax())
    if not spread[letter] > 0:
        return None
    counts = np.sort(mine[:, letter])
    middle = counts[(len(counts) - 1) // 2]
    return letter, int(middle if middle < counts[-1] else counts[counts < middle][-1])


def build(points: np.ndarray, most: int, tight: bool) -> tuple[Node, list[Node]]:
    """A k-d tree with leaves of at most so many points (more only where they are one point) and the list of its leaves.

    Boxes are those of the points if tight, else the whole of the space that the cuts leave.
    """
    top = np.iinfo(np.int16).max
    root = Node(np.zeros(LETTERS, np.int16), np.full(LETTERS, top, np.int16))
    leaves, open_ = [], [(root, np.arange(len(points)))]
    while open_:
        node, rows = open_.pop()
        if tight and len(rows):
            node.low, node.high = points[rows].min(axis=0), points[rows].max(axis=0)
        cut = split(points, rows) if len(rows) > most else None
        if cut is None:
            node.leaf, node.points = len(leaves), rows
            leaves.append(node)
            continue
        letter, last = cut
        below = points[rows, letter] <= last
        node.left, node.right = Node(node.low.copy(), node.high.copy()), Node(node.low.copy(), node.high.copy())
        node.left.high[letter], node.right.low[letter] = last, last + 1
        open_ += [(node.left, rows[below]), (node.right, rows[~below])]
    return root, leaves


def touched(root: Node, queries: np.ndarray, radius: int) -> Iterator[tuple[Node, np.ndarray, np.ndarray]]:
    """The leaves whose box lies within the radius of some queries, with those queries' rows and distances to the box."""
    open_ = [(root, np.arange(len(queries)))]
    while open_:
        node, rows = open_.pop()
        mine = queries[rows]
        away = (np.maximum(node.low - mine, 0) + np.maximum(mine - node.high, 0)).sum(axis=1, dtype=np.int64)
        near = away <= radius
        rows = rows[near]
        if not len(rows):
            continue
        if node.leaf >= 0:
            yield node, rows, away[near]
        else:
            open_ += [(node.left, rows), (node.right, rows)]


def presence(vectors: np.ndarray) -> np.ndarray:
    """Which letters a word has, as bits. An edit changes two letters' bits at most."""
    bits = np.uint64(1) << (np.arange(LETTERS, dtype=np.uint64) % np.uint64(64))
    return np.bitwise_or.reduce(np.where(vectors > 0, bits, np.uint64(0)), axis=1)


def letters_of(words: list[bytes], width: int) -> np.ndarray:
    return np.frombuffer(b"".join(words), np.uint8).reshape(len(words), width)


def one_edit(shorter: np.ndarray, longer: np.ndarray) -> np.ndarray:
    """Whether rows of letters differ by one replaced letter (equal widths) or by one more letter in the second."""
    width = shorter.shape[1]
    if width == longer.shape[1]:
        return (shorter != longer).sum(axis=1) == 1
    ahead = np.cumprod(shorter == longer[:, :width], axis=1, dtype=np.int32).sum(axis=1)
    behind = np.cumprod(shorter[:, ::-1] == longer[:, :0:-1], axis=1, dtype=np.int32).sum(axis=1)
    return ahead + behind >= width


class CellIndex:
    """The words of one cell, all of one length, as a k-d tree."""

    def __init__(self, words: list[bytes], leaf_words: int):
        self.letters = letters_of(words, len(words[0]))
        self.vectors = letter_counts(words)
        self.bits = presence(self.vectors)
        self.root, _ = build(self.vectors, leaf_words, True)

    def near(self, words: list[bytes], own: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Rows of words of one length (the cell's, if own, or one letter less) and of the cell's words that are one edit away.
        Among the cell's own words a pair comes once."""
        vectors, letters = letter_counts(words), letters_of(words, len(words[0]))
        radius = 2 if len(words[0]) == self.letters.shape[1] else 1
        bits = presence(vectors)
        for node, rows, _ in touched(self.root, vectors, radius):
            for at in range(0, len(rows), 4096):
                some = rows[at:at + 4096]
                q, p = np.nonzero(np.bitwise_count(bits[some][:, None] ^ self.bits[node.points][None, :]) <= radius)
                q, p = some[q], node.points[p]
                if own:
                    q, p = q[q < p], p[q < p]
                found = np.abs(vectors[q] - self.vectors[p]).sum(axis=1) <= radius
                q, p = q[found], p[found]
                found = one_edit(letters[q], self.letters[p])
                yield q[found], p[found]


def cells_of(words: DataFrame, s: SpellingSettings) -> dict[int, Node]:
    """The upper tree of every length in the sample, cut so that a cell has about cell_words words."""
    shape = words.agg(F.count("*").alias("n")).first()["n"]
    picked = words.select("word").orderBy(F.xxhash64("word"), "word").limit(s.sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [w.encode("latin-1") for w in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_pydict({"length": pa.array([len(w) for w in found], pa.int32()),
                                              "counts": pa.array([v.tobytes() for v in letter_counts(found)], pa.binary())})

    rows = map_batches(picked, run, "length int, counts binary").toArrow().to_pydict()  # as many rows as the sample has
    by_length = defaultdict(list)
    for length, counts in zip(rows["length"], rows["counts"]):
        by_length[length].append(np.frombuffer(counts, np.int16))
    each = max(1, int(s.cell_words * min(1.0, s.sample / max(shape, 1))))
    trees = {}
    for length, vectors in by_length.items():
        root, leaves = build(np.stack(vectors), each, False)
        if len(leaves) > 1:
            for leaf in leaves:
                leaf.points = None
            trees[length] = root
    return trees


def visits(words: DataFrame, trees: dict[int, Node]) -> DataFrame:
    """Rows (cell, visits, word, n): each word in its own cell (visits 0) and where its ranges reach (1)."""
    def reached(length: int, vectors: np.ndarray, radius: int):
        if length in trees:
            for node, rows, away in touched(trees[length], vectors, radius):
                yield node.leaf, rows, away
        else:
            yield 0, np.arange(len(vectors)), np.zeros(len(vectors), np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = [w.encode("latin-1") for w in batch.column(0).to_pylist()]
            lengths = np.array([len(w) for w in names], np.int64)
            for length in np.unique(lengths):
                mine = np.flatnonzero(lengths == length)
                vectors = letter_counts([names[i] for i in mine])
                found = list(reached(length, vectors, 2))
                own = np.zeros(len(mine), np.int64)
                for leaf, rows, away in found:
                    own[rows[away == 0]] = leaf
                parts = [(np.full(len(rows), (length << CELL_BITS) | leaf), (away > 0).astype(np.int32), rows)
                         for leaf, rows, away in ((leaf, rows[own[rows] <= leaf], away[own[rows] <= leaf]) for leaf, rows, away in found)]
                parts += [(np.full(len(rows), ((length + 1) << CELL_BITS) | leaf), np.ones(len(rows), np.int32), rows)
                          for leaf, rows, _ in reached(length + 1, vectors, 1)]
                rows = mine[np.concatenate([p[2] for p in parts])]
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([p[0] for p in parts]), pa.int64()), pa.array(np.concatenate([p[1] for p in parts]), pa.int32()),
                                                  batch.column(0).take(pa.array(rows)), batch.column(1).take(pa.array(rows))], names=["cell", "visits", "word", "n"])

    return map_batches(words.select("word", "n"), run, "cell long, visits int, word string, n long")


def near_pairs(words: DataFrame, s: SpellingSettings) -> DataFrame:
    """All pairs of words one edit apart, once: a, a_n, b, b_n."""
    parts = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # a number of its own is not merged: rows are few, but dear
    placed = visits(words, cells_of(words, s)).repartition(parts, "cell").sortWithinPartitions("cell", "visits")
    schema = pa.schema([("a", pa.string()), ("a_n", pa.int64()), ("b", pa.string()), ("b_n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, members, counts, index = None, [], [], None

        def found(words: list[bytes], numbers: list[int], own: bool) -> Iterator[pa.RecordBatch]:
            sizes = np.array([len(w) for w in words])
            for width in np.unique(sizes):
                some = np.flatnonzero(sizes == width)
                for q, p in index.near([words[i] for i in some], own):
                    if len(q):
                        q = some[q]
                        yield pa.RecordBatch.from_arrays([
                            pa.array([words[i].decode("latin-1") for i in q]), pa.array([numbers[i] for i in q], pa.int64()),
                            pa.array([members[i].decode("latin-1") for i in p]), pa.array([counts[i] for i in p], pa.int64())], schema=schema)

        def indexed() -> Iterator[pa.RecordBatch]:
            nonlocal index
            if index is None and members:
                index = CellIndex(members, s.leaf_words)
                yield from found(members, counts, True)

        for batch in batches:
            cells, guests = (batch.column(i).to_numpy() for i in (0, 1))
            names, numbers = [w.encode("latin-1") for w in batch.column(2).to_pylist()], batch.column(3).to_pylist()
            edges = np.flatnonzero((np.diff(cells) != 0) | (np.diff(guests) != 0)) + 1
            for at, end in zip([0, *edges], [*edges, len(cells)]):
                if at == end:
                    continue
                if cells[at] != cell:
                    yield from indexed()
                    cell, members, counts, index = cells[at], [], [], None
                if not guests[at]:
                    members += names[at:end]
                    counts += numbers[at:end]
                    continue
                yield from indexed()
                if members:
                    yield from found(names[at:end], numbers[at:end], False)
        yield from indexed()

    return map_batches(placed, run, "a string, a_n long, b string, b_n long")


def with_roots(words: DataFrame) -> DataFrame:
    """Add root: the last word that following form from a word reaches. A chain of forms must end, as growing counts see to."""
    steps = materialize(words.filter(F.col("form").isNotNull()).select("word", F.col("form").alias("root")), "form-steps")
    while True:
        ahead = measured(ahead=steps.select(F.col("word").alias("_word"), F.col("root").alias("_root")))["ahead"]
        steps = materialize(steps.join(ahead, F.col("root") == F.col("_word"), "left").select(
            "word", F.coalesce("_root", "root").alias("root"), F.col("_root").isNotNull().alias("moved")), "form-steps")
        if steps.filter("moved").isEmpty():
            break
        steps = steps.select("word", "root")
    roots = measured(roots=steps.select(F.col("word").alias("_word"), F.col("root").alias("_root")))["roots"]
    return words.join(roots, F.col("word") == F.col("_word"), "left").withColumn("root", F.coalesce("_root", "word")).drop("_word", "_root")


def spelling_variants(docs: DataFrame, s: SpellingSettings = SpellingSettings(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """For each word: word, form, root, n, n_near, form_n."""
    words = materialize(word_counts(docs, s, key, text), "words")
    pairs = near_pairs(words, s)
    one = lambda a, b: F.struct(F.col(a).alias("_word"), F.struct((-F.col(f"{b}_n")).alias("low"), F.col(b).alias("near")).alias("near"))
    near = pairs.select(F.inline(F.array(one("a", "b"), one("b", "a")))).groupBy("_word").agg(F.count("*").alias("n_near"), F.min("near").alias("_best"))
    found = words.join(near, F.col("word") == F.col("_word"), "left")
    formed = -F.col("_best.low") >= F.lit(s.factor) * F.col("n")
    found = materialize(found.select("word", F.when(formed, F.col("_best.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
                                     F.when(formed, -F.col("_best.low")).alias("form_n")), "forms")
    return with_roots(found).select("word", "form", "root", "n", "n_near", "form_n")
