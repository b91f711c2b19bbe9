"""Document fingerprints by consistent weighted sampling.

A text is a set of weighted terms: its runs of non-blank bytes of UTF-8 (cut after every 16 bytes, so that unbroken text has terms
as well), A-Z lower-cased, weighted by how often they occur. For each of 96 samples every term draws r and c from Gamma(2, 1) and b from
[0, 1), all by a hash of the term and the sample's number. With a weight w, t = floor(ln w / r + b) and the value of the term is
ln c - r (t - b + 1); the term of the least value is the sample, together with its t. Two texts have an equal sample with a
probability of their generalised Jaccard similarity: the sum of the smaller weights over the sum of the larger ones. A fingerprint
is 16 bits of each sample's hash in hexadecimal, and the likeness of two is the share of equal samples, corrected for what
agrees by chance.

The edited text of a document needs the one after it in the order of ids. Rows are dealt to ranges of the order, in one shuffle, and a
range's first row goes to the range before it as well (that of the first range to the last), so that a task meets each row
with the next one as a stream, and holds two texts at a time, or some short ones whose terms are looked up together. The ranges' ends come from the ids and text hashes alone; a row finds its range
by halving the sorted array of ends.

Cases: a null text is an empty one; a text without terms has an empty fingerprint, likeness 1 to another such text and 0 to all others. Rows
without an id come first; rows that share an id follow in the order of their texts' hashes, so repeated rows stand
side by side. The only row of a table is its own next one. Very long texts are taken whole, in blocks of terms. An empty table gives no rows. Other columns
are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from catchlake.llm.common import map_batches
from catchlake.operators.partitions import place_among
from catchlake.session import materialize

TERM_BYTES = 16
GROUP_ROWS, GROUP_CHARS = 8, 1 << 15  #: rows whose terms are looked up together, fewer of longer texts


def halves(whole: np.ndarray) -> np.ndarray:
    """Whole numbers of 23 bits at most, and a half."""
    made = whole.view(np.int32).astype(np.float32)
    made += np.float32(0.5)
    return made


def low(x: np.ndarray, shift: int, bits: int) -> np.ndarray:
    """Bits of hashes from shift on."""
    whole = (x >> np.uint64(shift)).astype(np.uint32)
    whole &= np.uint32((1 << bits) - 1)
    return whole


def gamma(x: np.ndarray, bits: int, shift: int) -> np.ndarray:
    """Gamma(2, 1): -ln of the product of two uniform numbers, of the uppermost bits of hashes and of those from shift on."""
    made = halves((x >> np.uint64(64 - bits)).astype(np.uint32))
    made *= halves(low(x, shift, bits))
    made *= np.float32(2.0 ** (-2 * bits))  # a power of two, so both numbers may be scaled at once
    np.log(made, out=made)
    return np.negative(made, out=made)


@dataclass(frozen=True)
class SamplingSettings:
    samples: int = 96
    seed: int = 12
    table: int = 131_072  #: terms whose values at a weight of 1 a task keeps, 0.4 KB each
    heavy: int = 8192  #: terms that occur more than once in a text, whose draws a task keeps, 1.2 KB each


def mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(33))
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


class Sampler:
    """Fingerprints of texts. Tables keep what is drawn for terms. A full table starts again; a block of terms always fits."""

    BLOCK, DRAWN = 8192, 128

    def __init__(self, s: SamplingSettings):
        self.s = s
        numbers = np.arange(2 * s.samples, dtype=np.uint64) + np.uint64(1)
        self.steps = mixed(numbers * np.uint64(0x9E3779B97F4A7C15) + np.uint64(s.seed)).reshape(2, s.samples)
        size = max(s.table, self.BLOCK)
        self.slots: dict[bytes, int] = {}
        self.hashes = np.zeros(size, np.uint64)
        self.at_one = np.zeros((size, s.samples), np.float32)  # the values at a weight of 1, where t is 0
        # of terms that occur more than once in a text: where they lie, and ln c, r and b
        self.heavy_at, self.heavies = np.full(size, -1), 0
        self.heavy = np.zeros((3, max(s.heavy, self.BLOCK), s.samples), np.float32)

    def draws(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """ln c, r and b of terms: a row for each, a column for each sample."""
        for_c, for_r = (mixed(hashes[:, None] ^ steps) for steps in self.steps)
        c, b = gamma(for_c, 23, 18), halves(low(for_r, 1, 23))
        b *= np.float32(2.0 ** -23)
        return np.log(c, out=c), gamma(for_r, 20, 24), b

    def slots_of(self, terms: list[bytes]) -> list[int]:
        """Where the values of the terms lie, a block of them at most."""
        found = list(map(self.slots.get, terms))
        if None in found:
            new = [t for t, slot in zip(terms, found) if slot is None]
            if len(self.slots) + len(new) > len(self.hashes):
                self.slots.clear()
                self.heavy_at[:], self.heavies = -1, 0
                new, found = terms, [None] * len(terms)
            following = iter(range(len(self.slots), len(self.hashes)))
            found = [next(following) if slot is None else slot for slot in found]
            for first in range(0, len(new), self.DRAWN):  # so few that what is made in between stays in the CPU's cache
                some, at = new[first:first + self.DRAWN], len(self.slots)
                own = slice(at, at + len(some))
                self.hashes[own] = np.fromiter((xxh64_intdigest(t, self.s.seed) for t in some), np.uint64, len(some))
                c, r, b = self.draws(self.hashes[own])
                r *= np.subtract(1, b, out=b)
                np.subtract(c, r, out=self.at_one[own])
                self.slots.update(zip(some, range(at, at + len(some))))
        return found

    def draw_heavy(self, slots: np.ndarray) -> None:
        """Have the draws of the distinct terms, a block of them at most."""
        new = slots[self.heavy_at[slots] < 0]
        if self.heavies + len(new) > self.heavy.shape[1]:
            self.heavy_at[:], self.heavies, new = -1, 0, slots
        for first in range(0, len(new), self.DRAWN):
            some, at = new[first:first + self.DRAWN], self.heavies
            self.heavies += len(some)
            self.heavy[:, at:self.heavies] = self.draws(self.hashes[some])
            self.heavy_at[some] = np.arange(at, self.heavies)

    def values(self, slots: np.ndarray, logs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Values of terms of the given logarithms of weights, and their t: a row for each term, a column for each sample."""
        c, r, b = (x.take(self.heavy_at[slots], axis=0) for x in self.heavy)
        t = np.floor(logs[:, None] / r + b)
        return c - r * (t - b + 1), t

    def least(self, slots: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of a block of terms the least value and its hash, for each sample."""
        column = np.arange(self.s.samples)
        values, t = self.at_one.take(slots, axis=0), None
        heavy = np.flatnonzero(counts > 1)
        if len(heavy):
            values[heavy], t = self.values(slots[heavy], np.log(counts[heavy]))
        first = values.argmin(axis=0)
        steps = np.zeros(self.s.samples, np.uint64)
        if t is not None:
            row_of = np.full(len(slots), -1)
            row_of[heavy] = np.arange(len(heavy))
            mine = row_of[first]
            steps = np.where(mine >= 0, t[mine, column], 0).astype(np.uint64)
        return values[first, column], mixed(self.hashes[slots[first]] + steps * np.uint64(0x9E3779B97F4A7C15))

    def samples(self, several: list[dict[bytes, int]]) -> list[np.ndarray]:
        """For the weights of each text the samples' hashes, 16 bits; terms must not be empty. What is new in several texts is drawn together
        if it is a block of terms at most."""
        terms = list(dict.fromkeys(chain.from_iterable(several)))
        if len(terms) > self.BLOCK and len(several) > 1:
            return [x for weights in several for x in self.samples([weights])]
        every = [np.fromiter(weights.values(), np.float32, len(weights)) for weights in several]
        best = [(np.full(self.s.samples, np.inf), np.zeros(self.s.samples, np.uint64))] * len(several)
        for at in range(0, len(terms), self.BLOCK):  # several blocks of one text, or one of several texts
            some = terms[at:at + self.BLOCK]
            where = dict(zip(some, self.slots_of(some)))
            slots = [np.fromiter(map(where.__getitem__, weights if len(some) == len(terms) else some), np.int64) for weights in several]
            counts = [x[at:at + self.BLOCK] for x in every]
            self.draw_heavy(np.unique(np.concatenate([x[n > 1] for x, n in zip(slots, counts, strict=True)])))
            for i, (least, hashes) in enumerate(map(self.least, slots, counts)):
                better = least < best[i][0]
                best[i] = np.where(better, least, best[i][0]), np.where(better, hashes, best[i][1])
        return [(mixed(found + self.steps[0]) & np.uint64(0xFFFF)).astype(">u2") for _, found in best]

    def prints(self, texts: list[str]) -> list[str]:
        """The fingerprints of texts that are held together."""
        weights = list(map(term_weights, texts))
        made = iter(self.samples([w for w in weights if w]))
        return [next(made).tobytes().hex() if w else "" for w in weights]

    def __call__(self, text: str) -> str:
        return self.prints([text])[0]


def term_weights(text: str) -> Counter:
    words = Counter(text.encode("utf-8", "surrogatepass").lower().split())  # bytes: A-Z only, and blanks of ASCII
    for word in [w for w in words if len(w) > TERM_BYTES]:
        n = words.pop(word)
        words.update({piece: n * k for piece, k in Counter(word[i:i + TERM_BYTES] for i in range(0, len(word), TERM_BYTES)).items()})
    return words


def likeness(a: str, b: str) -> float:
    """The estimated generalised Jaccard similarity of two fingerprints' texts."""
    if not a or not b:
        return float(a == b)
    x, y = (np.frombuffer(bytes.fromhex(f), ">u2") for f in (a, b))
    chance = 2.0 ** -16
    return max(0.0, (float((x == y).mean()) - chance) / (1 - chance))


def edited(text: str, other: str) -> str:
    """The text with its last quarter replaced by as much of the start of the other."""
    n = len(text) // 4
    return text[:len(text) - n] + other[:n]


def with_next(rows: DataFrame, order: Sequence[str], name: str = "_range", guest: str = "_guest") -> DataFrame:
    """Rows dealt to ranges of the order and sorted, one range to a task, each followed by the first row of the next range as a guest; the
    last range by the first row of all. The range's number is in name, whether a row is a guest in guest."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    key = F.struct(*order)
    firsts = rows.select(*order).repartitionByRange(parts, *order).groupBy(F.spark_partition_id().alias("part")).agg(F.min(key).alias("first"))
    firsts = materialize(firsts, "range-starts")  # as many rows as ranges
    starts = firsts.agg(F.sort_array(F.collect_list("first")).alias("starts")).scalar()
    count = firsts.agg(F.count("*").cast("int").alias("n")).scalar()
    placed = rows.withColumn("_starts", starts).withColumn(name, place_among(key, F.col("_starts")) - 1)
    is_first = key == F.element_at("_starts", F.col(name) + 1)
    copy = lambda place, as_guest: F.struct(place.cast("int").alias(name), F.lit(as_guest).alias(guest))
    own, before = copy(F.col(name), False), copy(F.pmod(F.col(name) + count - 1, count), True)
    placed = placed.withColumn("_copies", F.when(is_first, F.array(own, before)).otherwise(F.array(own))).drop("_starts", name)
    placed = placed.select("*", F.inline("_copies")).drop("_copies")
    return placed.repartitionById(parts, F.col(name)).sortWithinPartitions(name, guest, *order)


def together(batch: pa.RecordBatch) -> Iterator[list[tuple]]:
    """The rows of a batch, short texts in groups."""
    group, size = [], 0
    for id_, body, range_, guest in zip(*(batch.column(c) for c in ("id", "body", "_range", "_guest"))):
        group.append((id_, body.as_py(), range_.as_py(), guest.as_py()))
        size += len(group[-1][1])
        if size >= GROUP_CHARS or len(group) >= GROUP_ROWS:
            yield group
            group, size = [], 0
    if group:
        yield group


def fingerprints(docs: DataFrame, s: SamplingSettings = SamplingSettings(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """For each row: its id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    rows = docs.select(F.col(key).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("body")).withColumn("hash", F.xxhash64("body"))
    kind = docs.schema[key].dataType
    names = [key, "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = Sampler(s)
        last, place = None, None  # the row that waits for its next one
        for batch in batches:
            out: list[list] = [[] for _ in names]
            for group in together(batch):
                texts, met = [], []
                at, theirs = place, last and last[1]
                for id_, body, range_, guest in group:
                    waiting = theirs is not None and range_ == at
                    if guest and not waiting:  # a repeat of the guest
                        continue
                    changed = edited(theirs, body) if waiting else None
                    texts += [body, changed] if waiting else [body]
                    met.append((id_, body, range_, guest, changed))
                    theirs, at = None if guest else body, range_
                prints = iter(sampler.prints(texts))
                for id_, body, range_, guest, changed in met:
                    mine = next(prints)
                    if changed is not None:
                        before, theirs, print_ = last
                        again = next(prints)
                        for column, value in zip(out, (before, len(theirs), hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(), print_, again,
                                                       likeness(print_, again), likeness(print_, mine)), strict=True):
                            column.append(value)
                    last, place = None if guest else (id_, body, mine), range_
            columns = [pa.array([v.as_py() for v in out[0]], batch.schema.field("id").type)]
            columns += [pa.array(c, k) for c, k in zip(out[1:], (pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()), strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = f"`{key}` {kind.simpleString()}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return map_batches(with_next(rows, ["id", "hash"]), run, schema)
