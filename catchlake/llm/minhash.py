"""Near-duplicates by b-bit MinHash.

A document is the set of hashes of its word shingles. Of 128 permutations the least hash each is taken; four minima in a row
make one of 32 band keys, and the two low bits of every minimum, mixed, are packed into four integers. Documents with a common
band key are candidates; the share of equal low bits, counted on the packed integers and corrected for chance
agreement, estimates their similarity, and what could reach the threshold is confirmed on the full sets.

Documents with equal sets are one class with its smallest id, so copies never make pairs. In a bucket of a band, every class is
first compared with the bucket's smallest one only, which joins a family of near copies without pairs among its
members. Components of the confirmed links follow. Then only buckets that still hold several components are compared
in full, and only classes of different components. So no link between different components is left unseen, while no bucket
is expanded into all its pairs. For this comparison the classes in such buckets get a longer signature of 1024 permutations, so
that of copies just short of the threshold few pairs are left to confirm; both estimates are conditions of the join, as is
that a pair meets in its first common band. That join only marks the rows that have such a candidate. They alone get their full sets, and a second join
of them has the similarity of the sets as its last condition: it makes rows of links between components and of nothing else, however many
copies just short of the threshold a bucket holds. Hot buckets travel through joins that adaptive execution splits.

At a similarity of 0.85 a pair shares no band with a chance of 6e-11, at 0.8 of 5e-8. The estimate is cut five
standard deviations below the threshold.

Cases: texts without words and null texts are linked with nothing; with fewer words than a shingle has, the whole sequence is
one shingle; rows that share an id share a component; a row without an id has none and is kept; repeated rows get equal
results; a very long text is taken whole, in blocks; an empty table gives no rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, replace
from functools import partial
from hashlib import blake2b

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh64_intdigest

from catchlake.llm.common import TwoAges, free_name, with_text_columns
from catchlake.llm.components import components
from catchlake.operators.sizing import measured
from catchlake.session import materialize

MIX = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class MinHashSettings:
    words: int = 5
    percent: int = 80  #: least similarity of a link
    bands: int = 32
    rows: int = 4
    sigmas: float = 5.0
    fine: int = 1024  #: permutations of the longer signature
    block: int = 256  #: shingles hashed at a time
    share: int = 64  #: pairs of one document that are confirmed by one key
    seed: int = 23

    @property
    def permutations(self) -> int:
        return self.bands * self.rows

    def least_equal(self, permutations: int) -> int:
        """The least number of equal pairs of low bits with which a pair goes on."""
        p = 0.25 + 0.75 * self.percent / 100
        return math.floor(permutations * p - self.sigmas * math.sqrt(permutations * p * (1 - p)))


def word_hash(word: bytes) -> int:
    return xxh64_intdigest(word) - (1 << 63)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, words: int, cache: TwoAges) -> np.ndarray:
    """Sorted distinct hashes of the shingles of a whole text."""
    tokens = cache.of((text or "").encode("utf-8", "surrogatepass").lower().split()).view(np.uint64)
    if not len(tokens):
        return tokens
    size = min(words, len(tokens))
    out = np.full(len(tokens) - size + 1, size, np.uint64)
    for j in range(size):
        out = _mixed(out * MIX + tokens[j:len(tokens) - size + 1 + j])
    return np.unique(out)


class Signer:
    """Signatures of texts: size and digest of the set, band keys and packed low bits."""

    def __init__(self, s: MinHashSettings):
        rng = np.random.default_rng(s.seed)
        self.s, self.cache = s, TwoAges(word_hash, 200_000)
        self.a = rng.integers(0, 1 << 63, s.permutations, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.b = rng.integers(0, 1 << 63, s.permutations, dtype=np.uint64)
        self.band = _mixed(np.arange(s.bands, dtype=np.uint64) + np.uint64(s.seed))

    def minima(self, hashes: np.ndarray) -> np.ndarray:
        out = np.full(self.s.permutations, np.iinfo(np.uint64).max, np.uint64)
        for at in range(0, len(hashes), self.s.block):
            np.minimum(out, (np.multiply.outer(self.a, hashes[at:at + self.s.block]) + self.b[:, None]).min(axis=1), out=out)
        return out

    def keys(self, minima: np.ndarray) -> np.ndarray:
        key = self.band.copy()
        for row in minima.reshape(self.s.bands, self.s.rows).T:
            key = _mixed(key * MIX + row)
        return key.view(np.int64)

    def bits(self, minima: np.ndarray) -> np.ndarray:
        """Two low bits of each mixed minimum, 32 minima in an integer. Those of the bare minima a*h + b with odd a depend on two
        bits of h alone, so whether two minima agree by chance would be the same in all permutations."""
        low = (_mixed(minima) & np.uint64(3)).reshape(-1, 32) << (np.uint64(2) * np.arange(32, dtype=np.uint64))
        return np.bitwise_or.reduce(low, axis=1).view(np.int64)

    def __call__(self, texts: list) -> list:
        sizes, digests, keys, bits = [], [], [], []
        for text in texts:
            hashes = shingles(text, self.s.words, self.cache)
            sizes.append(len(hashes))
            if len(hashes):
                minima = self.minima(hashes)
                digests.append(blake2b(hashes.tobytes(), digest_size=16).hexdigest())
                keys.append(self.keys(minima))
                bits.append(self.bits(minima))
            else:
                digests.append(None)
                keys.append(None)
                bits.append(None)
        return [sizes, digests, keys, bits]


def signatures(docs: DataFrame, s: MinHashSettings, key: str = "doc_id", text: str = "text") -> DataFrame:
    longs = T.ArrayType(T.LongType(), False)
    fields = [T.StructField("n_shingles", T.LongType()), T.StructField("_set", T.StringType()), T.StructField("_bands", longs), T.StructField("_bits", longs)]
    return with_text_columns(docs.select(F.col(key).alias("_id"), F.col(text).alias("_body")), "_body", fields, partial(Signer, s), ["_id"])


class _FineSigner:
    """The packed low bits of a longer signature."""

    def __init__(self, s: MinHashSettings):
        self.s = s
        self.signer = Signer(replace(s, bands=s.fine // s.rows, seed=s.seed + 1, block=64))

    def __call__(self, texts: list) -> list:
        cache = self.signer.cache
        return [[self.signer.bits(self.signer.minima(shingles(t, self.s.words, cache))) for t in texts]]


def equal_bits(a: str, b: str, integers: int) -> Column:
    """How many of the packed pairs of bits are equal in two signatures."""
    return _equal([F.col(a)[i] for i in range(integers)], [F.col(b)[i] for i in range(integers)])


def _equal(a: list[Column], b: list[Column]) -> Column:
    odd = F.lit(0x5555555555555555)
    unequal = None
    for x, y in zip(a, b, strict=True):
        x = x.bitwiseXOR(y)
        n = F.bit_count(x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(odd))
        unequal = n if unequal is None else unequal + n
    return F.lit(32 * len(a)) - unequal


class _Shingler:
    def __init__(self, s: MinHashSettings):
        self.s, self.cache = s, TwoAges(word_hash, 200_000)

    def __call__(self, texts: list) -> list:
        return [[shingles(t, self.s.words, self.cache).view(np.int64) for t in texts]]


def _made_of(docs: DataFrame, wanted: DataFrame, name: str, maker, s: MinHashSettings, key: str, text: str) -> DataFrame:
    """What maker makes of the documents wanted (_node, and whatever else)."""
    found = docs.select(F.col(key).alias("_id"), F.col(text).alias("_body")).join(
        measured(wanted=wanted)["wanted"], F.col("_id") == F.col("_node")).drop("_id")
    return with_text_columns(found, "_body", [T.StructField(name, T.ArrayType(T.LongType(), False))], partial(maker, s), wanted.columns)


def _confirmed(docs: DataFrame, pairs: DataFrame, s: MinHashSettings, key: str, text: str) -> DataFrame:
    """Those of the written pairs (a, b) whose full sets are similar enough. The set of b travels once for each pair, that of a once
    for each share of its pairs: a document with more pairs than a share holds is laid out as often as it has shares, so no
    key of the join has many more pairs than a share."""
    hot = pairs.groupBy(F.col("a").alias("_node")).agg(F.ceil(F.count("*") / s.share).alias("_shares")).filter(F.col("_shares") > 1)
    hot = measured(hot=materialize(hot, "hot-leaders"))["hot"]
    shared = pairs.join(hot, F.col("a") == F.col("_node"), "left").select(
        "a", "b", F.pmod(F.xxhash64("b"), F.coalesce("_shares", F.lit(1))).alias("_share"))
    members = _made_of(docs, shared.select(F.col("b").alias("_node"), "a", "_share"), "_shingles", _Shingler, s, key, text).select(
        "a", "_share", F.col("_node").alias("b"), F.col("_shingles").alias("_theirs"))
    leaders = pairs.select("a").distinct().join(hot, F.col("a") == F.col("_node"), "left").select(
        F.col("a").alias("_node"), F.coalesce("_shares", F.lit(1)).alias("_shares"))
    leaders = _made_of(docs, leaders, "_shingles", _Shingler, s, key, text).select(
        F.col("_node").alias("a"), "_shingles", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_shares") - 1)).alias("_share"))
    both = members.join(leaders, ["a", "_share"])
    common = F.size(F.array_intersect("_theirs", "_shingles"))
    total = F.size("_theirs") + F.size("_shingles") - common
    return both.filter(F.lit(100) * common >= F.lit(s.percent) * total).select("a", "b").distinct()


_SIDE = ("_part", "_n", "_band", "_bands")


def _sides(rows: DataFrame, s: MinHashSettings, *more: str) -> list[DataFrame]:
    """Rows of classes in buckets as the two sides of a join, a and b. Their signatures become plain columns without nulls: from arrays, the code
    of the join's condition is longer than what the JVM compiles (8000 bytes)."""
    packed = {"_bits": s.permutations // 32, "_fine": s.fine // 32}
    return [rows.select(F.col("_key").alias(f"_key_{x}"), F.col("_node").alias(x), *[F.col(c).alias(f"{c}_{x}") for c in (*_SIDE, *more)],
                        *[F.coalesce(F.col(c)[i], F.lit(0)).alias(f"{c}_{x}_{i}") for c, n in packed.items() for i in range(n)]) for x in ("a", "b")]


def _alike(name: str, permutations: int, s: MinHashSettings) -> Column:
    """Whether the signatures of two sides are as equal as those of a link."""
    a, b = ([F.col(f"{name}_{x}_{i}") for i in range(permutations // 32)] for x in ("a", "b"))
    return _equal(a, b) >= s.least_equal(permutations)


def near_duplicates(docs: DataFrame, s: MinHashSettings = MinHashSettings(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """For each row: doc_id, n_shingles, component_id (the least id that links reach) and kept."""
    signed = materialize(signatures(docs, s, key, text), "signatures")
    inked = signed.filter((F.col("n_shingles") > 0) & F.col("_id").isNotNull())
    classes = materialize(inked.groupBy("_set").agg(F.min("_id").alias("_node"), F.max("_id").alias("_high")).filter("_node < _high")
                          .select(F.col("_set").alias("_copied"), "_node"), "classes")
    copied = measured(classes=classes)["classes"]
    classed = inked.join(copied, F.col("_set") == F.col("_copied"), "left").withColumn("_node", F.coalesce("_node", "_id")).drop("_copied")
    heads = materialize(classed.filter("_id = _node").select("_node", "_bands", "_bits", F.col("n_shingles").alias("_n")), "heads")

    buckets = heads.select(F.posexplode("_bands").alias("_band", "_key"), "_node")
    shared = buckets.groupBy("_key").agg(F.min("_node").alias("_first"), F.max("_node").alias("_last")).filter("_first < _last")
    shared = measured(shared=materialize(shared.select(F.col("_key"), F.col("_first")), "shared-buckets"))["shared"]
    members = materialize(buckets.join(shared, "_key").select("_key", "_band", "_node", "_first"), "bucket-members")

    facts = measured(facts=heads.select("_node", "_bits", "_n"))["facts"]
    side = lambda name: facts.select(F.col("_node").alias(name), F.col("_bits").alias(f"_bits_{name}"), F.col("_n").alias(f"_n_{name}"))
    alike = (equal_bits("_bits_a", "_bits_b", s.permutations // 32) >= s.least_equal(s.permutations)) & (
        F.lit(100) * F.least("_n_a", "_n_b") >= F.lit(s.percent) * F.greatest("_n_a", "_n_b"))
    stars = members.filter("_node > _first").select(F.col("_first").alias("a"), F.col("_node").alias("b")).distinct()
    stars = materialize(stars.join(side("a"), "a").join(side("b"), "b").filter(alike).select("a", "b").distinct(), "star-pairs")
    links = materialize(_confirmed(docs, stars, s, key, text), "links")
    found = materialize(components(links), "components")

    named = measured(found=found)["found"]
    placed = members.join(named, F.col("_node") == F.col("node"), "left").select(
        "_key", "_band", "_node", F.coalesce("component", "_node").alias("_part"))
    mixed = placed.groupBy("_key").agg(F.min("_part").alias("_low"), F.max("_part").alias("_high")).filter("_low < _high").select("_key")
    open_ = materialize(placed.join(measured(mixed=mixed)["mixed"], "_key").join(facts, "_node"), "open-buckets")
    fine = _made_of(docs, open_.select("_node").distinct(), "_fine", _FineSigner, s, key, text)
    fine = fine.join(heads.select("_node", "_bands"), "_node").dropDuplicates(["_node"])
    open_ = materialize(open_.join(measured(fine=materialize(fine, "fine-signatures"))["fine"], "_node"), "open-signatures")
    sized = F.lit(100) * F.least("_n_a", "_n_b") >= F.lit(s.percent) * F.greatest("_n_a", "_n_b")
    nearly = sized & _alike("_bits", s.permutations, s) & _alike("_fine", s.fine, s)
    earlier = F.arrays_overlap(F.slice("_bands_a", F.lit(1), F.col("_band_a")), F.slice("_bands_b", F.lit(1), F.col("_band_a")))
    candidates = (F.col("_key_a") == F.col("_key_b")) & (F.col("_part_a") != F.col("_part_b")) & nearly & ~earlier
    # only rows that have a candidate get their sets, and the sets are compared inside the join, which makes rows of links alone
    left, right = _sides(open_, s)
    close = left.hint("shuffle_merge").join(right, candidates, "left_semi").select(F.col("_key_a").alias("_key"), F.col("a").alias("_node"))
    close = open_.join(measured(close=materialize(close.distinct(), "crossing-members"))["close"], ["_key", "_node"])
    sets = _made_of(docs, close.select("_node").distinct(), "_shingles", _Shingler, s, key, text).dropDuplicates(["_node", "_shingles"])
    sets = measured(sets=materialize(sets, "crossing-sets"))["sets"]
    left, right = _sides(materialize(close.join(sets, "_node"), "crossing-rows"), s, "_shingles")
    common = F.size(F.array_intersect("_shingles_a", "_shingles_b"))
    similar = F.lit(100) * common >= F.lit(s.percent) * (F.size("_shingles_a") + F.size("_shingles_b") - common)
    linked = (F.col("a") < F.col("b")) & candidates & similar
    more = materialize(left.hint("shuffle_merge").join(right, linked).select("a", "b").distinct(), "links")
    found = measured(found=materialize(components(found.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more)), "components"))["found"]

    named = signed.select("_id", "n_shingles", "_set").join(copied, F.col("_set") == F.col("_copied"), "left")
    named = named.withColumn("_node", F.when(F.col("n_shingles") > 0, F.coalesce("_node", "_id")))
    named = named.join(found, F.col("_node") == F.col("node"), "left")
    component = F.when(F.col("_id").isNotNull(), F.coalesce("component", "_node", "_id"))
    return named.select(F.col("_id").alias(key), "n_shingles", component.alias("component_id"), F.col("_id").eqNullSafe(component).alias("kept"))


def drop_near_duplicates(docs: DataFrame, s: MinHashSettings = MinHashSettings()) -> DataFrame:
    """One row of each group, that of the least id, with the documents' columns.

    Where ids are null or repeated, a row goes by its id and text together, rows without an id after all others. Rows without words
    and id are linked with nothing and stay.
    """
    name = free_name(docs, "_gone")
    if docs.groupBy("doc_id").count().filter(F.col("doc_id").isNull() | (F.col("count") > 1)).isEmpty():
        gone = near_duplicates(docs, s).filter(~F.col("kept")).select(F.col("doc_id").alias(name))
        gone = measured(gone=materialize(gone, "duplicates"))["gone"]
        return docs.join(gone, F.col("doc_id") == F.col(name), "left_anti")
    own, row = free_name(docs, "_own"), free_name(docs, "_row")
    keyed = docs.withColumn(own, F.struct(F.col("doc_id").isNull().alias("x"), F.col("doc_id").alias("y"), F.md5(F.col("text")).alias("z")))
    found = near_duplicates(keyed, s, key=own).groupBy(own).agg(F.min("kept").alias("_kept"), F.max("n_shingles").alias("_n"), F.count("*").alias("_rows"))
    found = materialize(found, "duplicates")
    inked = (F.col("_n") > 0) | F.col(own)["y"].isNotNull()
    gone = found.filter(~F.col("_kept")).select(F.col(own).alias(name))
    many = found.filter(F.col("_kept") & (F.col("_rows") > 1) & inked).select(F.col(own).alias(name))
    small = measured(gone=gone, many=many)
    same = F.col(own).eqNullSafe(F.col(name))
    left = keyed.join(small["gone"], same, "left_anti")
    once = left.join(small["many"], same, "left_anti").select(*docs.columns)
    # repeated rows have equal ids and texts; the rest of the columns decides, with map-side aggregation
    others = F.to_json(F.struct(*[F.col(c) for c in docs.columns]))  # which any kind of column has
    picked = left.join(small["many"], same, "left_semi").groupBy(own).agg(F.min_by(F.struct(*docs.columns), others).alias(row))
    return once.unionByName(picked.select(f"{row}.*"))
