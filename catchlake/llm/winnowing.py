"""Benchmark decontamination by winnowing.

Of a text's hashed k-grams, the least of every run of w consecutive ones is kept as a fingerprint, so two texts that share
at least k + w - 1 words share a fingerprint inside. Fingerprints of documents and items are joined; each common one is
extended by comparing the words around it, and every window of k + w - 1 equal words is a hit. Words are compared, so a
clash of hashes makes no hit. An item shorter than a window is one window of its own length; documents are searched
for all grams of the lengths of short items in the same pass.

All of it is built-in functions. Documents are read for fingerprints of all lengths, again for those that share one, and once for
the count of words; only fingerprints and hits travel, no texts. The items' fingerprints are broadcast if they are measured
small, and joined by shuffle otherwise.

Cases: null and empty texts have no words; documents without words, and all documents where the benchmark is empty, have
no hits; items without words or id are no items. Rows that repeat a document each get its result; rows that share an id but
not the text each get their own. A very long text is processed whole.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catchlake.llm.common import free_name, lower_ascii
from catchlake.operators.sizing import measured
from catchlake.session import materialize

NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
PLACE_BITS = 31  #: of the number that is compared, so many low bits hold the place; an array has no more entries


@dataclass(frozen=True)
class Grams:
    """k-grams, the least of each run of them, and how many shared words that catches."""

    k: int
    run: int

    @property
    def span(self) -> int:
        return self.k + self.run - 1


def words_of(text: str) -> Column:
    return F.array_remove(F.split(lower_ascii(F.coalesce(F.col(text), F.lit(""))), NOT_WORD), "")


def _marks(g: Grams, kind: int, context: bool) -> Column:
    """An array of the fingerprints of column _w: _kind, _hash, _place and, if asked for, the words around it in _around: those of
    all windows that hold it, null beyond the text's ends."""
    size, low = F.size("_w"), F.lit((1 << PLACE_BITS) - 1)
    gram = lambda i: F.xxhash64(*[F.get("_w", i + j) for j in range(g.k)])
    hashes = F.transform(F.sequence(F.lit(0), F.greatest(size - F.lit(g.k), F.lit(0))), gram)
    if g.run > 1:
        placed = F.transform(hashes, lambda x, i: x.bitwiseAND(F.lit(-1 << PLACE_BITS)).bitwiseOR(i.cast("bigint")))
        runs = F.transform(F.array(placed), lambda p: F.array_distinct(F.transform(p, lambda x, i: F.least(x, *[F.get(p, i + j) for j in range(1, g.run)]))))
        places = F.transform(runs[0], lambda x: x.bitwiseAND(low).cast("int"))
    else:
        places = F.sequence(F.lit(0), F.greatest(size - F.lit(g.k), F.lit(0)))
    around = lambda at: F.transform(F.sequence(F.lit(1 - g.run), F.lit(g.span - 1)), lambda d: F.get("_w", at + d))
    mark = lambda at: F.struct(F.lit(kind).alias("_kind"), gram(at).alias("_hash"), at.alias("_place"), *([around(at).alias("_around")] if context else []))
    return F.filter(F.transform(places, mark), lambda _: size >= g.k)


def with_fingerprints(texts: DataFrame, kinds: dict[int, Grams], context: bool) -> DataFrame:
    """A row for each fingerprint of column _w of each kind of grams, in one pass. The other columns stay; _w goes."""
    kept = [c for c in texts.columns if c != "_w"]
    marks = F.concat(*[_marks(g, kind, context) for kind, g in kinds.items()])
    return texts.select(*kept, F.inline(marks))


WINDOW = 0  #: the kind of fingerprints for items of a window or more; that of a shorter item is its number of words


def hits_of(docs: DataFrame, items: DataFrame, kinds: dict[int, Grams]) -> DataFrame:
    """Columns _id, _text, item_id, _start and _span: every window of documents that occurs in an item. docs has _id, _text (a hash
    of the text) and _w, items has item_id, _w and _kind."""
    own = [with_fingerprints(items.filter(F.col("_kind") == kind).drop("_kind"), {kind: g}, context=True) for kind, g in kinds.items()]
    marks = materialize(reduce(DataFrame.unionByName, own), "item-fingerprints")
    hashes = measured(hashes=marks.select("_kind", "_hash").distinct())["hashes"]
    found = materialize(with_fingerprints(docs, kinds, context=False).join(hashes, ["_kind", "_hash"], "left_semi")
                        .select("_id", "_text").distinct(), "documents-with-fingerprints")
    small = measured(found=found, marks=marks)
    near = docs.join(small["found"].select(F.col("_id").alias("_id2"), F.col("_text").alias("_text2")),
                     F.col("_id").eqNullSafe(F.col("_id2")) & (F.col("_text") == F.col("_text2")), "left_semi")
    theirs = small["marks"].select("_kind", "_hash", "item_id", F.col("_around").alias("_other"))
    both = with_fingerprints(near, kinds, context=True).join(theirs, ["_kind", "_hash"])
    starts = F.array().cast("array<int>")
    for kind, g in kinds.items():
        equal = [F.col("_around")[j] == F.col("_other")[j] for j in range(g.run + g.span - 1)]
        mine = F.array(*[F.when(reduce(Column.__and__, equal[s:s + g.span]), F.col("_place") + F.lit(1 - g.run + s)) for s in range(g.run)])
        starts = F.when(F.col("_kind") == kind, mine).otherwise(starts)
    spans = F.create_map(*[F.lit(x) for kind, g in kinds.items() for x in (kind, g.span)])
    return both.select("_id", "_text", "item_id", F.element_at(spans, F.col("_kind")).alias("_span"), F.explode(F.array_compact(starts)).alias("_start"))


def _hits(docs: DataFrame, benchmark: DataFrame, span: int, k: int, key: str = "doc_id", text: str = "text",
          item: str = "item_id", item_text: str = "text") -> DataFrame:
    """Columns _id, _text (a hash of the text), item_id, _start and _span: every window of documents that occurs in an item."""
    read = docs.select(F.col(key).alias("_id"), F.xxhash64(F.col(text)).alias("_text"), words_of(text).alias("_w"))
    size = F.size("_w")
    items = benchmark.select(F.col(item).alias("item_id"), words_of(item_text).alias("_w")).filter(F.col("item_id").isNotNull() & (size > 0))
    items = items.withColumn("_kind", F.when(size < span, size).otherwise(WINDOW))
    lengths = [r["_kind"] for r in items.select("_kind").distinct().orderBy("_kind").collect()]  # span rows at most
    kinds = {n: Grams(n, 1) if n else Grams(k, span - k + 1) for n in lengths or [WINDOW]}
    return materialize(hits_of(read, items, kinds).distinct(), "hits")


def contaminated_words(docs: DataFrame, benchmark: DataFrame, span: int = 10, k: int = 5, key: str = "doc_id", text: str = "text",
                       item: str = "item_id", item_text: str = "text") -> DataFrame:
    """For each document: n_words, n_hit (words inside an occurring window), n_items and items_sha256, contaminated."""
    hits = _hits(docs, benchmark, span, k, key, text, item, item_text)
    # a word is counted at the first of the windows, in order of their starts, that reach it
    ends = F.array_sort(F.collect_set(F.struct("_start", (F.col("_start") + F.col("_span")).alias("_end"))))
    covered = F.aggregate("_ends", F.struct(F.lit(0).alias("n"), F.lit(0).alias("to")), lambda acc, x: F.struct(
        (acc["n"] + F.greatest(F.lit(0), x["_end"] - F.greatest(x["_start"], acc["to"]))).alias("n"), F.greatest(acc["to"], x["_end"]).alias("to")),
        lambda acc: acc["n"])
    found = hits.groupBy("_id", "_text").agg(
        ends.alias("_ends"), F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("_items"))
    found = found.select(F.col("_id").alias("_id2"), F.col("_text").alias("_text2"), covered.cast("bigint").alias("_hit"), "_items")
    found = measured(found=materialize(found.select("_id2", "_text2", "_hit", F.size("_items").cast("bigint").alias("_n"),
                                                    F.sha2(F.concat_ws(",", "_items"), 256).alias("_sha")), "hit-documents"))["found"]
    counted = docs.select(F.col(key).alias("_id"), F.xxhash64(F.col(text)).alias("_text"), F.size(words_of(text)).cast("bigint").alias("n_words"))
    return counted.join(found, F.col("_id").eqNullSafe(F.col("_id2")) & (F.col("_text") == F.col("_text2")), "left").select(
        F.col("_id").alias(key), "n_words", F.coalesce("_hit", F.lit(0)).alias("n_hit"), F.coalesce("_n", F.lit(0)).alias("n_items"),
        F.coalesce("_sha", F.sha2(F.lit(""), 256)).alias("items_sha256"), (F.coalesce("_hit", F.lit(0)) > 0).alias("contaminated"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, span: int = 10, k: int = 5) -> DataFrame:
    """The documents without any window of the benchmark, with their columns. A row goes by its id, null or not, and its text."""
    name, body = free_name(docs, "_bad"), free_name(docs, "_bad_text")
    bad = _hits(docs, benchmark, span, k).select(F.col("_id").alias(name), F.col("_text").alias(body)).distinct()
    bad = measured(bad=materialize(bad, "contaminated"))["bad"]
    return docs.join(bad, F.col("doc_id").eqNullSafe(F.col(name)) & (F.xxhash64(F.col("text")) == F.col(body)), "left_anti")
