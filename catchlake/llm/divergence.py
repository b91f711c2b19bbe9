"""How the sources of a language differ in their terms: an audit from joint tables of counts.

A group is a language and a source. A term's share in a group depends on its count there alone, so whatever compares two groups term by
term is a sum over their joint table: how many terms have one share in the first group and another one in the second. Each share
of a group is a level. A block of terms gives a matrix of ones and zeros, with a row for each term and a column for each level of each group; the
matrix transposed times itself holds the joint tables of all pairs of groups. The product is taken in blocks of columns; its entries
are at most the block's terms, so it is exact. Each joint table is priced, level against level, in whole numbers, and the priced sums
of all blocks are added up.

Counting terms is one pass in Arrow batches with a bounded table of partial sums for each task. Terms below the least number of documents go in the
same shuffle, and what is written holds kept terms only. A block holds at most `block_terms` terms, fewer where a language has very many
sources, so a task's memory is bounded whatever the vocabulary.

Cases: null text, language and source are empty texts, an empty language or source is one like any other; a group without terms and a language
without kept terms have rows all the same (pairs of value 0 where nothing is kept); repeated rows count as often as they stand there; very
long texts are taken whole; ties are ranked by the item's UTF-8 bytes; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from catchlake.llm.common import map_batches, ship_package
from catchlake.operators.sizing import measured
from catchlake.session import materialize

TERM = re.compile(rb"[a-z\x80-\xFF]+")
UNIT = 1_000_000_000


@dataclass(frozen=True)
class AuditSettings:
    least_documents: int = 10
    top: int = 10  #: terms listed for a group
    block_terms: int = 1024
    block_cells: int = 1 << 20  #: terms times sources of a block, at most
    block_columns: int = 512
    table: int = 200_000  #: terms of groups that a task counts at a time


def term_counts(docs: DataFrame, s: AuditSettings) -> DataFrame:
    """Kept terms: lang, source, term, n (occurrences in the group), total (in the language) and head, true in one row for each term of a language."""
    schema = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("d", pa.int64())])

    def flushed(groups: dict) -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, d) in groups.items():
            terms = [t.decode("utf-8", "surrogatepass") for t in n]
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(terms), pa.string()), pa.array([source] * len(terms), pa.string()), pa.array(terms, pa.string()),
                                              pa.array(n.values(), pa.int64()), pa.array([d[t] for t in n], pa.int64())], schema=schema)
        groups.clear()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict = defaultdict(lambda: (Counter(), Counter()))
        for batch in batches:
            for lang, source, body in zip(*(batch.column(i) for i in range(3))):
                n, d = groups[lang.as_py(), source.as_py()]
                found = TERM.findall(body.as_py().encode("utf-8", "surrogatepass").lower())  # bytes.lower() changes A-Z only
                n.update(found)
                d.update(set(found))
            if sum(len(n) for n, _ in groups.values()) > s.table:
                yield from flushed(groups)
        yield from flushed(groups)

    rows = map_batches(docs.select("lang", "source", "text"), run, "lang string, source string, term string, n long, d long")
    of_term = W.partitionBy("lang", "term")
    counts = rows.repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("d").alias("d"))
    kept = counts.withColumns({"total": F.sum("n").over(of_term), "_documents": F.sum("d").over(of_term), "_first": F.min("source").over(of_term)})
    return kept.filter(F.col("_documents") >= s.least_documents).select("lang", "source", "term", "n", "total", (F.col("source") == F.col("_first")).alias("head"))


def share(count: Column, total: Column, terms: Column) -> Column:
    """1 and the whole billionths of a smoothed share, exact in decimals."""
    whole = lambda c, digits: c.cast(f"decimal({digits},0)")
    return F.lit(1) + F.call_function("div", whole(F.lit(UNIT), 10) * whole(count + 2, 20), whole(total + 2 * terms, 20))


def gap(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """What two shares differ by; both are at most a billion and one, so squares fit 64 bits."""
    return (p - q) ** 2 // (p + q)


def priced_products(levels: np.ndarray, columns: int) -> np.ndarray:
    """For each pair of groups (upper triangle) the sum of gap over the rows of levels (terms by groups), through joint tables."""
    terms, groups = levels.shape
    value = np.zeros((groups, groups), np.int64)
    group_of, level_of, code = [], [], np.zeros((terms, groups), np.int64)
    for g in range(groups):
        found, inverse = np.unique(levels[:, g], return_inverse=True)
        code[:, g] = inverse + sum(map(len, level_of))
        group_of.append(np.full(len(found), g))
        level_of.append(found)
    group_of, level_of = np.concatenate(group_of), np.concatenate(level_of)

    def indicators(at: int) -> np.ndarray:
        """The columns from at on of the matrix of ones and zeros, transposed."""
        out = np.zeros((min(columns, len(level_of) - at), terms), np.float32)
        row, g = np.nonzero((code >= at) & (code < at + len(out)))
        out[code[row, g] - at, row] = 1
        return out

    for i in range(0, len(level_of), columns):
        left = indicators(i)
        for j in range(i, len(level_of), columns):
            joint = left @ (left if j == i else indicators(j)).T  # whole numbers up to the number of terms, exact in 24 bits
            a, b = np.nonzero(joint)
            n = joint[a, b].astype(np.int64)
            a, b = a + i, b + j
            upper = group_of[a] < group_of[b]
            a, b, n = a[upper], b[upper], n[upper]
            np.add.at(value, (group_of[a], group_of[b]), n * gap(level_of[a], level_of[b]))
    return value


def pair_values(kept: DataFrame, groups: DataFrame, s: AuditSettings) -> DataFrame:
    """lang, a, b, value for each pair of a language's sources, a before b. kept has the share p, groups have sources, terms and rest, the share of a
    term that the group does not have."""
    if not 1 <= s.block_terms <= 1 << 24:
        raise ValueError("a block of 1 to 2^24 terms gives exact products")
    each = F.greatest(F.lit(1), F.least(F.lit(s.block_terms), F.floor(F.lit(s.block_cells) / F.col("sources")))).cast("long")
    blocks = F.greatest(F.lit(1), F.ceil(F.col("terms") / each)).cast("long")
    zeros = groups.select("lang", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)).alias("block"), "source", F.lit(None).cast("string").alias("term"),
                          F.col("rest").alias("p"))
    ones = kept.select("lang", F.pmod(F.xxhash64("term"), blocks).alias("block"), "source", "term", "p")
    ship_package(kept.sparkSession)

    def run(block: pa.Table) -> pa.Table:
        sources, group = np.unique(np.array(block.column("source").to_pylist(), dtype=object), return_inverse=True)
        terms = block.column("term").combine_chunks().dictionary_encode()
        share_of = np.array(block.column("p").fill_null(0).to_numpy())
        row = terms.indices.fill_null(-1).to_numpy(zero_copy_only=False)
        levels = np.zeros((len(terms.dictionary), len(sources)), np.int64)
        levels[:, group[row < 0]] = share_of[row < 0]
        levels[row[row >= 0], group[row >= 0]] = share_of[row >= 0]
        a, b = np.triu_indices(len(sources), 1)
        value = priced_products(levels, s.block_columns)[a, b] if len(levels) else np.zeros(len(a), np.int64)
        return pa.table({"lang": pa.array([block.column("lang")[0].as_py()] * len(a), pa.string()), "a": pa.array(sources[a], pa.string()),
                         "b": pa.array(sources[b], pa.string()), "value": pa.array(value, pa.int64())})

    parts = zeros.unionByName(ones).groupBy("lang", "block").applyInArrow(run, "lang string, a string, b string, value long")
    return parts.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def divergence_audit(docs: DataFrame, s: AuditSettings = AuditSettings(), text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """Rows lang, source, part, item, value, rank: of part `pair` what each other source differs by over all kept terms, of part `term` the terms
    that stand out most in the group."""
    docs = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(name) for c, name in ((lang, "lang"), (source, "source"), (text, "text"))])
    counts = materialize(term_counts(docs, s), "term-counts")
    langs = counts.groupBy("lang").agg(F.sum("n").alias("lang_n"), F.count_if("head").alias("terms"))
    own = counts.groupBy("lang", "source").agg(F.sum("n").alias("group_n"))
    groups = docs.select("lang", "source").distinct().join(langs, "lang", "left").join(own, ["lang", "source"], "left").na.fill(0)
    groups = groups.withColumn("sources", F.count("*").over(W.partitionBy("lang")))
    groups = groups.withColumn("rest", F.when(F.col("terms") > 0, share(F.lit(0), F.col("group_n"), F.col("terms"))))
    groups = measured(groups=materialize(groups, "groups"))["groups"]
    placed = counts.join(groups, ["lang", "source"]).withColumns({
        "p": share(F.col("n"), F.col("group_n"), F.col("terms")), "q": share(F.col("total"), F.col("lang_n"), F.col("terms"))})

    pairs = pair_values(placed, groups, s).select(F.explode(F.array(F.struct("lang", F.col("a").alias("source"), F.col("b").alias("item"), "value"), F.struct(
        "lang", F.col("b").alias("source"), F.col("a").alias("item"), "value"))).alias("row")).select("row.*")
    order = W.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.withColumn("rank", F.row_number().over(order))
    p, q = F.col("p"), F.col("q")
    terms = placed.filter(p > q).select("lang", "source", F.col("term").alias("item"), F.call_function("div", (p - q) * (p - q), p + q).alias("value"))
    terms = terms.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= s.top)
    columns = lambda rows, part: rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")
    return columns(pairs, "pair").unionByName(columns(terms, "term"))
