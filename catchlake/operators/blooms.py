"""Bloom filters of ids, to thin out a large table before it is shuffled for a join.

The filter is an array of 64-bit words, summed up with bitwise or on the map side and handed to the scan of the large table as a scalar. What
passes is joined as ever, so a false hit costs a row of shuffle and nothing else.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS_PER_ID = 10  #: with 4 hashes about one in a hundred other ids passes
HASHES = 4
MOST_BITS = 1 << 27  #: 16 MB, the bound of what is sent to all tasks: 13 million ids at ten bits each; more ids let more others pass


def _places(key: Column, bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(i)), F.lit(bits)) for i in range(HASHES)]


def bits_for(ids: int) -> int:
    """A power of two with room for so many ids."""
    return min(MOST_BITS, max(1 << 10, 1 << (max(ids, 1) * BITS_PER_ID - 1).bit_length()))


def bloom_words(ids: DataFrame, key: str, bits: int) -> DataFrame:
    """One row with the filter: column words, an array of bits / 64 numbers."""
    place = F.explode(F.array(*_places(F.col(key), bits))).alias("place")
    marked = ids.filter(F.col(key).isNotNull()).select(place)
    marked = marked.select(F.floor(F.col("place") / 64).cast("bigint").alias("word"), F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col("place") % 64).cast("int")).alias("bits"))
    empty = ids.sparkSession.range(bits // 64).select(F.col("id").alias("word"), F.lit(0).cast("bigint").alias("bits"))
    words = marked.unionByName(empty).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    return words.agg(F.transform(F.sort_array(F.collect_list(F.struct("word", "bits"))), lambda x: x["bits"]).alias("words"))


def may_hold(key: Column, words: Column, bits: int) -> Column:
    """Whether a key can be among the filter's ids. Never false for one that is."""
    tests = None
    for place in _places(key, bits):
        word = F.get(words, F.floor(place / 64).cast("int"))
        test = F.getbit(word, (place % 64).cast("int")) == 1
        tests = test if tests is None else tests & test
    return tests


def thinned(df: DataFrame, key: str, ids: DataFrame, id_column: str | None = None) -> DataFrame:
    """The rows of df whose key may be among the ids: all that are, and few others. ids is read twice, so write it first."""
    id_column = id_column or key
    bits = bits_for(ids.filter(F.col(id_column).isNotNull()).count())
    words = bloom_words(ids, id_column, bits).scalar()
    return df.withColumn("_words", words).filter(may_hold(F.col(key), F.col("_words"), bits)).drop("_words")
