"""Sharding by proportional stratified interleaving.

Rows are shuffled by a seeded hash within their source, ranked there, and sorted by fractional rank (rank plus a seeded
offset of the source, over the source's rows). Cut into equal stretches, every shard then has the sources in the
proportions of the whole, within about one row a source, and counts that differ by one at most. The offsets spread
sources with few rows over the shards; without them all of these would meet in the middle.

Ranks come from a range-partitioned sort and the partitions' counts, so a source with any share of the rows is spread
over many tasks. Texts are read once, for size and checksum, and never travel.

Cases: a null source is a source of its own; a null text has no bytes, so size 8 and the checksum of nothing; repeated
rows and ties keep one place each (their order is free, the rows are equal); an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catchlake.llm.positions import with_positions
from catchlake.operators.sizing import measured
from catchlake.session import materialize

ROW_OVERHEAD = 8


def interleaved_shards(rows: DataFrame, key: str, stratum: str, shards: int, seed: int = 17) -> DataFrame:
    """Add shard and slot to narrow rows. All columns of rows take part in the order, so that equal rows only tie."""
    columns = rows.columns
    rows = materialize(rows.withColumn("_mix", F.xxhash64(F.lit(seed), key, *columns)), "shard-rows")
    ranked = with_positions(rows, [stratum, "_mix", *columns], "_position", "_total")
    strata = materialize(ranked.groupBy(F.col(stratum).alias("_stratum"))
                         .agg(F.count("*").alias("_rows"), F.min("_position").alias("_first")), "strata")
    offset = F.pmod(F.xxhash64(F.lit(seed), F.hex(F.col("_stratum").cast("string"))), F.lit(1 << 20)) / float(1 << 20)
    strata = measured(strata=strata.withColumn("_offset", F.coalesce(offset, F.lit(0.5))))["strata"]
    share = (F.col("_position") - F.col("_first") + F.col("_offset")) / F.col("_rows")
    placed = (ranked.join(strata, F.col(stratum).eqNullSafe(F.col("_stratum")))
              .select(*columns, F.col("_position"), share.alias("_share"), F.xxhash64(F.lit(seed), stratum).alias("_mix")))
    ordered = with_positions(placed, ["_share", "_mix", "_position"], "_place", "_total")
    shard = F.expr(f"_place * {shards} div _total")
    first = F.expr(f"(({shard_sql(shards)}) * _total + {shards - 1}) div {shards}")
    return ordered.select(*columns, shard.cast("int").alias("shard"), (F.col("_place") - first).alias("slot"))


def shard_sql(shards: int) -> str:
    return f"_place * {shards} div _total"


def shard_documents(docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text", stratum: str = "source",
                    seed: int = 17) -> DataFrame:
    """Every row's size, checksum, shard and slot."""
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(key).alias("doc_id"), F.col(stratum).alias("_source"),
                       (F.octet_length(body) + F.lit(ROW_OVERHEAD)).cast("bigint").alias("size"),
                       F.crc32(body.cast("binary")).alias("text_crc32"))
    return interleaved_shards(rows, "doc_id", "_source", shards, seed)
