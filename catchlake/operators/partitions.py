"""Balanced id ranges for a table too large to move in one piece."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catchlake.constants import RESULT_PARTITIONS


def place_among(value: Column, ends: Column, most: int = 1 << 24) -> Column:
    """How many entries of a sorted array of `most` entries at most are not above the value, found by halving. 0 for a null value or array."""
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(max(most, 1).bit_length()))])

    def halved(at: Column, step: Column) -> Column:
        return F.when(F.try_element_at(ends, at + step) <= value, at + step).otherwise(at)

    return F.aggregate(steps, F.lit(0), halved)


def key_distribution(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("record_count"))


def ranged(df: DataFrame, key: str, parts: int | None = None) -> DataFrame:
    """df with _stretch, the number of the range that its key falls in. Ranges hold about equal numbers of rows and follow the key's order.

    The ranges' ends are quantiles out of one mergeable sketch of all keys, made map-side, so they follow the keys' density, and a far
    key makes no difference. Nothing is sorted or moved; a value of the key is always in one range.
    """
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if parts < 2:
        return df.withColumn("_stretch", F.lit(0))
    shares = [i / parts for i in range(1, parts)]
    ends = df.agg(F.percentile_approx(key, shares, 100 * parts)).first()[0] or []  # as many as ranges
    cuts = F.array(*[F.lit(x) for x in sorted(set(ends))]) if ends else F.array().cast(f"array<{df.schema[key].dataType.simpleString()}>")
    return df.withColumn("_stretch", place_among(F.col(key), cuts, parts))


def running_total(df: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """Running sum of value in key order over one row per key, without one long window.

    One window runs inside each range of keys (see ranged), a second one over the totals of the ranges, of which there are as
    many as shuffle partitions.
    """
    cut = ranged(df, key)
    totals = cut.groupBy("_stretch").agg(F.sum(value).alias("_sum"))
    before = Window.orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_stretch", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("_stretch").orderBy(key).rowsBetween(Window.unboundedPreceding, 0)
    ran = cut.withColumn("_inside", F.sum(value).over(inside)).join(offsets, "_stretch")
    return ran.withColumn(name, F.col("_before") + F.col("_inside")).drop("_stretch", "_before", "_inside")


def partition_map(dist: DataFrame, key: str, n: int = RESULT_PARTITIONS) -> DataFrame:
    """Contiguous id ranges of about equal row counts: partition_id, begin, end, record_count."""
    rows = dist.agg(F.sum("record_count")).scalar()
    ran = running_total(dist, key, "record_count", "_through")
    bucket = F.floor((F.col("_through") - F.col("record_count")) * n / rows).cast("int")
    ranges = ran.groupBy(bucket.alias("_bucket")).agg(
        F.min(key).alias("begin_universal_data_id"),
        F.max(key).alias("end_universal_data_id"),
        F.sum("record_count").alias("record_count"),
    )
    in_order = Window.orderBy("_bucket")
    return ranges.withColumn("partition_id", F.row_number().over(in_order)).select(
        "partition_id", "begin_universal_data_id", "end_universal_data_id", "record_count")


MOST_RANGES = 1 << 20


def with_partition_id(df: DataFrame, ranges: DataFrame, key: str) -> DataFrame:
    """Rows that fall in a range, with the id of that range. Ranges don't overlap.

    The ranges' ends are one sorted array (a map has as many ranges as a move has tasks), and a row finds the last range that begins at its key or
    before by halving it: no join, no shuffle, and one comparison with one range's end at last, wherever the keys lie.
    """
    entry = F.struct(F.col("begin_universal_data_id").alias("low"), F.col("end_universal_data_id").alias("high"), F.col("partition_id").alias("id"))
    listed = F.sort_array(F.collect_list(entry))
    begins = ranges.agg(F.transform(listed, lambda x: x["low"])).scalar()
    entries = ranges.agg(listed).scalar()
    placed = df.withColumns({"_begins": begins, "_entries": entries})
    placed = placed.withColumn("_range", F.try_element_at("_entries", F.nullif(place_among(F.col(key), F.col("_begins"), MOST_RANGES), F.lit(0))))
    return placed.filter(F.col(key) <= F.col("_range.high")).select(*df.columns, F.col("_range.id").alias("partition_id"))
