"""Positions of rows in a global order, without a window over all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from catchlake.llm.common import free_name
from catchlake.session import materialize

ROW_BITS = 33  #: monotonically_increasing_id() keeps the row within the partition in these bits


def with_sorted_ids(df: DataFrame, order: Sequence[str | Column], name: str) -> DataFrame:
    """Sort all rows over range partitions and number them; written once, since ranges differ from run to run.

    The number's upper bits are the partition, its lower bits the row in it. Rows equal in the order may spread over
    several partitions only if the order ends in something that tells them apart, so end it so. Nulls come first; an empty frame stays empty.
    """
    return materialize(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(
        name, F.monotonically_increasing_id()), "sorted")


def part_of(name: str) -> Column:
    return F.shiftright(F.col(name), ROW_BITS)


def with_positions(df: DataFrame, order: Sequence[str | Column], name: str, total: str) -> DataFrame:
    """Add each row's position from 0 in the order, and the number of all rows. Equal rows have positions of their own, in any order."""
    at, part = free_name(df, "_at"), free_name(df, "_part")
    numbered = with_sorted_ids(df, order, at)
    counts = numbered.groupBy(part_of(at).alias(part)).agg(F.count("*").alias("_n"))
    before = W.orderBy(part).rowsBetween(W.unboundedPreceding, -1)  # a row for each partition
    starts = counts.select(part, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"),
                           F.sum("_n").over(W.partitionBy()).alias(total))
    position = F.col("_start") + F.col(at).bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    return (numbered.withColumn(part, part_of(at)).join(F.broadcast(starts), part)  # as many rows as partitions
            .withColumn(name, position).drop(at, part, "_start"))
