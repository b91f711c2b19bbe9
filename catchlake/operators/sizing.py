"""Measured broadcasts: a lookup is hinted only after its size has been counted."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_BYTES = 64 * 1024 * 1024
FIXED_WIDTH, NUMBER_WIDTH = 16, 8


def _bytes(value: Column, kind: T.DataType) -> Column:
    """About how many bytes a value takes, whatever it is made of."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        size = F.octet_length(value)
    elif isinstance(kind, T.ArrayType):
        if isinstance(kind.elementType, (T.StringType, T.BinaryType, T.ArrayType, T.MapType, T.StructType)):
            size = F.aggregate(value, F.lit(0).cast("bigint"), lambda total, x: total + _bytes(x, kind.elementType))
        else:
            size = F.lit(NUMBER_WIDTH) * F.size(value)
    elif isinstance(kind, T.MapType):
        size = _bytes(F.map_keys(value), T.ArrayType(kind.keyType)) + _bytes(F.map_values(value), T.ArrayType(kind.valueType))
    elif isinstance(kind, T.StructType):
        parts = [_bytes(value[f.name], f.dataType) for f in kind]
        size = reduce(Column.__add__, parts) if parts else F.lit(0)
    else:
        return F.lit(FIXED_WIDTH).cast("bigint")
    return F.lit(FIXED_WIDTH).cast("bigint") + F.greatest(F.coalesce(size.cast("bigint"), F.lit(0)), F.lit(0))


def _row_sizes(name: str, df: DataFrame) -> DataFrame:
    """About how many bytes each row takes; of the columns only those of variable size are read."""
    # a name may hold a dot, so columns are taken by their place
    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    size = reduce(Column.__add__, [_bytes(F.col(f.name), f.dataType) for f in plain.schema], F.lit(FIXED_WIDTH).cast("bigint"))
    return plain.select(F.lit(name).alias("name"), size.alias("bytes"))


def measured(max_bytes: int = BROADCAST_BYTES, keep: Callable[[DataFrame, str], DataFrame] = lambda df, name: df,
             **frames: DataFrame) -> dict[str, DataFrame]:
    """Return the same frames, with a broadcast hint on those that one counting job found small: the smallest first, as long as
    all that are hinted stay within the bound together.

    A frame beyond it is joined by shuffle, and adaptive execution splits the join's hot keys. It does so only
    where both sides come straight out of a shuffle, so pass session.materialize as keep for frames that are joins
    themselves: those beyond the bound are then written and joined as plain tables. The answer of the counting job is
    at most one row per frame.
    """
    rows = reduce(DataFrame.unionByName, [_row_sizes(name, df) for name, df in frames.items()])
    sizes = rows.groupBy("name").agg(F.sum("bytes").alias("bytes"))
    total, small = 0, set(frames)
    for row in sizes.orderBy("bytes", "name").collect():
        total += row["bytes"]
        if total > max_bytes:
            small.discard(row["name"])
    return {name: F.broadcast(df) if name in small else keep(df, name) for name, df in frames.items()}
