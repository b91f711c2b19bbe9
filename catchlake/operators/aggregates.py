"""Grouping helpers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catchlake.functions.columns import coef_of_variation

TOTAL_DIGITS, TOTAL_SCALE = 26, 12


def total(df: DataFrame, keys: Sequence[str], column: str, name: str) -> DataFrame:
    """Sum by key. A decimal total is kept at 26 digits, 12 of them after the point at most, so that later products fit."""
    summed = df.groupBy(*keys).agg(F.sum(column).alias(name))
    return narrowed(summed, name)


def narrowed(df: DataFrame, *names: str) -> DataFrame:
    kinds = {f.name: f.dataType for f in df.schema}
    casts = {n: F.col(n).cast(T.DecimalType(TOTAL_DIGITS, min(kinds[n].scale, TOTAL_SCALE)))
             for n in names if isinstance(kinds[n], T.DecimalType) and kinds[n].precision > TOTAL_DIGITS}
    return df.withColumns(casts)


def sum_then_default(df: DataFrame, keys: Sequence[str], raw: str, default: object, **sums: Column) -> DataFrame:
    """Group by the raw column, fill its default afterwards: a NULL group and a default group stay apart."""
    grouped = df.groupBy(*keys, raw).agg(*[c.alias(n) for n, c in sums.items()])
    return grouped.withColumn(raw, F.coalesce(F.col(raw), F.lit(default)))


def variation(df: DataFrame, keys: Sequence[str], value: str, name: str = "coevar") -> DataFrame:
    return df.groupBy(*keys).agg(coef_of_variation(F.col(value)).alias(name))


def pivot_categories(df: DataFrame, keys: Sequence[str], category: str, value: str, names: Sequence[str]) -> DataFrame:
    """One column per category, numbered from 1; listing the categories saves the job that would look for them."""
    wide = df.groupBy(*keys).pivot(category, list(range(1, len(names) + 1))).agg(F.max(value))
    return wide.select(*keys, *[F.col(str(i)).alias(n) for i, n in enumerate(names, 1)])


def bounds(df: DataFrame, *columns: str) -> DataFrame:
    """Smallest and largest value of each column as one row min_<column>, max_<column>."""
    return df.agg(*[f(c).alias(f"{p}_{c}") for c in columns for p, f in (("min", F.min), ("max", F.max))])


def with_bounds(df: DataFrame, *columns: str) -> DataFrame:
    """df with its own bounds on every row, read as one scalar subquery. df is read twice, so give it cheap to read."""
    ends = df.agg(F.struct(*[f(c).alias(f"{p}_{c}") for c in columns for p, f in (("min", F.min), ("max", F.max))])).scalar()
    return df.withColumn("_ends", ends).select("*", "_ends.*").drop("_ends")


def blocked_arrays(df: DataFrame, keys: Sequence[str], value: str, width: int = 1000) -> DataFrame:
    """Sorted distinct values of each key as arrays, one array per block of `width` consecutive ids.

    A block holds at most `width` values, so a key with any number of rows never ends up in one array.
    """
    block = F.floor(F.col(value) / width).cast("bigint").alias("block")
    lists = df.groupBy(*keys, block).agg(F.array_sort(F.collect_set(value)).alias("ids"))
    return lists
