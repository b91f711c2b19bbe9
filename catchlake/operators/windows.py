"""Window operators over annual series: one row per key and year, so a window is never longer than the calendar."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def with_peak(df: DataFrame, keys: Sequence[str], year: str, value: str) -> DataFrame:
    """Year and size of the largest value; the earliest year wins a tie, and NULL counts as zero."""
    best = Window.partitionBy(*keys).orderBy(F.coalesce(F.col(value), F.lit(0)).desc(), F.col(year).asc())
    return df.withColumns({"peak_year": F.first(year).over(best), "peak_catch_sum": F.first(value).over(best)})


def with_run(df: DataFrame, keys: Sequence[str], year: str, value: str, ahead: int = 4) -> DataFrame:
    """Positive years among this one and the next `ahead` rows; zero where this year has no catch."""
    caught = F.coalesce(F.col(value), F.lit(0)) != 0
    forward = Window.partitionBy(*keys).orderBy(year).rowsBetween(0, ahead)
    count = F.count(F.when(caught, 1)).over(forward)
    return df.withColumn("positive_catch_count", F.when(caught, count).otherwise(0).cast("int"))


def with_post_peak_min(df: DataFrame, keys: Sequence[str], year: str, value: str) -> DataFrame:
    """Year and size of the smallest value after the peak; the earliest year wins a tie."""
    later = F.when(F.col(year) > F.col("peak_year"), F.col(value))
    lowest = Window.partitionBy(*keys).orderBy(later.asc_nulls_last(), F.col(year).asc())
    return df.withColumns({
        "post_peak_min_year": F.first(year).over(lowest),
        "post_peak_min_catch_sum": F.first(value).over(lowest),
    })


def centred_mean(df: DataFrame, keys: Sequence[str], year: str, value: str, begin: str, end: str, name: str) -> DataFrame:
    """Mean of the previous, this and the next existing row; the raw value in the first and the last year."""
    three = Window.partitionBy(*keys).orderBy(year).rowsBetween(-1, 1)
    at_end = F.col(year).isin(F.col(begin), F.col(end))
    raw = F.col(value).cast("double")
    return df.withColumn(name, F.when(at_end, raw).otherwise(F.avg(raw).over(three)))
