"""Tables laid out by the key they are joined on, so that joins and sums by that key need no exchange.

A table is written in two parts. The even part is bucketed and sorted by the key; two tables with equal buckets meet bucket by bucket
in plain scans. Keys that hold more rows than a bucket should are few (fewer than there are buckets), and their rows are kept apart in the
hot part: those are joined to the few rows of the other table with such keys, which are sent to all tasks, so no bucket is longer
than about two even ones, however the keys are spread.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catchlake.operators.sizing import measured


@dataclass(frozen=True)
class Layout:
    key: str
    buckets: int

    def __post_init__(self):
        if self.buckets < 1:
            raise ValueError("a layout has one bucket at least")


def layout_for(df: DataFrame, key: str, rows: int = 1_000_000, least: int = 16) -> Layout:
    """A layout whose buckets hold about so many rows of df, so that what a task holds of a bucket doesn't grow with the table."""
    return Layout(key, max(least, -(-df.count() // rows)))


@dataclass(frozen=True)
class LaidOut:
    """The parts of a table, and the keys whose rows are in the hot part."""

    layout: Layout
    even: DataFrame
    hot: DataFrame
    hot_keys: DataFrame


def _bucketed(df: DataFrame, path: str, layout: Layout) -> DataFrame:
    name = f"laid_out_{uuid.uuid4().hex}"
    (df.repartition(layout.buckets, layout.key).write.format("parquet").mode("overwrite").option("path", path)
     .bucketBy(layout.buckets, layout.key).sortBy(layout.key).saveAsTable(name))
    return df.sparkSession.table(name)


def attach(spark: SparkSession, path: str, schema: str, layout: Layout, name: str) -> DataFrame:
    """The even part of a table that another session wrote, under a name of the catalog."""
    key = layout.key
    spark.sql(f"CREATE TABLE {name} ({schema}) USING parquet CLUSTERED BY ({key}) SORTED BY ({key}) INTO {layout.buckets} BUCKETS LOCATION '{path}/even'")
    return spark.table(name)


def lay_out(df: DataFrame, path: str, layout: Layout) -> LaidOut:
    """Write both parts of a table. Rows without a key are in the even part."""
    spark, key = df.sparkSession, layout.key
    counts = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))
    total = df.agg(F.count("*")).scalar()
    counts.filter(F.col("n") * layout.buckets > total).select(key).write.mode("overwrite").parquet(f"{path}/keys")
    keys = spark.read.schema(counts.select(key).schema).parquet(f"{path}/keys")
    few = F.broadcast(keys)  # fewer rows than buckets, since each holds more than a bucket's share
    even = _bucketed(df.join(few, key, "left_anti"), f"{path}/even", layout)
    df.join(few, key, "left_semi").write.mode("overwrite").parquet(f"{path}/hot")
    return LaidOut(layout, even, spark.read.schema(df.schema).parquet(f"{path}/hot"), keys)


def lay_out_side(df: DataFrame, path: str, layout: Layout) -> DataFrame:
    """Write the other side of joins: a table with about one row for each key, bucketed whole."""
    return _bucketed(df, f"{path}/even", layout)


def pairs_of(table: LaidOut, side: DataFrame) -> list[tuple[DataFrame, DataFrame]]:
    """What is to be joined by the key to give the join of the whole tables: (part of the table, part of the side). side comes from lay_out_side
    with an equal layout."""
    key = table.layout.key
    of_hot = measured(side=side.join(F.broadcast(table.hot_keys), key, "left_semi"))["side"]
    return [(table.even, side.hint("merge")), (table.hot, of_hot)]
