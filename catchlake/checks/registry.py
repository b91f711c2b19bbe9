"""Registered queries: each one a function of the catch tables, with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catchlake.fixtures import Tables, with_views
from catchlake.session import shared_path
from catchlake.sources.readers import read_in_order


@dataclass(frozen=True)
class Check:
    run: Callable[[Tables], DataFrame]
    sql: str | None


CHECKS: dict[str, Check] = {}


def check(name: str, sql: str | None = None):
    """Register a query under a name. {view} in the SQL stands for a catch table."""
    def register(run):
        if name in CHECKS:
            raise ValueError(f"{name} is registered twice")
        CHECKS[name] = Check(run, with_views(sql) if sql else None)
        return run
    return register


def in_order(df: DataFrame, name: str) -> DataFrame:
    """A sorted frame with each row's position as it is read back from the written part files, one after the other."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return read_in_order(df.sparkSession, path).withColumn("position", F.col("position").cast("int"))


def spark_of(tables: Tables) -> SparkSession:
    return tables.orders.sparkSession
