"""Sinks. Partitioned writes are rebalanced first: small partitions share a task and a hot one is split over several."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catchlake.constants import YEAR_COPY_COLUMNS
from catchlake.sources.versions import replace_partitions, replace_table

NULL_TEXT = "\\N"
#: In the order of writing; the backslash first.
ESCAPES = (("\\", "\\\\"), ("\t", "\\t"), ("\n", "\\n"), ("\r", "\\r"), ("\u0000", "\\x00"))
#: Blanks at the ends stay, and a quote is doubled, so that any text is read as it was written.
CSV_OPTIONS = {"escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def write_partitioned(df: DataFrame, path: str, key: str, refreshed: Sequence[int | str] = ()) -> None:
    """Parquet by key; a rerun replaces the partitions it writes and leaves the others. Read it by readers.read_current.

    refreshed lists the partitions that the frame is the whole new content of: those of them that have no rows any more are
    emptied. All of them change in one step, when everything is written (see sources.versions).
    """
    replace_partitions(df.hint("rebalance", key), path, key, refreshed)


def full_refresh(df: DataFrame, path: str, exclude: Sequence[str] = ()) -> None:
    """Replace a whole table in one step, leaving out listed columns. Read it by readers.read_current."""
    replace_table(df.drop(*exclude), path)


def write_summary(df: DataFrame, root: str, area_type: str) -> None:
    """Replace the summary of one area type."""
    full_refresh(df, f"{root}/{area_type}")


def write_fact(fact: DataFrame, path: str, layers: Sequence[int] = ()) -> None:
    """Replace the layers present in the frame and those listed, so that a rerun neither doubles rows nor keeps old ones."""
    write_partitioned(fact, path, "marine_layer_id", layers)


def write_by_year(data: DataFrame, path: str, columns: Sequence[str] = YEAR_COPY_COLUMNS) -> None:
    """Year-partitioned copy of the allocation data; the old copy is dropped."""
    spread = data.select(*columns).hint("rebalance", "year")
    spread.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("year").parquet(path)


def escaped(column: Column) -> Column:
    """A value as COPY text: backslash, tab, line ends and zero are written with a backslash, NULL as \\N."""
    out = column.cast("string")
    for plain, mark in ESCAPES:
        out = F.replace(out, F.lit(plain), F.lit(mark))
    return F.coalesce(out, F.lit(NULL_TEXT))


def write_text(df: DataFrame, path: str) -> None:
    """One line of UTF-8 for each row, in the text format of COPY: values parted by tabs, \\N for NULL."""
    line = F.concat_ws("\t", *[escaped(F.col(c)) for c in df.columns])
    df.select(line.alias("value")).write.mode("overwrite").option("lineSep", "\n").text(path)


def write_csv_per_entity(df: DataFrame, key: str, path: str) -> None:
    """One folder of CSV per entity, each file with a header; entities without rows have no folder."""
    spread = df.hint("rebalance", key)
    spread.write.mode("overwrite").partitionBy(key).options(header=True, **CSV_OPTIONS).csv(path)


def write_json_doc(lines: DataFrame, order: Sequence[str], path: str, text: str = "text") -> None:
    """Write the lines of a document in order; the part files read one after the other are the document."""
    lines.orderBy(*order).select(F.col(text).alias("value")).write.mode("overwrite").text(path)
