"""Catch by grid cell and year."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catchlake.operators.blooms import thinned
from catchlake.sources.writers import write_partitioned

CELL_KEYS = (
    "year", "taxon_key", "fishing_entity_id", "cell_id", "sector_type_id", "catch_type_id", "reporting_status_id",
    "gear_type_id",
)


def eez_ids(result: DataFrame, simple_area: DataFrame) -> DataFrame:
    """The ids with catch in an EEZ, without their sums."""
    inside = simple_area.filter("eez_id > 0").select("allocation_simple_area_id")
    return result.join(inside, "allocation_simple_area_id", "left_semi").select("universal_data_id").distinct()


def caught_data(data: DataFrame, eez_ids: DataFrame) -> DataFrame:
    """Allocation data of the ids that have EEZ catch. Of an id with any number of rows one travels."""
    return data.join(eez_ids.select("universal_data_id").distinct(), "universal_data_id", "left_semi")


def cell_sums(caught: DataFrame, result: DataFrame) -> DataFrame:
    """Catch per cell. caught is best written first (caught_data): both sides of the join are then plain tables, and
    an id with a large share of the result is split over tasks."""
    return cell_sums_of_parts([(result, caught)])


def cell_sums_of_parts(parts: Sequence[tuple[DataFrame, DataFrame]]) -> DataFrame:
    """Catch per cell from parts of the result, each with the caught data that belongs to it (see sources.layout.pairs_of)."""
    joined = [caught.join(result.select("universal_data_id", "cell_id", "allocated_catch"), "universal_data_id") for result, caught in parts]
    return reduce(DataFrame.unionByName, joined).groupBy(*CELL_KEYS).agg(F.sum("allocated_catch").alias("catch_sum"))


def enrich_cells(sums: DataFrame, taxon: DataFrame, catch_type: DataFrame, reporting_status: DataFrame) -> DataFrame:
    rows = sums.join(taxon.select("taxon_key", "commercial_group_id", "functional_group_id"), "taxon_key")
    rows = rows.join(catch_type.withColumnRenamed("abbreviation", "catch_status"), "catch_type_id")
    rows = rows.join(reporting_status.withColumnRenamed("abbreviation", "reporting_status"), "reporting_status_id")
    return rows.select("year", "taxon_key", "fishing_entity_id", "cell_id", "commercial_group_id", "functional_group_id",
                       "sector_type_id", "catch_status", "reporting_status", "catch_sum", "gear_type_id")


def published_data(data: DataFrame, years: DataFrame, taxa: DataFrame) -> DataFrame:
    """Allocation data of calendar years and published taxa."""
    calendar = years.select(F.col("time_business_key").alias("year"))
    return data.join(calendar, "year", "left_semi").join(taxa.select("taxon_key"), "taxon_key", "left_semi")


def cell_catch(data, result, eez_ids, taxon, catch_type, reporting_status, years, taxa, year: int | None = None,
               keep=lambda df, name: df) -> DataFrame:
    """Cell catch of all years, or of one. The year test reaches the scan of the data, and of the result only rows whose id may be among the
    year's go into the join (see operators.blooms).

    keep(df, name) may write the chosen data and return the written table.
    """
    if year is not None:
        data = data.filter(F.col("year") == year)
    caught = keep(caught_data(published_data(data, years, taxa), eez_ids), "caught-data")
    if year is not None:
        result = thinned(result, "universal_data_id", caught)
    return enrich_cells(cell_sums(caught, result), taxon, catch_type, reporting_status)


def refresh_year(cells: DataFrame, path: str, years: Sequence[int] = ()) -> None:
    """Write cell catch by year; the years present in the frame and those listed are replaced."""
    write_partitioned(cells, path, "year", years)
