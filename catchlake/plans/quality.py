"""Checks on finished tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catchlake.operators.aggregates import variation
from catchlake.operators.joins import with_entity_name
from catchlake.sources.writers import write_partitioned


def catch_fluctuation(fact: DataFrame, area: DataFrame, names: DataFrame) -> DataFrame:
    """Coefficient of variation of the annual catch of each area, most variable first, unknown ahead of all."""
    annual = fact.groupBy("area_key", "year").agg(F.sum("catch_sum").alias("total_catch"))
    stats = variation(annual, ["area_key"], "total_catch")
    placed = stats.join(area.select("area_key", "marine_layer_id", "main_area_id"), "area_key")
    named = with_entity_name(placed, names)
    report = named.select("name", F.col("main_area_id").alias("area_id"), "layer_name", "coevar")
    return report.orderBy(F.col("coevar").desc_nulls_first(), "area_id", "layer_name")


def compare_distribution(old: DataFrame, new: DataFrame, cells: DataFrame, taxon: DataFrame) -> DataFrame:
    """Per taxon in both versions: water cells of the old one that are missing in the new one, and non-zero cells of each.

    Old rows count as missing once per new row without an abundance, or once if there is no new row at all. Both
    versions are stacked and counted per (taxon, cell), so each is read once and shuffled as counts.
    """
    def side(df: DataFrame, is_new: bool) -> DataFrame:
        return df.select("taxon_key", "cell_id", "relative_abundance", F.lit(is_new).alias("is_new"))

    def count(*tests: Column) -> Column:
        return F.count(F.when(reduce(and_, tests), 1))

    water = cells.filter(F.col("water_area") > 0).select("cell_id", F.lit(True).alias("_wet")).distinct()
    rows = side(old, False).unionByName(side(new, True)).join(water, "cell_id", "left")
    wet, is_new, abundance = F.col("_wet"), F.col("is_new"), F.col("relative_abundance")
    pairs = rows.groupBy("taxon_key", "cell_id").agg(
        count(wet, ~is_new).alias("old_rows"), count(wet, ~is_new, abundance > 0).alias("old_cells"),
        count(is_new).alias("new_rows"), count(is_new, abundance.isNull()).alias("new_unknown"),
        count(wet, is_new, abundance > 0).alias("new_cells"))
    missing = F.when(F.col("new_rows") == 0, F.col("old_rows")).otherwise(F.col("old_rows") * F.col("new_unknown"))
    report = pairs.groupBy("taxon_key").agg(
        F.sum(missing).alias("cells_now_missing"), F.sum("old_cells").alias("old_cells"),
        F.nullif(F.sum("new_cells"), F.lit(0)).alias("new_cells"), F.sum("new_rows").alias("new_rows"))
    report = report.filter("cells_now_missing > 0 and old_cells > 0 and new_rows > 0")
    named = report.join(taxon.select("taxon_key", "common_name"), "taxon_key")
    return named.select("common_name", "taxon_key", "cells_now_missing", "old_cells", "new_cells").orderBy(
        F.col("cells_now_missing").desc_nulls_first(), "taxon_key")


def run_rules(df: DataFrame, rules: Mapping[int, str], key: str) -> DataFrame:
    """Violations (rule_id, key) of a set of SQL predicates, from one scan of the table."""
    broken = F.array(*[F.when(F.expr(predicate), F.lit(rule)) for rule, predicate in rules.items()])
    return df.select(F.explode(F.array_compact(broken)).alias("rule_id"), F.col(key))


def write_rule_results(violations: DataFrame, path: str, rules: Iterable[int]) -> None:
    """Replace the result of the rules that were run, also of those that find nothing any more, and of no others."""
    write_partitioned(violations, path, "rule_id", list(rules))
