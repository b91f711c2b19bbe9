"""Extent loading, checking and rolling up along the taxon tree."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catchlake.functions.columns import extent_file_is_extended, extent_file_key, folder_to_name, ring_area
from catchlake.operators.aggregates import blocked_arrays
from catchlake.operators.grid import extent_cells

EXTENT = ["taxon_key", "is_extended"]


def rollup_children(taxa: DataFrame, extents: DataFrame, level: int) -> DataFrame:
    """Taxa of a level without an extent, with each child that has one: (taxon_key, child_taxon_key)."""
    have = extents.select("taxon_key").distinct()
    targets = taxa.filter(F.col("level") == level).join(have, "taxon_key", "left_anti").select("taxon_key", "lineage")
    children = taxa.join(have, "taxon_key", "left_semi").select(
        F.col("taxon_key").alias("child_taxon_key"), F.col("parent").alias("lineage"))
    return targets.join(children, "lineage").select("taxon_key", "child_taxon_key")


def rollup_counts(children: DataFrame) -> DataFrame:
    return children.groupBy("taxon_key").agg(F.count(F.lit(1)).alias("children_distributions_found"))


def rollup_log(children: DataFrame, width: int = 1000) -> DataFrame:
    """Bookkeeping rows: taxon, number of children, child keys in blocks of bounded length."""
    listed = blocked_arrays(children, ["taxon_key"], "child_taxon_key", width)
    return listed.withColumnRenamed("ids", "children_taxon_keys").join(rollup_counts(children), "taxon_key")


def rollup_extents(taxa: DataFrame, boxes: DataFrame, grid: DataFrame, level: int, size: float = 0.5) -> DataFrame:
    """Extents of a level out of those of the children, as cells: (taxon_key, is_extended, is_rolled_up, cell_id).

    An only child's extents are copied with their flag; several children make one extent that is not extended.
    """
    children = rollup_children(taxa, boxes, level)
    counted = children.join(rollup_counts(children), "taxon_key")
    parts = boxes.join(counted.withColumnsRenamed({"taxon_key": "_parent", "child_taxon_key": "taxon_key"}), "taxon_key")
    only = F.col("children_distributions_found") == 1
    parts = parts.withColumns({"taxon_key": F.col("_parent"), "is_extended": only & F.col("is_extended")})
    cells = extent_cells(parts, grid, EXTENT, size)
    return cells.select(*EXTENT, F.lit(True).alias("is_rolled_up"), "cell_id")


def invalid_extents(rings: DataFrame) -> DataFrame:
    """Extents whose ring is open, too short, not finite or without area."""
    ring = F.col("ring")
    first, last = F.try_element_at(ring, F.lit(1)), F.try_element_at(ring, F.lit(-1))
    finite = F.forall(ring, lambda p: (F.abs(p["x"]) < float("inf")) & (F.abs(p["y"]) < float("inf")))
    valid = (F.size(ring) >= 4) & first.eqNullSafe(last) & finite & (ring_area(ring) > 0)
    return rings.filter(~F.coalesce(valid, F.lit(False))).select("gid", "taxon_key")


def load_extents(features: DataFrame, taxa: DataFrame, existing: DataFrame) -> DataFrame:
    """Extents after loading files of features (file_name, ring).

    Every file replaces the extent of its (taxon, is_extended), the last name winning. It leaves a new one only if it
    holds exactly one feature, with an area, of a known taxon. Rows: (taxon_key, is_extended, ring).
    """
    files = features.groupBy("file_name").agg(F.count(F.lit(1)).alias("n"), F.any_value("ring").alias("ring"))
    files = files.withColumns({"taxon_key": extent_file_key(F.col("file_name")),
                               "is_extended": extent_file_is_extended(F.col("file_name"))})
    files = files.filter(F.col("taxon_key").isNotNull())
    last = files.groupBy(*EXTENT).agg(F.max_by(F.struct("n", "ring"), "file_name").alias("file"))
    usable = last.filter((F.col("file.n") == 1) & (ring_area(F.col("file.ring")) > 0))
    fresh = usable.join(taxa.select("taxon_key"), "taxon_key", "left_semi").select(*EXTENT, "file.ring")
    kept = existing.join(last.select(*EXTENT), EXTENT, "left_anti").select(*EXTENT, "ring")
    return kept.unionByName(fresh)


def check_manifest(paths: DataFrame, taxa: DataFrame) -> DataFrame:
    """Extent files that lie in a folder not named after their taxon: (path, taxon_key, taxon_name, folder)."""
    parts = F.split("path", "/")
    files = paths.select("path", F.try_element_at(parts, F.lit(-2)).alias("folder"),
                         extent_file_key(F.try_element_at(parts, F.lit(-1))).alias("taxon_key"))
    named = files.join(taxa.select("taxon_key", "taxon_name"), "taxon_key")
    return named.filter(F.col("taxon_name") != folder_to_name(F.col("folder"))).select("path", "taxon_key", "taxon_name", "folder")
