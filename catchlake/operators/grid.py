"""Extents as axis-aligned boxes or sets of grid cells.

Boxes meet through bins: each box is listed under the bins it touches, and boxes are joined on the bin. Nothing is
compared with everything; the work follows the area covered.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catchlake.operators.joins import neighbours

CORNERS = ("xmin", "ymin", "xmax", "ymax")


def _bin(value: Column, size: float) -> Column:
    return F.floor(value / F.lit(size))


def binned(df: DataFrame, size: float, margin: float = 0.0, prefix: str = "") -> DataFrame:
    """One row per bin that the box, widened by margin on all sides, touches."""
    def span(axis: str) -> Column:
        return F.sequence(_bin(F.col(f"{prefix}{axis}min") - margin, size), _bin(F.col(f"{prefix}{axis}max") + margin, size))

    return df.withColumn("bx", F.explode(span("x"))).withColumn("by", F.explode(span("y")))


def _prefixed(df: DataFrame, prefix: str) -> DataFrame:
    return df.withColumnsRenamed({c: f"{prefix}{c}" for c in CORNERS})


def touching(left: DataFrame, right: DataFrame, size: float = 0.5, margin: float = 0.0, on: Sequence[str] = ()) -> DataFrame:
    """Pairs of boxes that meet once the left one is widened by margin; touching counts.

    Left corners come out as l_xmin.., right ones as r_xmin... A pair is kept only in the bin of the lower-left corner
    of its overlap, so it comes out once without a distinct.
    """
    a = binned(_prefixed(left, "l_"), size, margin, "l_")
    b = binned(_prefixed(right, "r_"), size, 0.0, "r_")
    pairs = a.join(b, [*on, "bx", "by"])
    c = F.col
    meet = ((c("l_xmin") - margin <= c("r_xmax")) & (c("r_xmin") <= c("l_xmax") + margin)
            & (c("l_ymin") - margin <= c("r_ymax")) & (c("r_ymin") <= c("l_ymax") + margin))
    home = ((c("bx") == _bin(F.greatest(c("l_xmin") - margin, c("r_xmin")), size))
            & (c("by") == _bin(F.greatest(c("l_ymin") - margin, c("r_ymin")), size)))
    return pairs.filter(meet & home).drop("bx", "by")


def intersecting(boxes: DataFrame, grid: DataFrame, size: float = 0.5) -> DataFrame:
    """Extent boxes with the grid cells they meet."""
    cells = grid.select(F.col("id").alias("cell_id"), *CORNERS)
    return touching(boxes, cells, size)


def clip(pairs: DataFrame) -> DataFrame:
    """The common box of each pair and its area."""
    c = F.col
    clipped = pairs.withColumns({
        "xmin": F.greatest("l_xmin", "r_xmin"), "ymin": F.greatest("l_ymin", "r_ymin"),
        "xmax": F.least("l_xmax", "r_xmax"), "ymax": F.least("l_ymax", "r_ymax"),
    }).drop(*[f"{side}{corner}" for side in ("l_", "r_") for corner in CORNERS])
    return clipped.withColumn("area", (c("xmax") - c("xmin")) * (c("ymax") - c("ymin")))


def union_by(pieces: DataFrame, key: str) -> DataFrame:
    """Union of the pieces of each key as piece count, bounds and area. Areas add up when the pieces are disjoint."""
    return pieces.groupBy(key).agg(
        F.count(F.lit(1)).alias("pieces"), F.sum("area").alias("area"),
        F.min("xmin").alias("xmin"), F.min("ymin").alias("ymin"), F.max("xmax").alias("xmax"), F.max("ymax").alias("ymax"))


def extent_cells(boxes: DataFrame, grid: DataFrame, keys: Sequence[str], size: float = 0.5) -> DataFrame:
    """Distinct cells under the boxes of each key. Equal boxes of a key are binned once."""
    outlines = boxes.select(*keys, *CORNERS).distinct()
    return intersecting(outlines, grid, size).select(*keys, "cell_id").distinct()


def merge_extents(cells: DataFrame, taxa: DataFrame) -> DataFrame:
    """One set of cells per listed taxon, out of all its extents."""
    return cells.join(taxa.select("taxon_key"), "taxon_key", "left_semi").select("taxon_key", "cell_id").distinct()


def extent_from_distribution(dist: DataFrame, grid: DataFrame, taxa: DataFrame) -> DataFrame:
    """Extent of a listed taxon out of its backfilled cells: the cells on the grid and all that touch them."""
    filled = dist.filter("is_backfilled").join(taxa.select("taxon_key"), "taxon_key", "left_semi")
    filled = filled.select("taxon_key", "cell_id").join(grid.select(F.col("id").alias("cell_id")), "cell_id", "left_semi")
    return filled.unionByName(neighbours(filled, grid, ["taxon_key"])).distinct()


def outside_extent(dist: DataFrame, grid: DataFrame, boxes: DataFrame, distance: float = 0.1, size: float = 1.0,
                   keep=lambda df, name: df) -> DataFrame:
    """Cells of a taxon farther than distance from an extent of it: (taxon_key, is_extended, cell_id).

    An extent is all boxes of one (taxon, is_extended). Each extent reports the cells it misses; a taxon without an
    extent reports none, nor does one all of whose cells are backfilled. Near cells are found through bins, and what
    is left of a taxon's cells is outside, so a cell is never measured against every box. keep(df, name) may write the
    taxa's cells and return the written table, so that the distribution is read once.
    """
    extent = ["taxon_key", "is_extended"]
    cell = ["taxon_key", "cell_id"]
    cells = keep(dist.groupBy(*cell).agg(F.bool_or(~F.col("is_backfilled")).alias("_seen")), "taxon-cells")
    tested = cells.join(cells.filter("_seen").select("taxon_key").distinct(), "taxon_key", "left_semi")
    places = tested.select(*cell).join(grid.select(F.col("id").alias("cell_id"), *CORNERS), "cell_id")
    outlines = boxes.select(*extent, *CORNERS).distinct()

    pairs = touching(outlines, places, size, distance, on=["taxon_key"])
    gap_x = F.greatest(F.col("l_xmin") - F.col("r_xmax"), F.col("r_xmin") - F.col("l_xmax"), F.lit(0.0))
    gap_y = F.greatest(F.col("l_ymin") - F.col("r_ymax"), F.col("r_ymin") - F.col("l_ymax"), F.lit(0.0))
    near = pairs.filter(F.sqrt(gap_x * gap_x + gap_y * gap_y) <= distance).select(*extent, "cell_id")

    every = places.select(*cell).join(boxes.select(*extent).distinct(), "taxon_key")
    return every.join(near, [*extent, "cell_id"], "left_anti").select(*extent, "cell_id")


#: A box is covered by cells of a sixteenth of its longer side or up to twice that, so by 17 x 17 cells at most.
ACROSS = 16
LEVELS = (-30, 50)  #: cells measure 2 to the power of a level


def _level(xmin: str, ymin: str, xmax: str, ymax: str) -> Column:
    """The level of the cells that cover a box; that of a point is the lowest."""
    side = F.greatest(F.col(xmax) - F.col(xmin), F.col(ymax) - F.col(ymin))
    level = F.ceil(F.log2(F.nullif(side, F.lit(0.0)) / ACROSS)).cast("int")
    return F.when(side >= 0, F.least(F.greatest(F.coalesce(level, F.lit(LEVELS[0])), F.lit(LEVELS[0])), F.lit(LEVELS[1])))


def cover(boxes: DataFrame, prefix: str = "") -> DataFrame:
    """A row for each cell of a quadtree (level, bx, by) that covers a part of a box. Cells are as large as the box is, so a box of any size has a few hundred."""
    corners = [f"{prefix}{c}" for c in CORNERS]
    levelled = boxes.withColumn("level", _level(*corners))
    size = F.pow(F.lit(2.0), F.col("level"))
    span = lambda axis: F.sequence(F.floor(F.col(f"{prefix}{axis}min") / size), F.floor(F.col(f"{prefix}{axis}max") / size))
    return levelled.filter("level IS NOT NULL").withColumn("bx", F.explode(span("x"))).withColumn("by", F.explode(span("y")))


def purge_contained(boxes: DataFrame, key: str, box_id: str) -> DataFrame:
    """Boxes of each key that lie in no other box of it. Of equal boxes the lowest id stays.

    Equal boxes are folded into one before the join. A box lies in none that is covered by smaller cells than itself, so its lower-left corner is looked
    up once at each level from its own on that some box has, and there are as many of these as sizes of boxes double.
    """
    unique = boxes.groupBy(key, *CORNERS).agg(F.min(box_id).alias(box_id))
    outer = cover(_prefixed(unique, "o_").withColumnsRenamed({box_id: "o_id", key: "o_key"}), "o_")
    levels = [r[0] for r in unique.select(_level(*CORNERS)).distinct().collect() if r[0] is not None]  # as many as LEVELS has, at most
    inner = unique.withColumn("_own", _level(*CORNERS)).withColumn("level", F.explode(F.array(*[F.lit(n) for n in levels]).cast("array<int>"))).filter("level >= _own")
    size = F.pow(F.lit(2.0), F.col("level"))
    inner = inner.withColumns({"bx": F.floor(F.col("xmin") / size), "by": F.floor(F.col("ymin") / size)}).alias("i")
    outer, c = outer.alias("o"), F.col
    inside = (
        (c(f"i.{key}") == c("o_key")) & (c("i.level") == c("o.level")) & (c("i.bx") == c("o.bx")) & (c("i.by") == c("o.by")) & (c(f"i.{box_id}") != c("o_id"))
        & (c("o_xmin") <= c("i.xmin")) & (c("o_ymin") <= c("i.ymin")) & (c("o_xmax") >= c("i.xmax")) & (c("o_ymax") >= c("i.ymax"))
    )
    contained = inner.join(outer, inside, "left_semi").select(key, box_id).distinct()
    return unique.join(contained, [key, box_id], "left_anti").select(box_id, key, *CORNERS)
