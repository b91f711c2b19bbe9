"""Joins. A lookup that should be broadcast comes in already measured (see sizing)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catchlake.constants import DEFAULT_END_USE, DISCARD_CATCH_TYPE, DISCARD_END_USE
from catchlake.functions.columns import in_year_range
from catchlake.layers import Layer

END_USE_KEYS = (
    "fishing_entity_id", "year", "taxon_key", "sector_type_id", "reporting_status_id", "gear_type_id", "catch_type_id",
)


def star(df: DataFrame, dims: Mapping[str, tuple[DataFrame, str, list[str]]]) -> DataFrame:
    """Inner joins to dimensions given as fact column -> (dimension, its key, its columns to keep)."""
    for column, (dim, key, keep) in dims.items():
        side = dim.select(F.col(key).alias(column), *keep)
        df = df.join(side, column)
    return df


UNUSED = -1


def area_join(df: DataFrame, area: DataFrame, layers: Sequence[Layer]) -> DataFrame:
    """Add area_key, looked up the way each row's layer says: among the areas of one layer, by main or sub area or both.

    A layer that does not use one of the two has it replaced by the same number on both sides, so one equi join serves
    all layers.
    """
    def used(column: str, layer: Layer) -> Column:
        return F.col(column) if column in layer.area_keys else F.lit(UNUSED)

    def entry(layer: Layer) -> Column:
        return F.when(F.col("marine_layer_id") == layer.area_layer, F.struct(
            F.lit(layer.layer_id).alias("marine_layer_id"), used("main_area_id", layer).alias("_main"),
            used("sub_area_id", layer).alias("_sub"), F.col("area_key")))

    def side(column: str) -> Column:
        idle = [layer.layer_id for layer in layers if column not in layer.area_keys]
        return F.when(F.col("marine_layer_id").isin(*idle), F.lit(UNUSED)).otherwise(F.col(column)) if idle else F.col(column)

    lookup = area.select(F.inline(F.array_compact(F.array(*[entry(layer) for layer in layers]))))
    placed = df.withColumns({"_main": side("main_area_id"), "_sub": side("sub_area_id")})
    return placed.join(lookup, ["marine_layer_id", "_main", "_sub"]).drop("_main", "_sub")


def split_end_use(df: DataFrame, end_use: DataFrame, amounts: list[str], discard_rule: bool | Column) -> DataFrame:
    """One row per end use with its share of each amount; rows without an entry keep the whole amount.

    Where the discard rule holds, a discard goes to its own end use unscaled, once per end use it matches.
    """
    share = F.coalesce("end_use_percentage", F.lit(1).cast(end_use.schema["end_use_percentage"].dataType))
    use = F.coalesce("end_use_type_id", F.lit(DEFAULT_END_USE))
    rule = F.lit(discard_rule) if isinstance(discard_rule, bool) else discard_rule
    discard = rule & (F.col("catch_type_id") == DISCARD_CATCH_TYPE)
    joined = df.join(end_use.select(*END_USE_KEYS, "end_use_type_id", "end_use_percentage"), list(END_USE_KEYS), "left")
    columns = {amount: F.when(discard, F.col(amount)).otherwise(F.col(amount) * share) for amount in amounts}
    columns["end_use_type_id"] = F.when(discard, F.lit(DISCARD_END_USE)).otherwise(use)
    return joined.withColumns(columns).drop("end_use_percentage")


def with_price(df: DataFrame, price: DataFrame) -> DataFrame:
    keys = ["fishing_entity_id", "year", "taxon_key", "end_use_type_id"]
    return df.join(price.select(*keys, "price"), keys, "left")


def uncertainty_periods(uncertainty: DataFrame, periods: DataFrame) -> DataFrame:
    """Scores with the year range of their period; a period without a range keeps NULL bounds and never matches."""
    return uncertainty.join(periods, "period_id", "left")


def with_score(df: DataFrame, scores: DataFrame, layer: str = "data_layer_id") -> DataFrame:
    """Left join to uncertainty_periods on area, sector and layer with the year inside the period. Overlaps repeat rows."""
    side = scores.select(
        F.col("eez_id").alias("_eez"), F.col("sector_type_id").alias("_sector"), F.col("layer").alias("_layer"),
        "year_from", "year_to", "score",
    )
    match = (
        (df["eez_id"] == side["_eez"])
        & (df["sector_type_id"] == side["_sector"])
        & (df[layer] == side["_layer"])
        & in_year_range(df["year"], side["year_from"], side["year_to"])
    )
    return df.join(side, match, "left").drop("_eez", "_sector", "_layer", "year_from", "year_to")


def densify(df: DataFrame, keys: list[str], year: str, value: str, years: DataFrame, years_column: str) -> DataFrame:
    """One row per key and calendar year, NULL where df has none. df holds one row per key and year.

    The calendar comes in as one array, and a key's values as a map no longer than the calendar, so the years are
    filled in without joining the frame to itself.
    """
    calendar = years.agg(F.array_sort(F.collect_set(years_column)).alias("calendar")).scalar()
    known = df.filter(F.col(year).isNotNull()).groupBy(*keys)
    by_year = known.agg(F.map_from_entries(F.collect_list(F.struct(year, value))).alias("_values"))
    rows = by_year.withColumn("_years", calendar).select(*keys, "_values", F.explode("_years").alias(year))
    return rows.select(*keys, year, F.try_element_at("_values", F.col(year)).alias(value))


def missing_in(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of old whose key is not in new. Keys are made distinct before they are shuffled."""
    return old.join(new.select(*keys).distinct(), keys, "left_anti")


def with_entity_name(df: DataFrame, names: DataFrame, layer: str = "marine_layer_id", area: str = "main_area_id") -> DataFrame:
    """Add name and layer_name of the entity of a layer; rows without a name are dropped."""
    side = names.select(F.col("marine_layer_id").alias(layer), F.col("id").alias(area), "name", "layer_name")
    return df.join(side, [layer, area])


def neighbours(cells: DataFrame, grid: DataFrame, keys: list[str], cell: str = "cell_id") -> DataFrame:
    """Grid cells that touch a cell of the set, diagonals included, the cell itself left out.

    Touching cells of a regular grid are its eight offsets, so this is an equi join on grid coordinates.
    """
    around = F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy"))
                       for dx in (-1, 0, 1) for dy in (-1, 0, 1) if (dx, dy) != (0, 0)])
    places = grid.select(F.col("id").alias(cell), "gx", "gy")
    wanted = cells.select(*keys, cell).join(places, cell).withColumn("o", F.explode(around))
    wanted = wanted.select(*keys, (F.col("gx") + F.col("o.dx")).alias("gx"), (F.col("gy") + F.col("o.dy")).alias("gy"))
    return wanted.distinct().join(places, ["gx", "gy"]).select(*keys, cell)


def allowed_pairs(df: DataFrame, pairs: DataFrame, keys: list[str]) -> DataFrame:
    """Keep rows whose key pair is listed."""
    return df.join(pairs.select(*keys), keys)


SHARE_TYPE = "decimal(18,12)"


def cell_weights(assignment: DataFrame, cell: DataFrame) -> DataFrame:
    """Areas of each cell with the share of the cell's water that each has: one lookup for the large join.

    The share keeps 12 digits after the point, so that a product with a catch of 18 digits fits whole and sums stay exact.
    """
    assigned = assignment.select("marine_layer_id", "area_id", "cell_id", F.col("fao_area_id").alias("cell_fao_area_id"),
                                 F.col("water_area").alias("_assigned"))
    joined = assigned.join(cell.select("cell_id", F.col("water_area").alias("_water")), "cell_id")
    return joined.withColumn("share", F.try_divide("_assigned", "_water").cast(SHARE_TYPE)).drop("_assigned", "_water")


def area_weighted(result: DataFrame, weights: DataFrame) -> DataFrame:
    """Catch of each cell shared out to the areas the cell is assigned to, by water area (see cell_weights).

    Rows keep all digits; they are rounded once, after they are summed. A cell without water gives NULL, which sums skip.
    The assignment's own FAO area comes along as cell_fao_area_id.
    """
    joined = result.join(weights, "cell_id")
    return joined.withColumn("allocated_catch", F.col("allocated_catch") * F.col("share")).drop("share")
