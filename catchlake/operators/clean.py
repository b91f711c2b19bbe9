"""Recodes, filters and fills."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catchlake.constants import DEFAULT_UNIT_PRICE
from catchlake.functions.columns import differs


def recode(df: DataFrame, column: str, codes: Mapping[int, int]) -> DataFrame:
    """Replace listed codes in one pass; other codes and NULL stay."""
    table = F.create_map(*[F.lit(x) for pair in codes.items() for x in pair])
    return df.withColumn(column, F.coalesce(F.try_element_at(table, F.col(column)), F.col(column)))


def merge_entity(df: DataFrame, column: str, merged: Mapping[int, int]) -> DataFrame:
    """Give rows of one entity to another; rows are not summed again."""
    return recode(df, column, merged)


def drop_zero(df: DataFrame, column: str) -> DataFrame:
    """Drop rows that are exactly zero; NULL rows stay."""
    return df.filter(differs(F.col(column), F.lit(0)))


def positive(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column) > 0)


def exclude_keys(df: DataFrame, column: str, keys: Iterable[int]) -> DataFrame:
    return df.filter(~F.col(column).isin(*keys))


def substitute(df: DataFrame, substitutes: DataFrame, key: str, old: str, new: str) -> DataFrame:
    """Replace keys through a lookup table; keys without an entry stay."""
    table = substitutes.select(F.col(old).alias("_old"), F.col(new).alias("_new"))
    joined = df.join(table, df[key] == table["_old"], "left")
    return joined.withColumn(key, F.coalesce("_new", key)).drop("_old", "_new")


def publish_catch(raw: DataFrame, substitutes: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Raw catch rows with substituted taxa in the published column order; the raw id is kept."""
    kept = substitute(raw, substitutes, "taxon_key", "original_taxon_key", "use_this_taxon_key_instead")
    return kept.withColumnRenamed("id", "raw_catch_id").select(*columns)


PRICE_KEYS = ("year", "fishing_entity_id", "taxon_key")


def lowest_end_use_price(price: DataFrame) -> DataFrame:
    """One price per (year, entity, taxon): that of the lowest end use."""
    return price.groupBy(*PRICE_KEYS).agg(F.min_by("price", "end_use_type_id").alias("price"))


def update_price(data: DataFrame, price: DataFrame) -> DataFrame:
    """Unit price taken from the price table where it has a row for the key, NULL prices included."""
    table = lowest_end_use_price(price).withColumn("_found", F.lit(True))
    joined = data.join(table, list(PRICE_KEYS), "left")
    refreshed = F.when(F.col("_found"), F.col("price")).otherwise(F.col("unit_price"))
    return joined.withColumn("unit_price", refreshed).select(*data.columns)


def changed_prices(data: DataFrame, price: DataFrame) -> DataFrame:
    """The rows whose unit price would change, with old and new price."""
    joined = data.join(lowest_end_use_price(price), list(PRICE_KEYS))
    changed = joined.filter(differs(F.col("unit_price"), F.col("price")))
    return changed.select("universal_data_id", *PRICE_KEYS, F.col("unit_price").alias("old_price"), "price")


def fill_price(df: DataFrame, column: str = "unit_price", price: float = DEFAULT_UNIT_PRICE) -> DataFrame:
    return df.withColumn(column, F.coalesce(F.col(column), F.lit(price)))


def with_constants(df: DataFrame, **values: object) -> DataFrame:
    return df.withColumns({name: v if isinstance(v, Column) else F.lit(v) for name, v in values.items()})
