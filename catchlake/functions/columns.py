"""Column expressions. All run inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from catchlake.constants import EXTENT_FILE


def ppr(catch: Column, trophic_level: Column, divisor: float = 9.0) -> Column:
    """Primary production required: catch / divisor * 10^(trophic level - 1) (Pauly and Christensen 1995)."""
    return catch.cast("double") / F.lit(divisor) * F.pow(F.lit(10.0), trophic_level.cast("double") - 1)


def first_known(*columns: Column) -> Column:
    return F.coalesce(*columns)


def in_year_range(year: Column, year_from: Column, year_to: Column) -> Column:
    """Half-open range test: year_from is inside, year_to is not."""
    return (year >= year_from) & (year < year_to)


def differs(left: Column, right: Column) -> Column:
    """NULL-safe difference: NULL differs from a value and not from NULL."""
    return ~left.eqNullSafe(right)


def has_key_prefix(key: Column, prefix: str) -> Column:
    return key.cast("string").startswith(prefix)


def coef_of_variation(value: Column) -> Column:
    """Sample deviation over mean as an aggregate; one sample or a zero mean gives NULL."""
    number = value.cast("double")
    return F.try_divide(F.stddev_samp(number), F.avg(number))


def tally_bucket(value: Column, low: Column, high: Column, buckets: int = 20) -> Column:
    """Zero-based equal-width bucket. The highest value lands one past the last bucket; low = high gives NULL."""
    return F.width_bucket(value.cast("double"), low.cast("double"), high.cast("double"), F.lit(buckets)) - 1


def money_text(amount: Column) -> Column:
    """Amount with thousands separators and two decimals, padded on the left."""
    return F.to_char(amount.cast("decimal(17,2)"), F.lit("999,999,999,999,999.99"))


def percent2(value: Column) -> Column:
    """A percentage at two decimals, halves up; noise past the eighth decimal is rounded off first."""
    return F.round(value, 8).cast("decimal(8,2)")


def without_empty_children(json_text: Column) -> Column:
    return F.replace(json_text, F.lit(',"children":[]'), F.lit(""))


def folder_to_name(folder: Column) -> Column:
    return F.replace(folder, F.lit("_"), F.lit(" "))


def extent_file_key(file_name: Column) -> Column:
    """Taxon key in an extent file's name; NULL where the name is not that of an extent."""
    return F.nullif(F.regexp_extract(file_name, EXTENT_FILE, 1), F.lit("")).cast("int")


def extent_file_is_extended(file_name: Column) -> Column:
    return F.regexp_extract(file_name, EXTENT_FILE, 2) != ""


def ring_area(ring: Column) -> Column:
    """Area of a closed ring of struct(x, y) points by the shoelace sum."""
    edges = F.zip_with(
        F.slice(ring, F.lit(1), F.greatest(F.size(ring) - 1, F.lit(0))),
        F.slice(ring, F.lit(2), F.greatest(F.size(ring) - 1, F.lit(0))),
        lambda a, b: a["x"] * b["y"] - b["x"] * a["y"],
    )
    return F.abs(F.aggregate(edges, F.lit(0.0), lambda total, edge: total + edge)) / 2
