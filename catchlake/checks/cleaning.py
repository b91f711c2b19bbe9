"""Recodes, filters and fills."""

from __future__ import annotations

from pyspark.sql import functions as F

from catchlake import constants as C
from catchlake.checks.registry import check
from catchlake.functions import columns as X
from catchlake.operators import clean
from catchlake.operators.aggregates import with_bounds
from catchlake.operators.joins import END_USE_KEYS
from catchlake.operators.sizing import measured

GEAR_CASE = "case gear_type_id " + " ".join(f"when {a} then {b}" for a, b in C.GEAR_CODES.items()) + " else gear_type_id end"


@check("f01_gear_recode", f"""
select universal_data_id, cast({GEAR_CASE} as int) as gear_type_id from {{allocation_data}}""")
def f01(t):
    return clean.recode(t.allocation_data, "gear_type_id", C.GEAR_CODES).select("universal_data_id", "gear_type_id")


@check("f02_merge_entity", """
select universal_data_id, case fishing_entity_id when 23 then 13 else fishing_entity_id end as fishing_entity_id
from {allocation_data}""")
def f02(t):
    return clean.merge_entity(t.allocation_data, "fishing_entity_id", {23: 13}).select("universal_data_id", "fishing_entity_id")


@check("f03_drop_zero", "select * from {allocation_result} where allocated_catch is distinct from 0")
def f03(t):
    return clean.drop_zero(t.allocation_result, "allocated_catch")


@check("f04_positive", "select universal_data_id, cell_id, allocated_catch from {allocation_result} where allocated_catch > 0")
def f04(t):
    return clean.positive(t.allocation_result, "allocated_catch").select("universal_data_id", "cell_id", "allocated_catch")


@check("f05_publish_catch", "select " + ", ".join(
    {"taxon_key": "coalesce(use_this_taxon_key_instead, taxon_key) as taxon_key", "raw_catch_id": "id as raw_catch_id"}.get(c, c)
    for c in C.CATCH_COLUMNS) + " from {raw_catch} left join {taxon_substitute} on original_taxon_key = taxon_key")
def f05(t):
    return clean.publish_catch(t.raw_catch, measured(s=t.taxon_substitute)["s"], C.CATCH_COLUMNS)


LOWEST_PRICE = """
with lowest as (select year, fishing_entity_id, taxon_key, end_use_type_id, price from {price}
  qualify row_number() over (partition by year, fishing_entity_id, taxon_key order by end_use_type_id) = 1)
"""


@check("f06_update_price", LOWEST_PRICE + """
select universal_data_id, case when p.end_use_type_id is not null then p.price else d.unit_price end as unit_price from {allocation_data} d
left join lowest p on p.year = d.year and p.fishing_entity_id = d.fishing_entity_id and p.taxon_key = d.taxon_key""")
def f06(t):
    return clean.update_price(t.allocation_data, t.price).select("universal_data_id", "unit_price")


@check("f06_changed_prices", LOWEST_PRICE + """
select universal_data_id, d.year, d.fishing_entity_id, d.taxon_key, unit_price as old_price, p.price from {allocation_data} d
join lowest p on p.year = d.year and p.fishing_entity_id = d.fishing_entity_id and p.taxon_key = d.taxon_key
where unit_price is distinct from p.price""")
def f06_changed(t):
    return clean.changed_prices(t.allocation_data, t.price)


@check("f07_fill_price", """
select universal_data_id, cast(coalesce(unit_price, 1466) as decimal(18,2)) as unit_price from {allocation_data}""")
def f07(t):
    filled = clean.fill_price(t.allocation_data)
    return filled.select("universal_data_id", F.col("unit_price").cast("decimal(18,2)").alias("unit_price"))


@check("f08_chained_defaults", """
select d.universal_data_id, coalesce(end_use_type_id, 1) as end_use_type_id,
  cast(coalesce(end_use_percentage, null, 1) as decimal(6,4)) as end_use_percentage
from {allocation_data} d left join {end_use} e using (fishing_entity_id, year, taxon_key, sector_type_id, reporting_status_id,
  gear_type_id, catch_type_id)""")
def f08(t):
    joined = t.allocation_data.join(t.end_use, list(END_USE_KEYS), "left")
    share = X.first_known(F.col("end_use_percentage"), F.lit(None), F.lit(1)).cast("decimal(6,4)")
    return joined.select("universal_data_id", X.first_known(F.col("end_use_type_id"), F.lit(1)).alias("end_use_type_id"),
                         share.alias("end_use_percentage"))


@check("f09_membership", """
select main_area_id, marine_layer_id, taxon_key, year, catch_sum from {stock_fact}
where marine_layer_id in (1, 2) and taxon_key not in (1, 5, 7, 11)""")
def f09(t):
    kept = clean.exclude_keys(t.stock_fact.filter(F.col("marine_layer_id").isin(1, 2)), "taxon_key", [1, 5, 7, 11])
    return kept.select("main_area_id", "marine_layer_id", "taxon_key", "year", "catch_sum")


@check("f10_key_range", "select universal_data_id, year from {allocation_data} where year between 1996 and 1999")
def f10(t):
    return t.allocation_data.filter(F.col("year").between(1996, 1999)).select("universal_data_id", "year")


@check("f11_key_prefix", """
select taxon_key, common_name from {taxon_lineage} where cast(taxon_key as varchar) like '10%'""")
def f11(t):
    return t.taxon_lineage.filter(X.has_key_prefix(F.col("taxon_key"), "10")).select("taxon_key", "common_name")


@check("f13_null_safe_difference", """
select universal_data_id, unit_price is distinct from cast(null as decimal(18,2)) as known,
  nullif(taxon_key, 3) is distinct from 5 as other_taxon from {allocation_data}""")
def f13(t):
    return t.allocation_data.select(
        "universal_data_id", X.differs(F.col("unit_price"), F.lit(None)).alias("known"),
        X.differs(F.nullif("taxon_key", F.lit(3)), F.lit(5)).alias("other_taxon"))


@check("f14_searched_case", """
select universal_data_id, case when catch_type_id = 2 then 4 when unit_price is null then 1 else sector_type_id end as end_use_type_id
from {allocation_data}""")
def f14(t):
    use = F.when(F.col("catch_type_id") == 2, 4).when(F.col("unit_price").isNull(), 1).otherwise(F.col("sector_type_id"))
    return t.allocation_data.select("universal_data_id", use.alias("end_use_type_id"))


@check("f15_constant_columns", """
select universal_data_id, 2 as marine_layer_id, 0 as sub_area_id, 1 as score, cast(null as int) as no_score from {allocation_data}""")
def f15(t):
    ids = t.allocation_data.select("universal_data_id")
    return clean.with_constants(ids, marine_layer_id=2, sub_area_id=0, score=1, no_score=F.lit(None).cast("int"))


# Scalar functions.


@check("x01_x02_coalesce_and_casts", """
select universal_data_id, cast(coalesce(unit_price, 0) as decimal(20,0)) as whole, cast(taxon_key as varchar) as taxon_text,
  cast(coalesce(unit_price, 0.5) as decimal(18,2)) as two_digits from {allocation_data}""")
def x01(t):
    price = F.col("unit_price")
    return t.allocation_data.select(
        "universal_data_id", F.coalesce(price, F.lit(0)).cast("decimal(20,0)").alias("whole"),
        F.col("taxon_key").cast("string").alias("taxon_text"),
        F.coalesce(price, F.lit(0.5).cast("decimal(2,1)")).cast("decimal(18,2)").alias("two_digits"))


@check("x03_arithmetic", """
select cell_id, round(sqrt(cast(water_area as double)) + 1, 6) as root, round(cast(water_area as double) * 2 / 7 - 3, 6) as linear
from {cell}""")
def x03(t):
    water = F.col("water_area").cast("double")
    return t.cell.select("cell_id", F.round(F.sqrt(water) + 1, 6).alias("root"), F.round(water * 2 / 7 - 3, 6).alias("linear"))


@check("x04_tally_bucket", """
select universal_data_id, case when hi = lo or v is null then null else cast(least(floor((v - lo) * 20 / (hi - lo)), 20) as bigint) end as bucket
from (select universal_data_id, cast(unit_price as double) as v, cast(min(unit_price) over () as double) as lo,
  cast(max(unit_price) over () as double) as hi from {allocation_data}) x""")
def x04(t):
    rows = with_bounds(t.allocation_data.select("universal_data_id", "unit_price"), "unit_price")
    bucket = X.tally_bucket(F.col("unit_price"), F.col("min_unit_price"), F.col("max_unit_price"))
    return rows.select("universal_data_id", bucket.alias("bucket"))


@check("x05_money_text", """
select taxon_key, lpad(format('{:,.2f}', total_catch), 22, ' ') as total_catch from {taxon_lineage}""")
def x05(t):
    return t.taxon_lineage.select("taxon_key", X.money_text(F.col("total_catch")).alias("total_catch"))


@check("x07_replace", """
select taxon_key, replace(concat('{"key":', taxon_key, case when level = 3 then ',"children":[]' else '' end, '}'), ',"children":[]', '')
  as document, replace(common_name, '_', ' ') as name from {taxon_lineage}""")
def x07(t):
    text = F.concat(F.lit('{"key":'), F.col("taxon_key"), F.when(F.col("level") == 3, ',"children":[]').otherwise(""), F.lit("}"))
    return t.taxon_lineage.select("taxon_key", X.without_empty_children(text).alias("document"),
                                  X.folder_to_name(F.col("common_name")).alias("name"))


@check("x08_extent_file_name", r"""
select gid, file_name, cast(regexp_extract(file_name, '^(\d+)\-?(\d+)?.shp', 1) as int) as taxon_key,
  regexp_extract(file_name, '^(\d+)\-?(\d+)?.shp', 2) <> '' as is_extended from {extent_feature}""")
def x08(t):
    name = F.col("file_name")
    return t.extent_feature.select("gid", "file_name", X.extent_file_key(name).alias("taxon_key"),
                                   X.extent_file_is_extended(name).alias("is_extended"))


@check("x13_json_builder", """
select universal_data_id, json_object('id', universal_data_id, 'price', unit_price, 'type', catch_type_id) as document
from {allocation_data}""")
def x13(t):
    fields = F.struct(F.col("universal_data_id").alias("id"), F.col("unit_price").alias("price"), F.col("catch_type_id").alias("type"))
    return t.allocation_data.select("universal_data_id", F.to_json(fields, {"ignoreNullFields": "false"}).alias("document"))


@check("x14_year_range", """
select universal_data_id, period_id from {allocation_data} join {uncertainty_time_period} on year >= year_from and year < year_to""")
def x14(t):
    inside = X.in_year_range(F.col("year"), F.col("year_from"), F.col("year_to"))
    periods = F.broadcast(t.uncertainty_time_period)  # two literal rows
    return t.allocation_data.join(periods, inside).select("universal_data_id", "period_id")
