"""Joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from catchlake.checks.registry import check
from catchlake.layers import LAYERS
from catchlake.operators import joins
from catchlake.operators.sizing import measured
from catchlake.session import materialize

DATA_PLACE = "d.universal_data_id, d.catch_type_id"


@check("j01_fact_to_fact", """
select d.year, d.taxon_key, cast(sum(r.allocated_catch) as decimal(28,4)) as catch from {allocation_data} d
join {allocation_result} r on r.universal_data_id = d.universal_data_id group by 1, 2""")
def j01(t):
    joined = t.allocation_data.join(t.allocation_result, "universal_data_id")
    return joined.groupBy("year", "taxon_key").agg(F.sum("allocated_catch").cast("decimal(28,4)").alias("catch"))


@check("j02_star", """
select d.universal_data_id, tl, c.abbreviation as catch_status, s.abbreviation as reporting_status, time_key
from {allocation_data} d join {cube_dim_taxon} t on t.taxon_key = d.taxon_key
join {catch_type} c on c.catch_type_id = d.catch_type_id join {reporting_status} s on s.reporting_status_id = d.reporting_status_id
join {time_dim} m on m.time_business_key = d.year join {gear} g on g.gear_id = d.gear_type_id""")
def j02(t):
    dims = measured(taxon=t.cube_dim_taxon, catch_type=t.catch_type, status=t.reporting_status, time=t.time_dim, gear=t.gear)
    rows = joins.star(t.allocation_data, {
        "taxon_key": (dims["taxon"], "taxon_key", ["tl"]),
        "catch_type_id": (dims["catch_type"], "catch_type_id", [F.col("abbreviation").alias("catch_status")]),
        "reporting_status_id": (dims["status"], "reporting_status_id", [F.col("abbreviation").alias("reporting_status")]),
        "year": (dims["time"], "time_business_key", ["time_key"]),
        "gear_type_id": (dims["gear"], "gear_id", []),
    })
    return rows.select("universal_data_id", "tl", "catch_status", "reporting_status", "time_key")


@check("j03_area_join", """
select 'eez' as layer, s.allocation_simple_area_id, a.area_key from {allocation_simple_area} s
join {area} a on a.marine_layer_id = 1 and a.main_area_id = s.eez_id and a.sub_area_id = s.fao_area_id
union all
select 'lme', s.allocation_simple_area_id, a.area_key from {allocation_simple_area} s
join {area} a on a.marine_layer_id = 3 and a.main_area_id = s.eez_id
union all
select 'global', s.allocation_simple_area_id, a.area_key from {allocation_simple_area} s
join {area} a on a.marine_layer_id = 6 and a.sub_area_id = s.fao_area_id
union all
select 'ifa', s.allocation_simple_area_id, a.area_key from {allocation_simple_area} s
join {area} a on a.marine_layer_id = 1 and a.main_area_id = s.eez_id and a.sub_area_id = s.fao_area_id""")
def j03(t):
    area = measured(area=t.area)["area"]
    places = t.allocation_simple_area.withColumnsRenamed({"eez_id": "main_area_id", "fao_area_id": "sub_area_id"})
    layers = [LAYERS[name] for name in ("eez", "lme", "global", "ifa")]
    ids = F.array(*[F.struct(F.lit(x.name).alias("layer"), F.lit(x.layer_id).alias("marine_layer_id")) for x in layers])
    rows = joins.area_join(places.select("*", F.inline(ids)), area, layers)
    return rows.select("layer", "allocation_simple_area_id", "area_key")


END_USE_ON = """e.fishing_entity_id = d.fishing_entity_id and e.year = d.year and e.taxon_key = d.taxon_key
  and e.sector_type_id = d.sector_type_id and e.reporting_status_id = d.reporting_status_id
  and e.gear_type_id = d.gear_type_id and e.catch_type_id = d.catch_type_id"""


@check("j04_b01_end_use_with_discards", f"""
select {DATA_PLACE}, case when d.catch_type_id = 2 then 4 else coalesce(e.end_use_type_id, 1) end as end_use_type_id,
  cast(case when d.catch_type_id = 2 then d.unit_price else d.unit_price * coalesce(e.end_use_percentage, 1) end as decimal(24,6)) as amount
from {{allocation_data}} d left join {{end_use}} e on {END_USE_ON}""")
def j04(t):
    rows = joins.split_end_use(t.allocation_data.withColumn("amount", F.col("unit_price")), t.end_use, ["amount"], True)
    return rows.select("universal_data_id", "catch_type_id", "end_use_type_id", F.col("amount").cast("decimal(24,6)").alias("amount"))


@check("j04_b02_end_use_simple", f"""
select {DATA_PLACE}, coalesce(e.end_use_type_id, 1) as end_use_type_id,
  cast(d.unit_price * coalesce(e.end_use_percentage, 1) as decimal(24,6)) as amount
from {{allocation_data}} d left join {{end_use}} e on {END_USE_ON}""")
def j04_simple(t):
    rows = joins.split_end_use(t.allocation_data.withColumn("amount", F.col("unit_price")), t.end_use, ["amount"], False)
    return rows.select("universal_data_id", "catch_type_id", "end_use_type_id", F.col("amount").cast("decimal(24,6)").alias("amount"))


@check("j05_b03_price", """
select d.universal_data_id, p.price, cast(coalesce(p.price, 1466) as decimal(18,2)) as used_price from {allocation_data} d
left join {price} p on p.fishing_entity_id = d.fishing_entity_id and p.year = d.year and p.taxon_key = d.taxon_key
  and p.end_use_type_id = d.sector_type_id""")
def j05(t):
    rows = joins.with_price(t.allocation_data.withColumn("end_use_type_id", F.col("sector_type_id")), t.price)
    return rows.select("universal_data_id", "price", F.coalesce("price", F.lit(1466)).cast("decimal(18,2)").alias("used_price"))


@check("j06_b05_score_by_period", """
select d.universal_data_id, u.score from {allocation_data} d left join (
  select ue.*, year_from, year_to from {uncertainty_eez} ue left join {uncertainty_time_period} p on p.period_id = ue.period_id) u
on u.eez_id = d.fishing_entity_id and u.sector_type_id = d.sector_type_id and u.layer = d.data_layer_id
  and d.year >= u.year_from and d.year < u.year_to""")
def j06(t):
    scores = measured(keep=materialize, scores=joins.uncertainty_periods(t.uncertainty_eez, t.uncertainty_time_period))["scores"]
    rows = t.allocation_data.withColumn("eez_id", F.col("fishing_entity_id"))
    return joins.with_score(rows, scores).select("universal_data_id", "score")


@check("j07_uncertainty_periods", """
select eez_id, sector_type_id, u.period_id, score, layer, year_from, year_to
from {uncertainty_eez} u left join {uncertainty_time_period} p on p.period_id = u.period_id""")
def j07(t):
    return joins.uncertainty_periods(t.uncertainty_eez, t.uncertainty_time_period)


@check("j08_densify", """
with annual as (select taxon_key, year, sum(catch_sum) as catch from {stock_fact} group by 1, 2)
select k.taxon_key, y.time_business_key as year, cast(a.catch as decimal(28,4)) as catch
from (select distinct taxon_key from annual) k cross join {stock_years} y
left join annual a on a.taxon_key = k.taxon_key and a.year = y.time_business_key""")
def j08(t):
    annual = t.stock_fact.groupBy("taxon_key", "year").agg(F.sum("catch_sum").alias("catch"))
    rows = joins.densify(annual, ["taxon_key"], "year", "catch", t.stock_years, "time_business_key")
    return rows.withColumn("catch", F.col("catch").cast("decimal(28,4)"))


@check("j09_semi_join", """
select universal_data_id, year from {allocation_data} d where exists (
  select 1 from {allocation_result} r where r.universal_data_id = d.universal_data_id and r.allocated_catch > 25)""")
def j09(t):
    large = t.allocation_result.filter(F.col("allocated_catch") > 25).select("universal_data_id").distinct()
    return t.allocation_data.join(large, "universal_data_id", "left_semi").select("universal_data_id", "year")


@check("j10_missing_in", """
select o.taxon_key, o.cell_id, o.relative_abundance from {taxon_distribution} o left join {new_distribution} n
on n.taxon_key = o.taxon_key and n.cell_id = o.cell_id where n.cell_id is null""")
def j10(t):
    rows = joins.missing_in(t.taxon_distribution, t.new_distribution, ["taxon_key", "cell_id"])
    return rows.select("taxon_key", "cell_id", "relative_abundance")


@check("j11_one_row_gate", """
select universal_data_id, year from {allocation_data} d join (select count(*) > 10 as shown from {gear}) g on g.shown""")
def j11(t):
    shown = t.gear.agg((F.count(F.lit(1)) > 10).alias("shown")).scalar()
    return t.allocation_data.withColumn("shown", shown).filter("shown").select("universal_data_id", "year")


@check("j12_scalar_subquery", """
select a.main_area_id, a.area_key, (select sum(number_of_cells) from {area} b where b.main_area_id = a.main_area_id
  and b.marine_layer_id = 1)::bigint as cells, (select max(year) from {allocation_data}) as last_year
from {area} a where a.marine_layer_id = 3""")
def j12(t):
    cells = t.area.filter("marine_layer_id = 1").groupBy("main_area_id").agg(F.sum("number_of_cells").alias("cells"))
    rows = t.area.filter("marine_layer_id = 3").join(cells, "main_area_id", "left")
    last = t.allocation_data.agg(F.max("year")).scalar()
    return rows.select("main_area_id", "area_key", "cells", last.alias("last_year"))


@check("j13_entity_name", """
select area_key, a.marine_layer_id, main_area_id, name, layer_name from {area} a
join {entity_name} n on n.marine_layer_id = a.marine_layer_id and n.id = a.main_area_id""")
def j13(t):
    rows = joins.with_entity_name(t.area, t.entity_name)
    return rows.select("area_key", "marine_layer_id", "main_area_id", "name", "layer_name")


@check("j14_unnest_parallel_arrays", """
select gid, p.x, p.y, p.ord as ordinality from {extent_corner}, lateral (
  select x1 as x, y1 as y, 1 as ord union all select x2, y2, 2 union all select x3, y3, 3 union all select x4, y4, 4
  union all select x5, y5, 5) p""")
def j14(t):
    zipped = F.arrays_zip(F.array(*[f"x{i}" for i in range(1, 6)]).alias("x"), F.array(*[f"y{i}" for i in range(1, 6)]).alias("y"))
    rows = t.extent_corner.select("gid", F.posexplode(zipped).alias("pos", "p"))
    return rows.select("gid", F.col("p.x").alias("x"), F.col("p.y").alias("y"), (F.col("pos") + 1).alias("ordinality"))


@check("j15_array_membership", """
select g.id, gx, gy from {grid} g where g.id in (select unnest([l_partkey, l_partkey + 1]) from {lineitem})""")
def j15(t):
    listed = t.lineitem.select(F.explode(F.array(F.col("l_partkey"), F.col("l_partkey") + 1)).alias("id")).distinct()
    return t.grid.join(listed, "id", "left_semi").select("id", "gx", "gy")


@check("j16_neighbours", """
select distinct a.id as cell_id, b.id as neighbour_id from {grid} a join {grid} b
on a.id <> b.id and a.xmin <= b.xmax and b.xmin <= a.xmax and a.ymin <= b.ymax and b.ymin <= a.ymax""")
def j16(t):
    cells = t.grid.select(F.col("id").alias("cell_id"), F.col("id").alias("neighbour_of"))
    rows = joins.neighbours(cells, t.grid, ["neighbour_of"])
    return rows.select(F.col("neighbour_of").alias("cell_id"), F.col("cell_id").alias("neighbour_id"))


@check("j17_area_weighted", """
select r.universal_data_id, a.marine_layer_id, a.area_id, cast(sum(r.allocated_catch * cast(a.water_area / c.water_area as decimal(18,12))) as decimal(28,6)) as catch
from {allocation_result} r join {simple_area_cell_assignment_raw} a on a.cell_id = r.cell_id
join {cell} c on c.cell_id = r.cell_id group by 1, 2, 3""")
def j17(t):
    weights = measured(keep=materialize, weights=joins.cell_weights(t.simple_area_cell_assignment_raw, t.cell))["weights"]
    rows = joins.area_weighted(t.allocation_result, weights)
    sums = rows.groupBy("universal_data_id", "marine_layer_id", "area_id").agg(F.sum("allocated_catch").alias("catch"))
    return sums.withColumn("catch", F.col("catch").cast("decimal(28,6)"))


@check("j18_allowed_pairs", """
select a.cell_id, a.area_id, a.fao_area_id, a.marine_layer_id from {simple_area_cell_assignment_raw} a
join {area_fao} p on p.area_id = a.area_id and p.fao_area_id = a.fao_area_id""")
def j18(t):
    pairs = measured(pairs=t.area_fao)["pairs"]
    rows = joins.allowed_pairs(t.simple_area_cell_assignment_raw, pairs, ["area_id", "fao_area_id"])
    return rows.select("cell_id", "area_id", "fao_area_id", "marine_layer_id")


@check("j19_comma_join", """
select f.fishing_entity_id, f.name, v.catch, t.hi from (select fishing_entity_id, cast(sum(catch_sum) as decimal(28,4)) as catch
  from {stock_fact} group by 1) v, {fishing_entity} f, (select max(catch_sum) as hi from {stock_fact}) t
where v.fishing_entity_id = f.fishing_entity_id""")
def j19(t):
    sums = t.stock_fact.groupBy("fishing_entity_id").agg(F.sum("catch_sum").cast("decimal(28,4)").alias("catch"))
    rows = sums.join(t.fishing_entity, "fishing_entity_id")
    return rows.select("fishing_entity_id", "name", "catch", t.stock_fact.agg(F.max("catch_sum")).scalar().alias("hi"))
