"""Aggregates, sorting, top-k and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from catchlake.checks.registry import check, in_order, spark_of
from catchlake.operators import aggregates as A
from catchlake.operators.joins import uncertainty_periods, with_score
from catchlake.operators.windows import with_run

DIMENSIONS = ["fishing_entity_id", "year", "taxon_key", "sector_type_id", "catch_type_id", "reporting_status_id",
              "data_layer_id", "gear_type_id"]


@check("a01_sum_by_keys", f"""
select {', '.join(DIMENSIONS)}, cast(sum(unit_price) as decimal(28,2)) as total from {{allocation_data}} group by all""")
def a01(t):
    return A.total(t.allocation_data, DIMENSIONS, "unit_price", "total").withColumn("total", F.col("total").cast("decimal(28,2)"))


@check("a02_max_label", """
select d.year, d.catch_type_id, max(c.abbreviation) as catch_status, count(*) as ids from {allocation_data} d
join {catch_type} c on c.catch_type_id = d.catch_type_id group by 1, 2""")
def a02(t):
    rows = t.allocation_data.join(F.broadcast(t.catch_type), "catch_type_id")  # two literal rows
    return rows.groupBy("year", "catch_type_id").agg(F.max("abbreviation").alias("catch_status"), F.count(F.lit(1)).alias("ids"))


@check("a03_counts", """
select year, count(*) as rows_in_year, count(distinct taxon_key) as taxa from {allocation_data} group by 1""")
def a03(t):
    return t.allocation_data.groupBy("year").agg(F.count(F.lit(1)).alias("rows_in_year"), F.countDistinct("taxon_key").alias("taxa"))


@check("a04_bounds", """
select min(year) as min_year, max(year) as max_year, min(unit_price) as min_unit_price, max(unit_price) as max_unit_price
from {allocation_data}""")
def a04(t):
    return A.bounds(t.allocation_data, "year", "unit_price")


SCORED = """
select d.year, d.sector_type_id, u.score, d.unit_price from {allocation_data} d left join (
  select ue.*, year_from, year_to from {uncertainty_eez} ue left join {uncertainty_time_period} p on p.period_id = ue.period_id) u
on u.eez_id = d.fishing_entity_id and u.sector_type_id = d.sector_type_id and u.layer = d.data_layer_id
  and d.year >= u.year_from and d.year < u.year_to"""


@check("a05_sum_then_default", f"""
select year, sector_type_id, coalesce(score, 1) as score, cast(sum(unit_price) as decimal(28,2)) as total from ({SCORED}) x
group by year, sector_type_id, x.score""")
def a05(t):
    rows = with_score(t.allocation_data.withColumn("eez_id", F.col("fishing_entity_id")),
                      uncertainty_periods(t.uncertainty_eez, t.uncertainty_time_period))
    return A.sum_then_default(rows, ["year", "sector_type_id"], "score", 1, total=F.sum("unit_price").cast("decimal(28,2)"))


@check("a06_having", """
select taxon_key, cast(sum(catch_sum) as decimal(28,4)) as total from {stock_fact} where catch_sum > 0 group by 1
having sum(catch_sum) >= 1000 and max(year) - min(year) + 1 >= 10 and count(distinct year) >= 5""")
def a06(t):
    grouped = t.stock_fact.filter("catch_sum > 0").groupBy("taxon_key").agg(
        F.sum("catch_sum").cast("decimal(28,4)").alias("total"), (F.max("year") - F.min("year") + 1).alias("span"),
        F.countDistinct("year").alias("years"))
    return grouped.filter("total >= 1000 and span >= 10 and years >= 5").select("taxon_key", "total")


@check("a07_coefficient_of_variation", """
select taxon_key, round(case when avg(catch_sum) = 0 then null else sqrt(var_samp(cast(catch_sum as double))) / avg(catch_sum) end, 8)
  as coevar from {stock_fact} group by 1""")
def a07(t):
    return A.variation(t.stock_fact, ["taxon_key"], "catch_sum").withColumn("coevar", F.round("coevar", 8))


@check("a08_pivot", """
select year, max(unit_price) filter (where data_layer_id = 1) as one, max(unit_price) filter (where data_layer_id = 2) as two,
  max(unit_price) filter (where data_layer_id = 3) as three from {allocation_data} group by 1""")
def a08(t):
    return A.pivot_categories(t.allocation_data, ["year"], "data_layer_id", "unit_price", ["one", "two", "three"])


@check("a09_blocked_arrays", """
select taxon_key, cast(floor(cell_id / 1000) as bigint) as block, array_to_string(list_sort(list(distinct cell_id)), ',') as ids
from {taxon_distribution} group by 1, 2""")
def a09(t):
    return A.blocked_arrays(t.taxon_distribution, ["taxon_key"], "cell_id").withColumn("ids", F.array_join("ids", ","))


@check("a10_json_list", """
select marine_layer_id, concat('[', string_agg(json_object('area_key', area_key, 'cells', number_of_cells), ',' order by area_key), ']')
  as document from {area} group by 1""")
def a10(t):
    """Areas per layer: at most a few hundred rows of a fixed dimension per list."""
    entry = F.struct("area_key", F.col("number_of_cells").alias("cells"))
    return t.area.groupBy("marine_layer_id").agg(F.to_json(F.array_sort(F.collect_list(entry))).alias("document"))


@check("a11_two_level_sum", """
select year, cast(sum(total) as decimal(28,2)) as total, count(*) as groups_in_year from (
  select year, taxon_key, sum(unit_price) as total from {allocation_data} group by 1, 2) x group by 1""")
def a11(t):
    fine = A.total(t.allocation_data, ["year", "taxon_key"], "unit_price", "total")
    return fine.groupBy("year").agg(F.sum("total").cast("decimal(28,2)").alias("total"), F.count(F.lit(1)).alias("groups_in_year"))


@check("a12_tally_across_groups", """
with sums as (select taxon_key, cast(sum(unit_price) as decimal(28,2)) as total from {allocation_data} group by 1)
select taxon_key, total, (select min(total) from sums) as min_total, (select max(total) from sums) as max_total from sums""")
def a12(t):
    sums = t.allocation_data.groupBy("taxon_key").agg(F.sum("unit_price").cast("decimal(28,2)").alias("total"))
    return A.with_bounds(sums, "total")


@check("a13_distinct_keys", "select distinct fishing_entity_id, taxon_key, year from {allocation_data}")
def a13(t):
    return t.allocation_data.select("fishing_entity_id", "taxon_key", "year").distinct()


@check("o01_multi_key_sort", """
select main_area_id, year, taxon_key, catch_sum, cast(row_number() over (order by main_area_id nulls first, year nulls first,
  taxon_key nulls first, catch_sum nulls first) as int) as position from {stock_fact}""")
def o01(t):
    rows = t.stock_fact.select("main_area_id", "year", "taxon_key", "catch_sum").orderBy("main_area_id", "year", "taxon_key", "catch_sum")
    return in_order(rows, "sorted")


@check("o02_descending_nulls_first", """
select universal_data_id, unit_price, cast(row_number() over (order by unit_price desc nulls first, universal_data_id) as int) as position
from {allocation_data}""")
def o02(t):
    rows = t.allocation_data.select("universal_data_id", "unit_price")
    return in_order(rows.orderBy(F.col("unit_price").desc_nulls_first(), "universal_data_id"), "sorted")


@check("o04_first_per_key", """
select taxon_key, universal_data_id, unit_price from (select *, row_number() over (partition by taxon_key
  order by unit_price desc nulls last, universal_data_id) as rn from {allocation_data}) x where rn = 1""")
def o04(t):
    """Top row per key as an aggregate, so that a key with any number of rows is combined before the shuffle."""
    order = F.struct(F.coalesce("unit_price", F.lit(-1)).alias("p"), (-F.col("universal_data_id")).alias("i"))
    best = t.allocation_data.groupBy("taxon_key").agg(F.max_by(F.struct("universal_data_id", "unit_price"), order).alias("r"))
    return best.select("taxon_key", "r.universal_data_id", "r.unit_price")


@check("u01_union_all", """
select allocation_simple_area_id, 1 as area_id from {allocation_simple_area} where eez_id > 0
union all select allocation_simple_area_id, 2 from {allocation_simple_area} where eez_id = 0""")
def u01(t):
    areas = t.allocation_simple_area
    parts = [areas.filter(test).select("allocation_simple_area_id", F.lit(i).alias("area_id"))
             for i, test in ((1, "eez_id > 0"), (2, "eez_id = 0"))]
    return parts[0].unionByName(parts[1])


@check("u02_set_growth", """
select taxon_key, cell_id from {taxon_distribution} union select taxon_key, cell_id + 1 from {taxon_distribution}""")
def u02(t):
    cells = t.taxon_distribution.select("taxon_key", "cell_id")
    return cells.select("taxon_key", F.explode(F.array(F.col("cell_id"), F.col("cell_id") + 1)).alias("cell_id")).distinct()


@check("u03_inline_values", """
select a.area_key, g.area_id from {area} a join (values (1), (2)) g(area_id) on a.sub_area_id = g.area_id""")
def u03(t):
    values = F.broadcast(spark_of(t).createDataFrame([(1,), (2,)], "area_id int"))  # two literal rows
    return t.area.join(values, F.col("sub_area_id") == F.col("area_id")).select("area_key", "area_id")


@check("w02_forward_run", """
with annual as (select main_area_id, taxon_key, year, sum(catch_sum) as catch, row_number() over (partition by main_area_id, taxon_key
  order by year) as place from {stock_fact} group by 1, 2, 3)
select a.main_area_id, a.taxon_key, a.year, cast(any_value(a.catch) as decimal(28,4)) as catch,
  cast(count(*) filter (where a.catch <> 0 and b.catch <> 0) as int) as positive_catch_count
from annual a join annual b on b.main_area_id = a.main_area_id and b.taxon_key = a.taxon_key and b.place between a.place and a.place + 4
group by a.main_area_id, a.taxon_key, a.year""")
def w02(t):
    annual = t.stock_fact.groupBy("main_area_id", "taxon_key", "year").agg(F.sum("catch_sum").cast("decimal(28,4)").alias("catch"))
    return with_run(annual, ["main_area_id", "taxon_key"], "year", "catch")
